import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from labwire.operators.numbering import number_rows
from labwire.operators.schema import LAB_ORDER_SCHEMA
from labwire.sinks import deltas
from labwire.sinks.deltas import DeltaTable
from labwire.sinks.table import TableUpsertSink
from tests.test_sinks import batch, table_state


def size(path):
    return sum(os.path.getsize(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_batches_ids_and_replay(spark, tmp_dir):
    t = DeltaTable(f"{tmp_dir}/t")
    assert t.read(spark).count() == 0
    put = t.for_query("ckpt-a")
    put(batch(spark, [("a", "a1", 0), ("b", "b1", 1), ("a", "a2", 2)]), 0)
    assert table_state(spark, t) == [(1, "a", "a2"), (2, "b", "b1")]
    later = batch(spark, [("c", "c1", 3), ("b", "b2", 4)])
    put(later, 1)
    want = [(1, "a", "a2"), (2, "b", "b2"), (3, "c", "c1")]
    assert table_state(spark, t) == want
    before = size(t.path)
    put(later, 1)  # the same batch of the same query: nothing is written
    assert size(t.path) == before and table_state(spark, t) == want
    # a fresh checkpoint reads everything again, in other batches; ids stay
    again = t.for_query("ckpt-b")
    again(batch(spark, [("b", "b1", 1)]), 0)
    assert table_state(spark, t)[1] == (2, "b", "b1")  # the last write counts, as in a database
    again(batch(spark, [("a", "a2", 2), ("c", "c1", 3), ("b", "b2", 4), ("d", "d1", 9)]), 1)
    assert table_state(spark, t) == [*want, (4, "d", "d1")]


def test_an_unfinished_folder_is_not_read_and_is_written_again(spark, tmp_dir):
    t = DeltaTable(f"{tmp_dir}/t")
    put = t.for_query("q")
    put(batch(spark, [("a", "a1", 0)]), 0)
    rows = batch(spark, [("a", "a2", 1), ("b", "b1", 2)])
    put(rows, 1)
    (folder,) = glob.glob(f"{t.path}/seq=2/writer=*/batch=1")
    os.remove(f"{folder}/_SUCCESS")  # as a crash in the middle of the write leaves it
    assert table_state(spark, t) == [(1, "a", "a1")]
    put(batch(spark, [("b", "b9", 3)]), 2)  # (cannot happen in a query; the order of appends still holds)
    put(rows, 1)
    assert table_state(spark, t) == [(1, "a", "a2"), (2, "b", "b9")]
    assert glob.glob(f"{t.path}/seq=2/writer=*/batch=1") == [folder]


def test_bytes_written_follow_the_batch(spark, tmp_dir):
    def wide(lo, hi):
        return spark.range(lo, hi).select(
            F.concat(F.lit("m"), "id").alias("message_ref_id"), F.lit("1001").alias("mfl_code"), F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
            F.lit("t").alias("test_id"), F.lit(dt.date(2024, 1, 1)).alias("order_date"), F.lit("10:00:00").alias("order_time"),
            F.lit("app").alias("sending_application"), F.lit("L01").alias("lab_code"), F.lit(0).alias("partition"), F.col("id").alias("offset"))

    t = DeltaTable(f"{tmp_dir}/t")
    put = t.for_query("q")
    put(wide(0, 200), 0)
    small = size(t.path)
    put(wide(0, 40_000), 1)
    large = size(t.path)
    put(wide(300, 500), 2)
    cost = size(t.path) - large
    assert cost < 2 * small and cost < large / 20  # 200 rows cost the same in an empty and in a large table
    assert t.read(spark).count() == 40_000


def test_read_aggregates_two_columns_and_sorts_nothing_before(spark, tmp_dir):
    t = DeltaTable(f"{tmp_dir}/t")
    t.for_query("q")(batch(spark, [("a", "a1", 0)]), 0)
    p = t.current(spark)._jdf.queryExecution().executedPlan().toString()
    below = p[p.index("partial_max"):]
    assert "HashAggregate" in p and "SortAggregate" not in p and "ObjectHashAggregate" not in p
    scan = below[below.index("ReadSchema"):].splitlines()[0]
    assert "mfl_code" not in scan and "order_id" not in scan  # key and order alone


def test_ids_are_given_to_keys_before_the_rows_are_joined(spark, tmp_dir, monkeypatch):
    numbered = []

    def spy(df, *args, **kw):
        numbered.append(df.columns)
        return number_rows(df, *args, **kw)

    monkeypatch.setattr(deltas, "number_rows", spy)
    t = DeltaTable(f"{tmp_dir}/t")
    put = t.for_query("q")
    put(batch(spark, [("b", "b1", 0), ("a", "a1", 1), (None, "x", 2)]), 0)
    put(batch(spark, [("b", "b2", 3), (None, "y", 4), ("c", "c1", 5)]), 1)
    assert table_state(spark, t) == [(1, "b", "b2"), (2, "a", "a1"), (3, "c", "c1")]  # no id for a row without a key
    assert [set(c) for c in numbered] == [{"_key", "_seq", "_order"}]  # no other column is sorted or checkpointed


def test_column_added_later(spark, tmp_dir):
    old = type(LAB_ORDER_SCHEMA)([f for f in LAB_ORDER_SCHEMA.fields if f.name != "lab_code"])
    DeltaTable(f"{tmp_dir}/t", old).for_query("q")(batch(spark, [("a", "a1", 0), ("b", "b1", 1)]), 0)
    t = DeltaTable(f"{tmp_dir}/t")
    t.for_query("q")(batch(spark, [("b", "b2", 2), ("c", "c1", 3)]), 1)
    got = sorted((r.id, r.message_ref_id, r.order_id, r.lab_code) for r in t.read(spark).collect())
    assert got == [(1, "a", "a1", None), (2, "b", "b2", "L01"), (3, "c", "c1", "L01")]


def test_bucket_table_takes_an_added_column(spark, tmp_dir):
    old = ["mfl_code", "order_id"]
    TableUpsertSink(f"{tmp_dir}/t", buckets=4, columns=old).for_query("q")(batch(spark, [("a", "a1", 0), ("b", "b1", 1)]), 0)
    sink = TableUpsertSink(f"{tmp_dir}/t", buckets=4, columns=[*old, "lab_code"])
    assert {r.lab_code for r in sink.read(spark).collect()} == {None}
    sink.for_query("q")(batch(spark, [("b", "b2", 2), ("c", "c1", 3)]), 1)
    got = sorted((r.id, r.message_ref_id, r.order_id, r.lab_code) for r in sink.read(spark).collect())
    assert got == [(1, "a", "a1", None), (2, "b", "b2", "L01"), (3, "c", "c1", "L01")]


def test_facility_cascade_writes_matching_rows_alone(spark, tmp_dir):
    t = DeltaTable(f"{tmp_dir}/t")
    put = t.for_query("q")
    rows = batch(spark, [("a", "a1", 0), ("b", "b1", 1), ("c", "c1", 2)]).withColumn("mfl_code", F.concat(F.lit("10"), F.col("message_ref_id")))
    put(rows, 0)
    swap = spark.createDataFrame([("10a", "10b"), ("10b", "10a"), ("10x", "10y")], "old_code string, new_code string")
    t.rename_facilities(spark, swap, name="swap")
    state = lambda: sorted((r.id, r.message_ref_id, r.mfl_code) for r in t.read(spark).collect())
    want = [(1, "a", "10b"), (2, "b", "10a"), (3, "c", "10c")]
    assert state() == want
    assert t.deltas(spark).filter("writer = 'swap'").count() == 2
    t.rename_facilities(spark, swap, name="swap")  # applied once
    assert state() == want
    put(rows.filter("message_ref_id = 'a'"), 1)  # a later message wins over the update
    assert state()[0] == (1, "a", "10a")
    with pytest.raises(ValueError, match="mapped to 2"):
        t.rename_facilities(spark, spark.createDataFrame([("10a", "1"), ("10a", "2")], "old_code string, new_code string"))
    assert state()[0] == (1, "a", "10a")


def test_copy_keeps_ids(spark, tmp_dir):
    t, other = DeltaTable(f"{tmp_dir}/t"), DeltaTable(f"{tmp_dir}/u")
    t.for_query("q")(batch(spark, [("z", "z1", 0), ("b", "b1", 1)]), 0)
    t.for_query("q")(batch(spark, [("a", "a1", 2), ("z", "z2", 3)]), 1)
    t.copy_to(spark, other)
    assert table_state(spark, other) == table_state(spark, t) == [(1, "z", "z2"), (2, "b", "b1"), (3, "a", "a1")]
    other.for_query("q2")(batch(spark, [("c", "c1", 0)]), 0)
    assert table_state(spark, other)[-1] == (4, "c", "c1")
    with pytest.raises(ValueError, match="not empty"):
        t.copy_to(spark, other)


def test_two_writers_at_once_claim_different_numbers(spark, tmp_dir):
    t = DeltaTable(f"{tmp_dir}/t")
    from labwire.sinks import files

    files.create_new(spark, f"{t.path}/_claims/1")  # claimed by a writer that has not written yet
    t.for_query("q")(batch(spark, [("a", "a1", 0)]), 0)
    assert glob.glob(f"{t.path}/seq=2") and table_state(spark, t) == [(1, "a", "a1")]
