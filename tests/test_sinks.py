import pytest
from pyspark.sql import functions as F

from labwire.operators.schema import add_column, read_evolved, union_evolved
from labwire.sinks.jdbc import merge_sql
from labwire.sinks.table import TableUpsertSink
from labwire.sources.kafka import KafkaSecurity, reader_options, writer_options

SCHEMA = ("message_ref_id string, mfl_code string, order_id string, test_id string, order_date date, "
          "order_time string, sending_application string, lab_code string, partition int, offset long")


def batch(spark, items):
    return spark.createDataFrame(
        [(k, "1001", o, "t", None, None, "app", "L01", 0, off) for k, o, off in items], SCHEMA
    )


def table_state(spark, sink):
    return sorted((r.id, r.message_ref_id, r.order_id) for r in sink.read(spark).collect())


def test_table_upsert_batches_and_crash_recovery(spark, tmp_dir):
    sink = TableUpsertSink(f"{tmp_dir}/t", buckets=4)
    merge = sink.for_query("ckpt-a")
    merge(batch(spark, [("a", "a1", 0), ("b", "b1", 1), ("a", "a2", 2)]), 0)
    assert table_state(spark, sink) == [(1, "a", "a2"), (2, "b", "b1")]
    b1 = batch(spark, [("c", "c1", 3), ("b", "b2", 4)])
    # crash after staging, before the table was replaced: the re-run finishes from staging
    sink._stage(b1, sink._staging(sink_tag("ckpt-a"), 1), sink.max_id(spark))
    assert table_state(spark, sink) == [(1, "a", "a2"), (2, "b", "b1")]
    merge(b1, 1)
    assert table_state(spark, sink) == [(1, "a", "a2"), (2, "b", "b2"), (3, "c", "c1")]
    # replaying a committed batch (new query, fresh checkpoint) changes nothing
    sink.for_query("ckpt-b")(b1, 0)
    assert table_state(spark, sink) == [(1, "a", "a2"), (2, "b", "b2"), (3, "c", "c1")]
    assert sink.max_id(spark) == 3
    # a lost state file falls back to scanning the ids
    from labwire.sinks import files
    files.delete(spark, sink._state())
    assert sink.max_id(spark) == 3
    sink.for_query("ckpt-b")(batch(spark, [("d", "d1", 9)]), 1)
    assert table_state(spark, sink)[-1] == (4, "d", "d1")


def test_a_complete_staging_copy_is_used_again(spark, tmp_dir):
    """A crash after the maximum id was recorded: the re-run takes the staged ids, not new ones."""
    from labwire.sinks import files

    sink = TableUpsertSink(f"{tmp_dir}/t", buckets=4)
    merge = sink.for_query("ckpt-a")
    merge(batch(spark, [("a", "a1", 0)]), 0)
    rows, staging = batch(spark, [("b", "b1", 1)]), sink._staging(sink_tag("ckpt-a"), 1)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # as the library recommends
    sink._stage(rows, staging, sink.max_id(spark))
    assert files.complete(spark, staging)
    sink._record_max_id(spark, 1, staging, spark.read.parquet(staging))
    merge(rows, 1)
    assert table_state(spark, sink) == [(1, "a", "a1"), (2, "b", "b1")]


def sink_tag(checkpoint):
    import hashlib

    return hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def test_merge_sql_names_no_id():
    sql = merge_sql("crt.lab_order", "stage_1")
    assert sql.startswith("INSERT INTO crt.lab_order (mfl_code, order_id, test_id, order_date, order_time, "
                          "message_ref_id, sending_application, lab_code) SELECT ")
    assert "order_date::date" in sql and "order_time::time" in sql
    assert "ON CONFLICT (message_ref_id) DO UPDATE SET mfl_code = EXCLUDED.mfl_code, order_id" in sql
    assert "message_ref_id = EXCLUDED" not in sql
    assert " id" not in sql.replace("_id", "")


def test_kafka_options_require_settings():
    with pytest.raises(ValueError):
        reader_options("")
    o = reader_options("broker:9092", security=KafkaSecurity("SASL_SSL", "SCRAM-SHA-512", "u", "p"), group_id="g")
    assert o["subscribe"] == "lab-orders" and o["startingOffsets"] == "earliest"
    assert o["kafka.request.timeout.ms"] == o["kafka.default.api.timeout.ms"] == "2540000"
    more = reader_options("broker:9092", extra={"max.poll.records": 500, "kafka.fetch.min.bytes": 1})
    assert more["kafka.max.poll.records"] == "500" and more["kafka.fetch.min.bytes"] == "1"
    assert writer_options(extra={"acks": "all"}) == {"kafka.delivery.timeout.ms": "120000", "kafka.acks": "all"}
    assert o["kafka.group.id"] == "g" and 'username="u" password="p"' in o["kafka.sasl.jaas.config"]


def test_schema_evolution(spark, tmp_dir):
    old = spark.createDataFrame([("m1", "1001")], "message_ref_id string, mfl_code string")
    new = spark.createDataFrame([("m2", "1002", "L01")], "message_ref_id string, mfl_code string, lab_code string")
    got = sorted(tuple(r) for r in union_evolved(old, new).collect())
    assert got == [("m1", "1001", None), ("m2", "1002", "L01")]
    assert "lab_code" in add_column(old, "lab_code", new.schema["lab_code"].dataType).columns
    old.write.parquet(f"{tmp_dir}/v1")
    new.write.parquet(f"{tmp_dir}/v2")
    got = sorted(tuple(r) for r in read_evolved(spark, f"{tmp_dir}/v1", f"{tmp_dir}/v2")
                 .select("message_ref_id", "mfl_code", "lab_code").collect())
    assert got == [("m1", "1001", None), ("m2", "1002", "L01")]


def test_jdbc_merge_retries_then_fails(spark, monkeypatch):
    from labwire.sinks import jdbc

    calls = []

    def flaky(_spark, _t, sql):
        calls.append(sql)
        if len(calls) < 3:
            raise RuntimeError("connection reset")

    class FakeWriter:
        def __getattr__(self, name):
            return lambda *a, **k: self

    rows = batch(spark, [("a", "a1", 0)]).drop("partition", "offset")
    monkeypatch.setattr(jdbc, "_execute", flaky)
    monkeypatch.setattr(type(rows), "write", property(lambda self: FakeWriter()))
    t = jdbc.JdbcTarget("jdbc:postgresql://db/x", "u", "p")
    jdbc.upsert_batch(rows, 7, t, "5f0c-11", pause_s=0)
    assert len(calls) == 4 and calls[2].startswith("INSERT") and calls[3].startswith("DROP TABLE")
    assert calls[3].endswith("crt.lab_order_stage_5f0c11_7")  # another query's staging is another table
    calls.clear()
    calls.extend(["a", "b"])  # the merge works at once; a failing DROP does not fail the batch

    def no_drop(_spark, _t, sql):
        calls.append(sql)
        if sql.startswith("DROP"):
            raise RuntimeError("locked")

    monkeypatch.setattr(jdbc, "_execute", no_drop)
    jdbc.upsert_batch(rows, 7, t, pause_s=0)
    assert [c[:4] for c in calls[2:]] == ["INSE", "DROP"]
    calls.clear()
    monkeypatch.setattr(jdbc, "_execute", lambda *a: (_ for _ in ()).throw(RuntimeError("down")))
    with pytest.raises(RuntimeError):
        jdbc.upsert_batch(rows, 8, t, pause_s=0)


def test_date_layout_and_lookups(spark, tmp_dir):
    import datetime as dt

    from labwire.operators import lookups

    df = spark.createDataFrame(
        [("m1", "1001", dt.date(2024, 1, 1)), ("m2", "1002", dt.date(2024, 1, 2)), ("m3", "1001", None)],
        "message_ref_id string, mfl_code string, order_date date",
    )
    lookups.date_layout(df, f"{tmp_dir}/by_date")
    back = spark.read.parquet(f"{tmp_dir}/by_date")
    p = back.filter(F.col("order_date") == dt.date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in p
    assert [r.message_ref_id for r in back.filter(F.col("order_date") == dt.date(2024, 1, 2)).collect()] == ["m2"]
    keys = spark.createDataFrame([("1001",)], "mfl_code string")
    assert sorted(r.message_ref_id for r in lookups.lookup_many(df, keys, "mfl_code").collect()) == ["m1", "m3"]
    ranked = [(r.rn, r.message_ref_id) for r in lookups.by_date(df).orderBy("rn").collect()]
    assert ranked == [(1, "m2"), (2, "m1"), (3, "m3")]
    tl = [(r.rn, r.message_ref_id) for r in lookups.facility_timeline(df, "1001").orderBy("rn").collect()]
    assert tl == [(1, "m3"), (2, "m1")]


def test_other_bucket_count_is_refused(spark, tmp_dir):
    import pytest

    rows = batch(spark, [("a", "a1", 0), ("b", "b1", 1)])
    TableUpsertSink(f"{tmp_dir}/t", buckets=4).for_query("c")(rows, 0)
    with pytest.raises(ValueError, match="buckets"):
        TableUpsertSink(f"{tmp_dir}/t", buckets=7).for_query("c")(rows, 1)


def test_dead_letters_of_two_queries_stay(spark, tmp_dir):
    from labwire.sinks import dead_letters

    for query, text in (("q1", "one"), ("q2", "two"), ("q2", "two")):
        dead_letters.to_files(spark.createDataFrame([(text,)], "value string"), f"{tmp_dir}/dlq", 0, query)
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/dlq").collect()) == ["one", "two"]


def test_a_stretch_of_the_topic(spark):
    import json

    from labwire.sources.kafka import range_options
    from labwire.sources.records import offset_range

    o = range_options("broker:9092", {0: 5, 2: 7}, {0: 9, 1: 3}, group := "lab-orders", extra={"fetch.min.bytes": 1})
    assert json.loads(o["assign"]) == {group: [0, 1, 2]} and "subscribe" not in o
    assert json.loads(o["startingOffsets"]) == {group: {"0": 5, "1": -2, "2": 7}}
    assert json.loads(o["endingOffsets"]) == {group: {"0": 9, "1": 3, "2": -1}}
    assert o["kafka.fetch.min.bytes"] == "1" and "maxOffsetsPerTrigger" not in o
    with pytest.raises(ValueError, match="ends before"):
        range_options("broker:9092", {0: 5}, {0: 4})
    with pytest.raises(ValueError, match="at least one"):
        range_options("broker:9092", {}, {})
    rows = spark.createDataFrame([(p, i) for p in range(4) for i in range(12)], "partition int, offset bigint")
    got = {p: sorted(r.offset for r in offset_range(rows, {0: 5, 2: 7}, {0: 9, 1: 3}).collect() if r.partition == p) for p in range(4)}
    assert got == {0: [5, 6, 7, 8], 1: [0, 1, 2], 2: [7, 8, 9, 10, 11], 3: []}
    assert offset_range(rows, {}, {}).count() == 0
