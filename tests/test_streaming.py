import os
import time

import pytest
from pyspark.sql import functions as F

from labwire.operators import contracts
from labwire.plans.pipeline import route_records, valid_rows
from labwire.sinks.table import TableUpsertSink
from labwire.sources.fixtures import records_from_dir
from labwire.streaming.job import FanOut, file_source, start
from labwire.streaming.metrics import RouteCounter
from tests.conftest import SF_SMALL

# FIXTURES §4 at sf0.001
EXPECTED = {"empty": 18, "unparseable": 71, "no_message_id": 35, "bad_mfl": 225, "dlq": 105, "valid": 1046}


def test_stream_route_counters_and_restart(spark, tmp_dir):
    src, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/ckpt"
    rec = records_from_dir(spark, SF_SMALL)
    counter = RouteCounter()
    spark.streams.addListener(counter)
    sink = TableUpsertSink(f"{tmp_dir}/table", buckets=4)
    dead = []
    fan = FanOut(sink.for_query(ckpt), lambda df, bid: dead.append(df.count()), contract="off")
    try:
        for lo, hi in ((0, 700), (700, 10**9)):
            rec.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).write.mode("append").parquet(src)
            q = start(file_source(spark, src), fan, ckpt, trigger={"availableNow": True}, query_name=f"t{lo}")
            q.awaitTermination()
        deadline = time.time() + 30
        while sum(counter.totals.values()) < 1500 and time.time() < deadline:
            time.sleep(0.2)  # listener events arrive asynchronously
    finally:
        spark.streams.removeListener(counter)
    assert dict(counter.totals) == EXPECTED
    assert sum(dead) == EXPECTED["dlq"]
    assert sink.read(spark).count() == 908


def test_job_entry_point_files_to_table(spark, tmp_dir):
    from labwire.streaming import main

    rec = records_from_dir(spark, SF_SMALL)
    rec.write.parquet(f"{tmp_dir}/src")
    args = ["--source-path", f"{tmp_dir}/src", "--table", f"{tmp_dir}/table", "--buckets", "4",
            "--dlq-path", f"{tmp_dir}/dlq", "--checkpoint", f"{tmp_dir}/ckpt", "--available-now"]
    with pytest.raises(Exception, match="contract broken"):  # the default: nothing is written
        main.main([*args, "--query-name", "entry_point_fail"])
    assert not os.path.exists(f"{tmp_dir}/table") and not os.path.exists(f"{tmp_dir}/dlq")
    main.main([*args, "--contract", "off", "--query-name", "entry_point_test"])
    before = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/table").collect())
    assert len(before) == 908
    # everything again from the start: the same table, the letters a second time
    main.main([*args, "--contract", "off", "--replay", "--query-name", "entry_point_replay"])
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/table").collect()) == before
    assert spark.read.parquet(f"{tmp_dir}/dlq").count() == 2 * EXPECTED["dlq"]


def test_entry_point_quarantines(spark, tmp_dir):
    from labwire.streaming import main

    records_from_dir(spark, SF_SMALL).write.parquet(f"{tmp_dir}/src")
    main.main(["--source-path", f"{tmp_dir}/src", "--table", f"{tmp_dir}/table", "--buckets", "4",
               "--dlq-path", f"{tmp_dir}/dlq", "--checkpoint", f"{tmp_dir}/ckpt", "--available-now",
               "--contract", "quarantine", "--quarantine-path", f"{tmp_dir}/aside", "--query-name", "quarantine_test"])
    stored, aside = spark.read.parquet(f"{tmp_dir}/table"), spark.read.parquet(f"{tmp_dir}/aside")
    assert contracts.violations(stored).isEmpty() and not contracts.violations(aside).isEmpty()
    assert contracts.violations(aside).select("message_ref_id", "rule").distinct().count() > 0
    routed_rows = valid_rows(route_records(records_from_dir(spark, SF_SMALL)))
    assert aside.count() == contracts.check(routed_rows).filter("size(violations) > 0").count()


def test_timed_run_flushes_every_chunk_whole(spark):
    from labwire.streaming import queries as q

    made = []

    class Watched(q.DeltaTable):
        def __init__(self, path):
            super().__init__(path)
            made.append(self)

    keep, q.DeltaTable = q.DeltaTable, Watched
    try:
        out = q.q_stream_timed(spark, SF_SMALL)
    finally:
        q.DeltaTable = keep
    assert out.count() == 908
    per_batch = {r.batch: r.n for r in made[0].deltas(spark).groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert sorted(per_batch) == [0, 1, 2] and min(per_batch.values()) > 200  # one flush a chunk, none split


def test_entry_point_writes_deltas_and_counts(spark, tmp_dir):
    from labwire.sinks.deltas import DeltaTable
    from labwire.streaming import main
    from labwire.streaming.metrics import read_counts

    records_from_dir(spark, SF_SMALL).write.parquet(f"{tmp_dir}/src")
    args = ["--source-path", f"{tmp_dir}/src", "--delta-table", f"{tmp_dir}/table", "--counts-path", f"{tmp_dir}/counts", "--dlq-path", f"{tmp_dir}/dlq",
            "--checkpoint", f"{tmp_dir}/ckpt", "--available-now", "--contract", "off"]
    main.main([*args, "--query-name", "delta_entry"])
    table = DeltaTable(f"{tmp_dir}/table")
    before = sorted(map(tuple, table.read(spark).collect()))
    assert len(before) == 908
    assert {r.route: r.n for r in read_counts(spark, f"{tmp_dir}/counts").collect()} == EXPECTED
    main.main([*args, "--replay", "--query-name", "delta_replay"])
    assert sorted(map(tuple, table.read(spark).collect())) == before
    counts = read_counts(spark, f"{tmp_dir}/counts")
    assert {r.route: r.n for r in counts.collect()} == {k: 2 * n for k, n in EXPECTED.items()}  # two queries
    from labwire.sinks import files

    one = read_counts(spark, f"{tmp_dir}/counts", files.query_id(spark, f"{tmp_dir}/ckpt"))
    assert {r.route: r.n for r in one.collect()} == EXPECTED
    assert read_counts(spark, f"{tmp_dir}/none").count() == 0


def test_a_chunk_of_the_feed_is_dealt_evenly(spark, tmp_dir):
    from labwire.streaming import queries as q

    # one file of one row group: a scan splits it by bytes, and one split has all rows
    spark.range(6000).selectExpr("id AS o_orderkey", "id % 50 AS o_custkey", "DATE'1997-01-01' AS o_orderdate").coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.range(50).selectExpr("id AS c_custkey", "id % 25 AS c_nationkey").coalesce(1).write.parquet(f"{tmp_dir}/customer.parquet")
    width = spark.sparkContext.defaultParallelism
    seen = []
    for i in range(3):
        chunk = q._chunk(spark, tmp_dir, i, 3)
        sizes = [r.n for r in chunk.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == width and max(sizes) <= 2 * 2000 / width
        assert q._land(chunk, f"{tmp_dir}/src") == width
        seen += [r.offset for r in chunk.select("offset").collect()]
    assert sorted(seen) == list(range(6000))
    files = spark.read.parquet(f"{tmp_dir}/src").select(F.input_file_name()).distinct().count()
    assert files == 3 * width


def test_sinks_run_over_a_batch_that_is_parsed_already(spark):
    rows = route_records(records_from_dir(spark, SF_SMALL, 4)).cache()
    stored = rows.count()
    assert stored == sum(EXPECTED.values())
    before = {i.id() for i in spark._jsc.sc().getRDDStorageInfo()}
    held = []

    def sink(df, bid):
        held.extend(i.numCachedPartitions() for i in spark._jsc.sc().getRDDStorageInfo() if i.id() not in before)

    FanOut(sink, sink, contract="off")(rows, 0)
    rows.unpersist()
    assert held == [4, 4]


def test_a_stored_batch_holds_what_sinks_read_and_settings_stay(spark):
    rows = route_records(records_from_dir(spark, SF_SMALL, 4))
    name, seen = "spark.sql.inMemoryColumnarStorage.compressed", []
    before = spark.conf.get(name)
    FanOut(lambda df, bid: None, lambda df, bid: None, contract="off",
           counts=lambda df, bid: seen.extend([df.columns, df.count()]))(rows, 0)
    assert spark.conf.get(name) == before and seen[1] == sum(EXPECTED.values())
    assert "raw_message" in seen[0] and not {"is_empty", "is_er7", "structure", "version"} & set(seen[0])
