import random

from pyspark.sql import functions as F

from labwire.operators.numbering import number_rows
from labwire.operators.upsert import empty_like, latest, latest_of_stored, upsert

COLS = ["v"]
SCHEMA = "message_ref_id string, v string, partition int, offset long"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def state(df):
    return sorted((r.id, r.message_ref_id, r.v) for r in df.collect())


def test_latest_keeps_last_arrival(spark):
    df = rows(spark, [("a", "1", 0, 1), ("a", "2", 0, 5), ("b", "3", 1, 2), ("a", "0", 0, 3)])
    got = sorted((r.message_ref_id, r.v, r.offset) for r in latest(df).collect())
    assert got == [("a", "2", 5), ("b", "3", 2)]


def test_upsert_semantics_and_replay(spark):
    t_rows = rows(spark, [("a", "a1", 0, 0), ("b", "b1", 0, 1), ("a", "a2", 0, 2)])
    target = upsert(empty_like(t_rows, ["message_ref_id", "v"]), t_rows, COLS).checkpoint()
    assert state(target) == [(1, "a", "a2"), (2, "b", "b1")]
    u = rows(spark, [("c", "c1", 1, 10), ("b", "b2", 0, 11), ("d", "d1", 1, 12), ("c", "c2", 1, 13)])
    once = upsert(target, u, COLS).checkpoint()
    assert state(once) == [(1, "a", "a2"), (2, "b", "b2"), (3, "c", "c2"), (4, "d", "d1")]
    assert state(upsert(once, u, COLS)) == state(once)


def test_number_rows_matches_sort(spark):
    random.seed(7)
    data = [(i, random.randint(0, 50)) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, g long").repartition(7)
    out = number_rows(df, [F.col("g").desc(), F.col("id")], name="rn", start=10, num_partitions=5)
    got = {r.id: r.rn for r in out.collect()}
    expected = {i: 10 + pos for pos, (i, _) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])))}
    assert got == expected


def test_skewed_key_is_aggregated_not_collected(spark):
    # one key holds most rows; W1 must still give one row per key
    data = [("hot", str(i), i % 3, i) for i in range(3000)] + [("cold", "x", 0, 5)]
    got = {r.message_ref_id: r.v for r in latest(rows(spark, data)).collect()}
    assert got == {"hot": "2999", "cold": "x"}


def test_number_rows_spreads_a_hot_sort_value(spark):
    # every row has the same date: the unique tie-break still splits the range
    import datetime as dt

    data = [(f"m{i:05d}", dt.date(2024, 1, 1)) for i in range(4000)]
    df = spark.createDataFrame(data, "message_ref_id string, order_date date").repartition(4)
    order = [F.col("order_date").desc_nulls_last(), F.col("message_ref_id")]
    out = number_rows(df, order, num_partitions=8)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 2000
    got = [r.message_ref_id for r in out.orderBy("rn").collect()]
    assert got == sorted(m for m, _ in data)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_of_stored_agrees_and_does_not_sort_before_the_exchange(spark, tmp_dir):
    random.seed(11)
    data = [(random.choice("abcdefg") if i % 3 else "hot", str(i), i % 3, i) for i in range(2000)] + [(None, "n", 0, 1), (None, "m", 0, 2)]
    rows(spark, data + data[:50]).write.parquet(f"{tmp_dir}/rows")  # some records are stored twice
    stored = spark.read.parquet(f"{tmp_dir}/rows")
    two = latest_of_stored(stored)
    assert sorted(map(str, two.select("message_ref_id", "v").collect())) == sorted(map(str, latest(stored).select("message_ref_id", "v").collect()))
    p = plan(two)
    at = p.index("partial_max")
    assert "partial_max_by" not in p and "HashAggregate" in p[:at].splitlines()[-1]
    assert "Sort" not in p[at:].split("Scan")[0].split("\n", 1)[1]  # between the map-side aggregate and the scan


def test_upsert_reads_the_target_once(spark, tmp_dir):
    t_rows = rows(spark, [("a", "a1", 0, 0), ("b", "b1", 0, 1)])
    upsert(empty_like(t_rows, ["message_ref_id", "v"]), t_rows, COLS).write.parquet(f"{tmp_dir}/target")
    target = spark.read.parquet(f"{tmp_dir}/target")
    spark.sparkContext.setJobGroup("one-pass", "upsert")
    try:
        out = upsert(target, rows(spark, [("b", "b2", 0, 5), ("c", "c1", 0, 6)]), COLS)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one-pass")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert f"{tmp_dir}/target" not in plan(out)  # the result comes from the one written state
    assert len(jobs) <= 8  # the merge with its shuffles, the numbering's sample and sort; none depends on the table
    assert state(out) == [(1, "a", "a1"), (2, "b", "b2"), (3, "c", "c1")]


def test_ranks_come_from_one_checkpoint_and_no_second_read(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "id long, g long").repartition(6)
    sc = spark.sparkContext
    sc.setJobGroup("ranks", "ranks")
    try:
        out = number_rows(df, [F.col("g"), F.col("id")], num_partitions=4)
        jobs = sc.statusTracker().getJobIdsForGroup("ranks")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert plan(out).count("Scan ExistingRDD[id") == 1  # the one written frame (beside the offsets)
    assert len(jobs) <= 4
    assert sorted(r.rn for r in out.collect()) == list(range(1, 501))
    # more partitions than bins: counted from the checkpoint instead, with the same result
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        wide = number_rows(df, [F.col("g"), F.col("id")])
        assert sorted(r.rn for r in wide.collect()) == list(range(1, 501))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_number_rows_of_nothing(spark):
    assert number_rows(spark.createDataFrame([], "id long"), [F.col("id")]).count() == 0
