"""Physical-plan checks: the parse path stays JVM-side and narrow, filters
reach the parquet scan, and last-write-wins aggregates map-side."""

from pyspark.sql import functions as F

from labwire.operators.routing import has_lab_code
from labwire.operators.upsert import latest
from labwire.plans.pipeline import route_records, valid_rows
from labwire.sources.fixtures import records_from_dir
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_path_has_no_python_and_no_shuffle(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    records_from_dir(spark, SF_SMALL).write.parquet(path)
    routed = route_records(spark.read.parquet(path))
    p = plan(valid_rows(routed))
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "Exchange" not in p
    assert "WholeStageCodegen" in p or "*(" in p


def test_lab_code_filter_is_pushed_to_parquet(spark, tmp_dir):
    path = f"{tmp_dir}/stored"
    spark.createDataFrame([("m1", "L01"), ("m2", None), ("m3", "")], "message_ref_id string, lab_code string") \
        .write.parquet(path)
    df = spark.read.parquet(path).filter(has_lab_code(F.col("lab_code")))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lab_code), Not(EqualTo(lab_code,))]" in p
    assert sorted(r.message_ref_id for r in df.collect()) == ["m1"]


def test_latest_uses_partial_aggregation(spark):
    df = spark.createDataFrame([("a", 1, 0, 1)], "message_ref_id string, v int, partition int, offset long")
    p = plan(latest(df))
    assert "partial_max_by" in p


def test_spread_widens_only_narrow_scans(spark, tmp_dir):
    from labwire.operators.parse import spread

    spark.range(1000).coalesce(1).write.parquet(f"{tmp_dir}/one")
    narrow = spark.read.parquet(f"{tmp_dir}/one")
    assert narrow.rdd.getNumPartitions() == 1
    assert spread(narrow, 6).rdd.getNumPartitions() == 6
    spark.range(1000).repartition(8).write.parquet(f"{tmp_dir}/many")
    wide = spark.read.parquet(f"{tmp_dir}/many")
    assert spread(wide, 4) is wide  # no extra shuffle
    assert spread(narrow, None) is narrow


def test_routing_carries_neither_raw_text_nor_other_segments(spark, tmp_dir):
    from labwire.operators.routing import route_counts
    from labwire.plans.pipeline import route_only

    path = f"{tmp_dir}/raw"
    records_from_dir(spark, SF_SMALL).write.parquet(path)
    counts = route_counts(route_only(spark.read.parquet(path)))
    outputs = [line for line in counts._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate" in line]
    assert len(outputs) == 3  # clean, locate, pick: what leaves each fence
    for line in outputs:
        left = line[line.rindex("["):]
        assert not any(name in left for name in ("raw_message", "pid", "orc", "obr")), left


def test_date_layout_splits_a_hot_date(spark, tmp_dir):
    from labwire.operators.lookups import date_layout

    rows = spark.range(20000).selectExpr("concat('m', id) AS message_ref_id", "'1001' AS mfl_code", "DATE'2024-01-01' AS order_date")
    # so few bytes would be merged into one task at run time
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        date_layout(rows, f"{tmp_dir}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert back.count() == 20000
    assert back.select(F.input_file_name().alias("f")).distinct().count() > 2
