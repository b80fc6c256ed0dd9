"""SURVEY §5 (e)/(f): invariants over the whole fixture feed and plan shape."""

from pyspark.sql import functions as F

from labwire.operators import contracts, routing
from labwire.operators.upsert import latest
from labwire.plans.pipeline import route_records, valid_rows
from labwire.plans.queries import stored
from labwire.sources.fixtures import records_from_dir
from tests.conftest import SF_SMALL


def test_route_counts_sum_to_input(spark):
    rec = records_from_dir(spark, SF_SMALL)
    counts = {r.route: r.n for r in routing.route_counts(route_records(rec)).collect()}
    assert set(counts) == set(routing.ROUTES)
    assert sum(counts.values()) == rec.count()


def test_stored_table_has_unique_keys_and_ids(spark):
    s = stored(spark, SF_SMALL)
    assert contracts.duplicate_keys(s).count() == 0
    from labwire.plans.queries import q_upsert_state

    state = q_upsert_state(spark, SF_SMALL)
    ids = state.agg(F.count("id").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"),
                    F.max("id").alias("hi")).first()
    assert ids.n == ids.d == ids.hi - ids.lo + 1 and ids.lo == 1  # dense, unique
    assert contracts.duplicate_keys(state).count() == 0


def test_dedup_plan_has_one_exchange(spark, tmp_dir):
    records_from_dir(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw")
    df = latest(valid_rows(route_records(spark.read.parquet(f"{tmp_dir}/raw"))))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PythonUDF" not in plan
