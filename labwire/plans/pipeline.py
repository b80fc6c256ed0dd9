"""Composed batch plans shared by the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwire.operators.orders import ORDER_POSITIONS, extract_orders, extract_routing, sink_projection
from labwire.operators.parse import GATE_POSITIONS, parse_messages, segments_of
from labwire.operators.routing import with_route
from labwire.sources.fixtures import read_tables, records_from_dir
from labwire.sources.records import ARRIVAL


def default_width(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def route_records(records: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Raw records -> every record with its order fields and route (F8)."""
    segments = segments_of(GATE_POSITIONS + ORDER_POSITIONS)
    return with_route(extract_orders(parse_messages(records, min_partitions=min_partitions, segments=segments, flat=True)))


def route_only(records: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Raw records -> every record with its route: the header alone is split,
    and neither the raw text nor another segment leaves the first stage."""
    parsed = parse_messages(records, min_partitions=min_partitions, segments=("msh",), with_raw=False)
    return with_route(extract_routing(parsed))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_records(records_from_dir(spark, sf_dir, default_width(spark)))


def valid_rows(routed_df: DataFrame) -> DataFrame:
    """F4-F6 + P15 with the arrival columns kept for last-write-wins."""
    return sink_projection(routed_df.filter(F.col("route") == "valid"), ARRIVAL)


def order_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of orders (one scalar), used by the fixture's upsert split."""
    (orders,) = read_tables(spark, sf_dir, "orders")
    return orders.count()


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference facilities (FIXTURES §6): ``1000 + c_custkey % 9000`` for
    customers with ``c_custkey % 20 <> 0``; at most 9000 rows by construction."""
    (customer,) = read_tables(spark, sf_dir, "customer")
    return (
        customer.filter(F.col("c_custkey") % 20 != 0)
        .select((F.lit(1000) + F.col("c_custkey") % 9000).cast("string").alias("mfl_code"))
        .distinct()
    )


def lab_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference labs: ``L00``..``L22`` from the nation table (at most 25 rows)."""
    (nation,) = read_tables(spark, sf_dir, "nation")
    return nation.filter(F.col("n_nationkey") <= 22).select(
        F.concat(F.lit("L"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("lab_code")
    )


def facility_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename map: facilities of customers with ``c_custkey % 50 = 0`` become
    ``9`` + their last three digits (bounded like the facilities)."""
    (customer,) = read_tables(spark, sf_dir, "customer")
    code = (F.lit(1000) + F.col("c_custkey") % 9000).cast("string")
    return (
        customer.filter(F.col("c_custkey") % 50 == 0)
        .select(code.alias("old_code"), F.concat(F.lit("9"), F.substring(code, -3, 3)).alias("new_code"))
        .distinct()
    )
