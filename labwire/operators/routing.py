"""Routing (F1-F8), route counters (G1), the dead-letter projection
and the reject report (T13)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwire.functions.text import preview
from labwire.operators.parse import accepts

# The route names, in the order their tests apply (first wins).
ROUTES = ("empty", "unparseable", "no_message_id", "bad_mfl", "dlq", "valid")
# Routes that the deserializer emits as orders (the rest are dropped early).
EMITTED = ("bad_mfl", "dlq", "valid")
MFL_LENGTH = 4


def has_message_id(c: Column) -> Column:
    """F3/F4."""
    return c.isNotNull() & (c != "")


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 code units, as a JVM string counts it: Spark's
    ``length`` counts code points, so add one per supplementary character."""
    return F.length(c) + F.regexp_count(c, F.lit("[\\x{10000}-\\x{10FFFF}]"))


def mfl_ok(c: Column) -> Column:
    """non-null, non-empty, exactly 4 characters (any characters)."""
    return c.isNotNull() & (c != "") & (utf16_length(c) == MFL_LENGTH)


def has_lab_code(c: Column) -> Column:
    """F6, written so that it can reach a scan as a pushed filter."""
    return c.isNotNull() & (c != "")


def missing_lab_code(c: Column) -> Column:
    """the exact complement of F6 (keeps nulls)."""
    return c.isNull() | (c == "")


@functools.cache
def route_column(structure: str = "OML_O21", version: str = "2.5") -> Column:
    """F8: total classification over an extracted frame."""
    return (
        F.when(F.col("is_empty"), F.lit("empty"))
        .when(~accepts(structure, version), F.lit("unparseable"))
        .when(~has_message_id(F.col("message_ref_id")), F.lit("no_message_id"))
        .when(~mfl_ok(F.col("mfl_code")), F.lit("bad_mfl"))
        .when(missing_lab_code(F.col("lab_code")), F.lit("dlq"))
        .otherwise(F.lit("valid"))
    )


def with_route(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("route", route_column())


def route_counts(routed: DataFrame) -> DataFrame:
    """G1 (batch): one row per route with its count (partial aggregation)."""
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def dead_letters(routed: DataFrame) -> DataFrame:
    """F7 + P18: the raw text of orders without a lab code."""
    return routed.filter(F.col("route") == "dlq").select(F.col("raw_message").alias("value"))


def reject_report(routed: DataFrame, n: int = 100) -> DataFrame:
    """Dropped records with their reason and a text preview."""
    return routed.filter(F.col("route").isin("empty", "unparseable", "no_message_id", "bad_mfl")).select(
        "offset", "route", preview("raw_message", n).alias("preview")
    )
