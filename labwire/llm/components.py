"""Connected components by alternating stars, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c


def _sum(df: DataFrame) -> tuple:
    row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links between long ids -> (node, component), the least id of each component.

    Each round sends every node's larger neighbours, then its smaller ones, to
    its least neighbour; the links become stars in a logarithmic number of
    rounds.  Rounds end when the set of links no longer changes.
    """
    links = c.staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    before = _sum(links)
    while before[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        links = c.staged(small, "links")
        now = _sum(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
