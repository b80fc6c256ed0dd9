"""Lookups the stored table is indexed for (O1-O4), as DataFrame queries.

Ordered results carry an explicit rank column (dense, from 1) so they can be
compared as sets; ranks come from a distributed sort, not a global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.operators.numbering import number_rows

KEY = "message_ref_id"


def lookup(df: DataFrame, column: str, value) -> DataFrame:
    """O3: rows with ``column = value`` (a pushed-down filter on a table)."""
    return df.filter(F.col(column) == F.lit(value))


def lookup_many(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """O3 for a set of values: a semi join (no row multiplication)."""
    return df.join(keys.select(column).distinct(), column, "left_semi")


def facility_test(df: DataFrame, mfl_code, test_id) -> DataFrame:
    """O2: equality on facility and test."""
    return df.filter((F.col("mfl_code") == F.lit(mfl_code)) & (F.col("test_id") == F.lit(test_id)))


def facility_timeline(df: DataFrame, mfl_code, rank: str | None = "rn") -> DataFrame:
    """O1: one facility, newest first (order date descending, nulls first).
    ``rank=None`` gives the rows in order, without ranks and without a checkpoint."""
    rows = df.filter(F.col("mfl_code") == F.lit(mfl_code))
    return _ordered(rows, [F.col("order_date").desc_nulls_first(), F.col(KEY).asc()], rank)


def by_date(df: DataFrame, rank: str | None = "rn") -> DataFrame:
    """The whole table by order date descending, nulls last (``rank`` as above)."""
    return _ordered(df, [F.col("order_date").desc_nulls_last(), F.col(KEY).asc()], rank)


def _ordered(rows: DataFrame, order: list, rank: str | None) -> DataFrame:
    return rows.orderBy(*order) if rank is None else number_rows(rows, order, name=rank)


def busiest(df: DataFrame, *cols: str) -> DataFrame:
    """The most frequent value combination of ``cols`` (ties: smallest values).

    A partial aggregation then a top-1: returns a one-row frame to join on.
    """
    counts = df.filter(F.col(cols[0]).isNotNull()).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), *[F.col(c).asc() for c in cols]).limit(1).drop("_n")


def date_layout(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O4 storage layout: partitioned by order date, facility-sorted files,
    so date ranges prune partitions and facility filters skip row groups.

    Rows are dealt by ranges of date, facility and key, so a date (or the
    null date) that holds a third of the rows is written by many tasks."""
    (
        df.repartitionByRange("order_date", "mfl_code", KEY)
        .sortWithinPartitions("order_date", "mfl_code")
        .write.mode(mode)
        .partitionBy("order_date")
        .parquet(path)
    )


