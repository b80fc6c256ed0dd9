"""Contracts on the stored table (C1-C6, G2) and reference-key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "message_ref_id"

# Fixed values of the stored table's contract.
NOT_NULL = ("mfl_code", "order_id", "test_id", "order_date", "order_time", "message_ref_id")
MAX_LENGTH = {"order_id": 50, "message_ref_id": 100, "sending_application": 25, "lab_code": 10}


class ContractViolation(Exception):
    """Raised by :func:`enforce` in ``fail`` mode (a rejected sink batch)."""


def _hits(not_null: Sequence[str], max_length: Mapping[str, int]):
    checks = [
        F.when(F.col(c).isNull(), F.struct(F.lit("not_null").alias("rule"), F.lit(c).alias("column_name")))
        for c in not_null
    ] + [
        F.when(
            F.length(c) > n, F.struct(F.lit("max_length").alias("rule"), F.lit(c).alias("column_name"))
        )
        for c, n in max_length.items()
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def violations(
    df: DataFrame,
    key: str = KEY,
    not_null: Sequence[str] = NOT_NULL,
    max_length: Mapping[str, int] = MAX_LENGTH,
) -> DataFrame:
    """One row ``(key, rule, column_name)`` per broken rule.

    All rules are checked in a single pass: each row yields an array of
    (rule, column) hits that is exploded, so there is no union of scans.
    """
    return df.select(key, F.inline(_hits(not_null, max_length)))


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check(df: DataFrame, facilities: DataFrame | None = None, labs: DataFrame | None = None) -> DataFrame:
    """C1, C2, C6, J1, J2 in one pass: ``df`` plus ``violations``, an array of
    ``(rule, column_name)``, empty for a clean row.  The reference sides are
    optional; each is made distinct, so the left joins keep one row per row."""
    hits = _hits(NOT_NULL, MAX_LENGTH)
    out, cols = df, df.columns
    for dim, column in ((facilities, "mfl_code"), (labs, "lab_code")):
        if dim is None:
            continue
        known = dim.select(column).filter(F.col(column).isNotNull()).distinct().withColumn(f"_{column}", F.lit(True))
        out = out.join(known, column, "left")
        unknown = F.col(column).isNotNull() & F.col(f"_{column}").isNull()
        hit = F.struct(F.lit("reference").alias("rule"), F.lit(column).alias("column_name"))
        hits = F.concat(hits, F.when(unknown, F.array(hit)).otherwise(F.filter(F.array(hit), lambda _: F.lit(False))))
    return out.select(*cols, hits.alias("violations"))


def enforce(df: DataFrame, mode: str = "fail", key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """``fail`` raises on the first violation (as a rejected batch does);
    ``quarantine`` splits into (clean rows, violating rows) instead.

    The rules are per row, so the split is two filters over one flag: no
    join and no shuffle.
    """
    if mode == "fail":
        first = violations(df, key).take(1)
        if first:
            raise ContractViolation(f"contract broken: {first[0].asDict()}")
        return df, df.limit(0)
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    broken = F.size(_hits(NOT_NULL, MAX_LENGTH)) > 0
    return df.filter(~broken), df.filter(broken)


# No broadcast hint on the reference sides below: the planner and AQE broadcast
# them when their measured size allows it.

def facility_violations(df: DataFrame, facilities: DataFrame) -> DataFrame:
    """Rows whose ``mfl_code`` is null or not a known facility."""
    return df.join(facilities.select("mfl_code").distinct(), "mfl_code", "left_anti")


def facility_known(df: DataFrame, facilities: DataFrame) -> DataFrame:
    """J1 (keep side): rows with a known facility."""
    return df.join(facilities.select("mfl_code").distinct(), "mfl_code", "left_semi")


def lab_violations(df: DataFrame, labs: DataFrame) -> DataFrame:
    """Rows with a non-null ``lab_code`` that is not a known lab (null passes)."""
    return df.filter(F.col("lab_code").isNotNull()).join(labs.select("lab_code").distinct(), "lab_code", "left_anti")


def check_renames(renames: DataFrame) -> None:
    """A code that is renamed to two codes is refused."""
    twice = renames.groupBy("old_code").agg(F.count_distinct("new_code").alias("n")).filter("n > 1").take(1)
    if twice:
        raise ValueError(f"facility code {twice[0]['old_code']!r} is mapped to {twice[0]['n']} codes")


def rename_facilities(df: DataFrame, renames: DataFrame) -> DataFrame:
    """Propagate facility code changes (``old_code -> new_code``).  One row stays one
    row: a code that is mapped to two codes fails the query when it runs."""
    twice = F.concat(F.lit("facility code mapped twice: "), F.col("mfl_code"))
    m = renames.groupBy(F.col("old_code").alias("mfl_code")).agg(F.min("new_code").alias("lo"), F.max("new_code").alias("hi"))
    m = m.select("mfl_code", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.raise_error(twice)).alias("new_code"))
    cols = [F.coalesce("new_code", "mfl_code").alias("mfl_code") if c == "mfl_code" else F.col(c) for c in df.columns]
    return df.join(m, "mfl_code", "left").select(*cols)


def blocked_deletes(to_delete: DataFrame, df: DataFrame, column: str = "mfl_code") -> DataFrame:
    """J3 delete guard: reference codes that cannot be deleted (still used)."""
    # distinct first (partial aggregation), so a hot code sends one row per task
    used = df.select(column).distinct()
    return to_delete.select(column).distinct().join(used, column, "left_semi")
