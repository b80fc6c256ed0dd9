"""Last write wins (W1), table upsert (K1b) and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from labwire.operators.numbering import number_rows_counted
from labwire.session import checkpoint_dir

KEY = "message_ref_id"
ARRIVAL_ORDER = ("partition", "offset")
# ids of new keys follow their first arrival; offsets of one message id share
# a partition, so ordering by offset then partition is deterministic
ID_ORDER = ("offset", "partition")


def latest(
    df: DataFrame, key: str = KEY, order: Sequence[str] = ARRIVAL_ORDER, first_as: str | None = None
) -> DataFrame:
    """Per key, the row that arrived last (all columns kept).

    ``max_by`` is an aggregate, so each map task first keeps its own latest
    row per key and only those cross the shuffle: a key that holds a third of
    the feed still sends one row per task, and no group is collected.
    ``first_as`` also keeps the first arrival (struct of ``ID_ORDER``).
    """
    others = [c for c in df.columns if c != key]
    aggs = [F.max_by(F.struct(*others), F.struct(*order)).alias("_last")]
    if first_as:
        aggs.append(F.min(F.struct(*ID_ORDER)).alias(first_as))
    out = df.groupBy(key).agg(*aggs)
    cols = [key, "_last.*"] + ([first_as] if first_as else [])
    return out.select(*cols)


def latest_of_stored(df: DataFrame, key: str = KEY, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """W1 for rows that are cheap to read twice (a stored or persisted frame).

    The arrival (two whole numbers, the second below 10^19) becomes one decimal, so
    the newest arrival per key is a hash aggregate over two narrow columns: nothing
    is sorted before the exchange.  The rows are then joined with it by key and
    arrival.  A record that is stored twice (equal arrival) counts once.
    """
    high, low = order
    at = (F.col(high).cast("decimal(18,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + F.col(low).cast("decimal(19,0)")).cast("decimal(38,0)")
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max(at).alias("_at"))
    rows = df.join(newest, F.col(key).eqNullSafe(F.col("_key")) & (at == F.col("_at")), "left_semi")
    return rows.dropDuplicates([key])


def upsert(
    target: DataFrame,
    updates: DataFrame,
    columns: Sequence[str],
    key: str = KEY,
    id_col: str = "id",
    order: Sequence[str] = ARRIVAL_ORDER,
    start_after: int | None = None,
    counts: dict | None = None,
) -> DataFrame:
    """The state after inserting ``updates`` into ``target`` with
    ``ON CONFLICT (key) DO UPDATE`` semantics.

    * per key the latest update wins (W1), including repeats in one batch;
    * an existing key keeps its ``id`` and takes the update's ``columns``;
    * a new key gets the next id after ``max(target.id)``, in first-arrival
      order (C5); keys not in ``updates`` are untouched;
    * a null column stays null (C4: defaults such as the current date apply
      only to omitted columns, and the upsert names every column).

    ``target`` has ``id_col``, ``key`` and ``columns``; ``updates`` has
    ``key``, ``columns`` and the arrival columns.  ``start_after`` gives the
    table's current maximum id when ``target`` is only part of the table;
    ``counts`` (a dict) receives ``new_keys`` and the new ``max_id``.

    The target is read once: it meets the batch in one full outer join, the
    merged state is written once (reliably, so a lost executor does not re-run
    the upstream parse), and the job that writes it observes the largest id.
    """
    value_cols = [c for c in columns if c not in (key, id_col)]
    spark = updates.sparkSession
    checkpoint_dir(spark)
    u = latest(updates.select(key, *value_cols, *order), key, order, first_as="_first")
    u = u.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in value_cols], "_first")
    merged = target.select(id_col, key, *value_cols).join(u, F.col(key) == F.col("_key"), "full_outer")
    taken = F.col("_first").isNotNull()
    merged = merged.select(id_col, F.coalesce(key, "_key").alias(key),
                           *[F.when(taken, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in value_cols], "_first")
    seen = Observation()
    merged = merged.observe(seen, F.max(id_col).alias("max_id")).checkpoint(eager=True)

    new_keys = merged.filter(F.col(id_col).isNull()).drop(id_col)
    max_id = start_after if start_after is not None else (seen.get["max_id"] or 0)
    numbered, n_new = number_rows_counted(new_keys, [F.col("_first"), F.col(key)], name=id_col, start=max_id + 1)
    if counts is not None:
        counts["new_keys"] = n_new
        counts["max_id"] = max_id + n_new

    cols = [id_col, key, *value_cols]
    return merged.filter(F.col(id_col).isNotNull()).select(*cols).unionByName(numbered.select(*cols))


def empty_like(df: DataFrame, columns: Sequence[str], id_col: str = "id") -> DataFrame:
    """An empty target with ``id`` plus the given columns of ``df``."""
    spark = df.sparkSession
    schema = df.select(F.lit(0).cast("long").alias(id_col), *columns).schema
    return spark.createDataFrame([], schema)
