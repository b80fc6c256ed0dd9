"""Dense, ordered row numbers without a single-partition window.

``row_number()`` over a window with no ``partitionBy`` moves every row into
one task.  Here the rows are range-partitioned and sorted on the ordering
(a distributed sort), the sorted result is checkpointed so that it cannot be
re-sampled differently on recomputation or executor loss, and each row's
number is its partition's offset plus its position inside the partition.
The rows by partition are observed by the job that writes the checkpoint, so
the frame is written once and not read again to be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from labwire.session import checkpoint_dir


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str = "rn",
    start: int | Column = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = ``start``, ``start+1``, ... following ``order``.

    ``order`` should be a total order (end it with a unique column) so the
    numbering is deterministic.  ``start`` may be a literal or a column.
    """
    return number_rows_counted(df, order, name, start, num_partitions)[0]


def number_rows_counted(df: DataFrame, order: list[Column], name: str = "rn", start: int | Column = 1,
                        num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """:func:`number_rows` plus the row count, the sum of the counts by
    partition that the numbering gathers anyway."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = (
        df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    )
    # a histogram with a bin for every partition holds exact counts
    bins = max(2, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    seen = Observation()
    ordered = (
        parts.sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .observe(seen, F.histogram_numeric("_part", F.lit(bins)).alias("rows"), F.max("_part").alias("last"))
        .checkpoint(eager=True)
    )
    counts = {round(b["x"]): round(b["y"]) for b in seen.get["rows"] or []}
    if counts and seen.get["last"] >= bins:  # more partitions than asked for: bins may have been merged
        counts = dict(ordered.groupBy("_part").count().collect())
    before, rows = 0, []
    for part in sorted(counts):
        rows.append((part, part << 33, before))  # positions of a partition start there
        before += counts[part]
    offsets = spark.createDataFrame(rows, "_part int, _pos0 long, _before long")
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = ordered.join(F.broadcast(offsets), "_part").withColumn(
        name, (start_col + F.col("_before") + F.col("_pos") - F.col("_pos0")).cast("long")
    )
    return out.drop("_part", "_pos", "_pos0", "_before"), before
