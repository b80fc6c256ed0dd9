"""K1 on a file table: an idempotent, bucket-local upsert per micro-batch.

Layout: parquet, partitioned by ``bucket = pmod(xxhash64(key), buckets)``.
A batch rewrites only the buckets its keys fall into (dynamic partition
overwrite), so its cost follows the touched buckets rather than the table.
Steps per batch:

1. last write wins inside the batch (W1, partial aggregation);
2. the touched bucket numbers (at most ``buckets`` values) go to the driver;
3. the touched buckets are read (partition pruning), merged with the batch
   (K1b; new keys numbered after the table's ``max(id)``) and written
   completely to ``_staging/<query>/batch=<id>``;
4. the new ``max(id)`` is recorded in ``_state`` (a gap after a crash is
   harmless, a repeated id is not), then the staged buckets replace the
   table's buckets, the batch is marked done and its staging copy deleted.

If the job dies during step 4, the re-run of the same batch id finds the
complete staging copy and repeats step 4 only; if it dies earlier, the table
is untouched and the batch is recomputed.  Replaying a batch that already
committed leaves the table unchanged (the upsert is idempotent).  Staging
folders are keyed by the query's own id (new for every fresh checkpoint, also
at the same path) and the batch id, so a redeploy never reuses another run's
staging copy.  The bucket count is stored with the table; another is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwire.operators import upsert as up
from labwire.operators.schema import LAB_ORDER_COLUMNS, LAB_ORDER_SCHEMA
from labwire.sinks import files

KEY = "message_ref_id"


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


class TableUpsertSink:
    def __init__(self, path: str, buckets: int = 64, key: str = KEY,
                 columns: Sequence[str] = tuple(c for c in LAB_ORDER_COLUMNS if c not in ("id", KEY))):
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.key = key
        self.columns = list(columns)

    def _staging(self, tag: str, batch_id: int) -> str:
        return f"{self.path}/_staging/{tag}/batch={batch_id}"

    def _committed(self) -> str:
        return f"{self.path}/_committed"

    def _state(self) -> str:
        return f"{self.path}/_state"

    def max_id(self, spark) -> int:
        """The table's largest id: from the ``_state`` file (one number); a
        full scan of the id column only if the file is missing or torn (a
        crash while it was rewritten)."""
        text = files.read_text(spark, self._state())
        if text and text.strip().isdigit():
            return int(text)
        if not self._have_table(spark):
            return 0
        return spark.read.parquet(self.path).agg(F.max("id")).first()[0] or 0

    def _have_table(self, spark) -> bool:
        return files.any_match(spark, f"{self.path}/bucket=*")

    def _check_buckets(self, spark) -> None:
        stored = files.read_text(spark, f"{self.path}/_buckets")
        if stored is None:
            files.write_text(spark, f"{self.path}/_buckets", str(self.buckets))
        elif int(stored) != self.buckets:
            raise ValueError(f"{self.path} has {stored} buckets, not {self.buckets}: keys would be stored twice")

    def _record_max_id(self, spark, before: int, staging: str, staged: DataFrame) -> None:
        # ids are dense: the staging copy records the new maximum; a staging
        # copy without it (written by an older version) is scanned instead
        text = files.read_text(spark, f"{staging}/_max_id")
        after = int(text) if text and text.strip().isdigit() else (staged.agg(F.max("id")).first()[0] or 0)
        files.write_text(spark, self._state(), str(max(before, after)))

    def for_query(self, checkpoint: str):
        """The ``foreachBatch``-style merge for the query with this checkpoint."""
        return lambda rows, batch_id: self.merge(rows, batch_id, files.query_id(rows.sparkSession, checkpoint))

    def _files(self, spark) -> DataFrame:
        """The table's files under its declared schema (K7): a column that older files lack
        is null there.  A column that is not declared is taken as the files have it."""
        known = {f.name: f.dataType for f in LAB_ORDER_SCHEMA.fields}
        wanted = ["id", self.key, *self.columns]
        if all(c in known for c in wanted):
            fields = [T.StructField(c, known[c]) for c in wanted]
            return spark.read.schema(T.StructType([*fields, T.StructField("bucket", T.IntegerType())])).parquet(self.path)
        return spark.read.parquet(self.path)

    def read(self, spark) -> DataFrame:
        return self._files(spark).select("id", self.key, *self.columns)

    def merge(self, rows: DataFrame, batch_id: int, tag: str = "batch") -> None:
        """Upsert ``rows`` (key, columns, partition, offset) as batch ``batch_id``."""
        spark = rows.sparkSession
        self._check_buckets(spark)
        staging, done = self._staging(tag, batch_id), f"{self.path}/_done/{tag}-{batch_id}"
        if files.exists(spark, done):
            return  # this batch of this query is in the table
        before = self.max_id(spark)
        if not files.complete(spark, staging):
            self._stage(rows, staging, before)
        staged = spark.read.parquet(staging)
        self._record_max_id(spark, before, staging, staged)
        self._replace(staged)
        self._mark(spark, staging, done, f"{self.path}/_done/{tag}-{batch_id - 1}")

    def _replace(self, staged: DataFrame) -> None:
        """The staged buckets take the place of the table's."""
        (
            staged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(self.path)
        )

    def _mark(self, spark, staging: str, done: str, done_before: str) -> None:
        files.touch(spark, self._committed())
        files.touch(spark, done)
        files.delete(spark, staging)
        files.delete(spark, done_before)  # only the last batch can run again

    def _stage(self, rows: DataFrame, staging: str, max_id: int) -> None:
        spark = rows.sparkSession
        batch = rows.withColumn("bucket", bucket_of(self.key, self.buckets))
        have_table = self._have_table(spark)
        if have_table:
            touched = [r[0] for r in batch.select("bucket").distinct().collect()]  # <= buckets values
            current = self._files(spark).filter(F.col("bucket").isin(touched))
            target = current.select("id", self.key, *self.columns)
        else:
            target = up.empty_like(rows, [self.key, *self.columns])
        counts: dict = {}
        merged = up.upsert(target, batch, self.columns, key=self.key, start_after=max_id, counts=counts)
        (
            merged.withColumn("bucket", bucket_of(self.key, self.buckets))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")  # dynamic mode leaves no marker of a finished write
            .partitionBy("bucket")
            .parquet(staging)
        )
        # written after the data; if a crash loses it, the staged ids are scanned
        files.write_text(spark, f"{staging}/_max_id", str(counts["max_id"]))
