"""K1 as merge on read: an append-only table of deltas.

A batch is reduced to its newest row per key (W1) and written as one folder

    <path>/seq=<n>/writer=<query id>/batch=<batch id>/

and nothing else is read or rewritten, so a batch costs what it holds, whatever
the table's size.  ``seq`` is the order of the appends over all writers, claimed
by creating ``_claims/<n>``.  Reading resolves the deltas: per key the row of the
highest ``seq`` counts, and the id is the key's rank by first arrival, which no
later append changes.

* Replay (R4): a batch that runs again finds its folder; a complete one (with
  Spark's ``_SUCCESS`` marker) stays, another is overwritten in place.  Folders
  without the marker are not read.
* Redeploy (S2): a new query has another id, so its deltas come behind; what it
  reads again is written again, and the last write wins as in a database.
* K7: files are read with the table's declared schema, so a column that older
  files lack is null there.
* J3: an update appends new versions of the matching rows alone.

The read is one hash aggregate over keys and order values (two columns of the
files) and a join back, so no task sorts or holds all versions of a row.  Ids are
given to the keys before that join: numbering sorts and writes no other column.
Reading costs grow with the appends; ``copy_to`` writes the current state as the
first delta of another table.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwire.operators import contracts
from labwire.operators import upsert as up
from labwire.operators.numbering import number_rows
from labwire.operators.schema import LAB_ORDER_SCHEMA
from labwire.sinks import files

KEY = "message_ref_id"
#: Order of first arrivals inside a delta: offset, then partition (of at most 9999).
_FIRST = T.DecimalType(23, 0)
_ORDER = T.DecimalType(38, 0)


def first_value(offset: Column, partition: Column) -> Column:
    return (offset.cast(T.DecimalType(19, 0)) * F.lit(10_000).cast(T.DecimalType(5, 0)) + partition.cast(T.DecimalType(5, 0))).cast(_FIRST)


class DeltaTable:
    def __init__(self, path: str, schema: T.StructType = LAB_ORDER_SCHEMA, key: str = KEY, id_col: str = "id"):
        self.path = path.rstrip("/")
        self.key = key
        self.id_col = id_col
        self.columns = [f.name for f in schema.fields if f.name not in (key, id_col)]
        kept = [T.StructField(f.name, f.dataType) for f in schema.fields if f.name != id_col]
        self.stored = T.StructType([*kept, T.StructField("_first", _FIRST), T.StructField("seq", T.LongType()),
                                    T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])

    # -- appends ---------------------------------------------------------------

    def _claim(self, spark: SparkSession) -> int:
        """The next number of the append order; creating its file claims it."""
        taken = [int(name) for name in files.children(spark, f"{self.path}/_claims") if name.isdigit()]
        n = max(taken, default=0)
        while True:
            n += 1
            try:
                files.create_new(spark, f"{self.path}/_claims/{n}")
                return n
            except Py4JJavaError as e:
                if not files.exists(spark, f"{self.path}/_claims/{n}"):
                    raise e

    def _folder(self, spark: SparkSession, writer: str, batch_id: int) -> str:
        tail = f"writer={writer}/batch={batch_id}"
        found = files.matches(spark, f"{self.path}/seq=*/{tail}")
        return found[0] if found else f"{self.path}/seq={self._claim(spark)}/{tail}"

    def for_query(self, checkpoint: str):
        """The ``foreachBatch``-style append for the query with this checkpoint."""
        return lambda rows, batch_id: self.append(rows, batch_id, files.query_id(rows.sparkSession, checkpoint))

    def append(self, rows: DataFrame, batch_id: int, writer: str = "batch") -> None:
        """Store ``rows`` (key, columns, partition, offset) as batch ``batch_id`` of ``writer``."""
        newest = up.latest(rows.select(self.key, *self.columns, *up.ARRIVAL_ORDER), self.key, first_as="_f")
        first = first_value(F.col("_f.offset"), F.col("_f.partition"))
        self._write(newest.select(self.key, *self.columns, first.alias("_first")), writer, batch_id)

    def _write(self, delta: DataFrame, writer: str, batch_id: int) -> None:
        spark = delta.sparkSession
        folder = self._folder(spark, writer, batch_id)
        if not files.complete(spark, folder):
            delta.write.mode("overwrite").parquet(folder)

    # -- reads -----------------------------------------------------------------

    def deltas(self, spark: SparkSession) -> DataFrame:
        """Every stored version: key, columns, ``_first``, seq, writer, batch."""
        whole = [p.rsplit("/", 1)[0] for p in files.matches(spark, f"{self.path}/seq=*/writer=*/batch=*/_SUCCESS")]
        if not whole:
            return spark.createDataFrame([], self.stored)
        return spark.read.schema(self.stored).option("basePath", self.path).parquet(*whole)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """``_key``, the append of its newest version and the ``_order`` of its first arrival; a
        version without a key is none (the join with the rows by key drops it)."""
        order = F.col("seq").cast(T.DecimalType(15, 0)) * F.lit(str(10**23)).cast(T.DecimalType(24, 0)) + F.col("_first")
        keyed = rows.filter(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_key"))
        return keyed.agg(F.max("seq").alias("_seq"), F.min(order.cast(_ORDER)).alias("_order"))

    def _versions(self, rows: DataFrame, newest: DataFrame) -> DataFrame:
        return rows.join(newest, (F.col(self.key) == F.col("_key")) & (F.col("seq") == F.col("_seq")))

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest version of every key, with ``_order`` (of its first arrival) and no id."""
        rows = self.deltas(spark)
        return self._versions(rows, self._newest(rows)).select(self.key, *self.columns, "_order")

    def read(self, spark: SparkSession) -> DataFrame:
        """The table: id (dense, by first arrival), key, columns."""
        rows = self.deltas(spark)
        ids = number_rows(self._newest(rows), [F.col("_order"), F.col("_key")], name=self.id_col)
        return self._versions(rows, ids).select(self.id_col, self.key, *self.columns)

    # -- other writes ------------------------------------------------------------

    def update(self, spark: SparkSession, change, name: str | None = None) -> None:
        """Append a new version of some current rows: ``change`` takes the current rows (key,
        columns) and returns those that change, with their new values.  ``name`` makes the
        update repeatable: one of a name that is stored already is not applied again."""
        rows = change(self.current(spark).drop("_order"))
        # an updated key exists: its id order is that of an earlier delta, and this one's is larger
        last = F.lit("9" * 19).cast(_FIRST)
        self._write(rows.select(self.key, *self.columns, last.alias("_first")), name or f"update-{uuid.uuid4().hex}", 0)

    def rename_facilities(self, spark: SparkSession, renames: DataFrame, name: str | None = None) -> None:
        """J3 (ON UPDATE CASCADE): rows of a facility whose code changes take the new code.
        Only they are written.  A code that is mapped twice is refused."""
        contracts.check_renames(renames)

        def change(rows):
            codes = renames.select(F.col("old_code").alias("mfl_code")).distinct()
            return contracts.rename_facilities(rows.join(codes, "mfl_code", "left_semi"), renames)

        self.update(spark, change, name)

    def copy_to(self, spark: SparkSession, other: DeltaTable) -> None:
        """The current state, ids included, as the first delta of another (empty) table."""
        if files.matches(spark, f"{other.path}/seq=*"):
            raise ValueError(f"{other.path} is not empty")
        state = self.read(spark)
        other._write(state.select(self.key, *self.columns, F.col(self.id_col).cast(_FIRST).alias("_first")), "copy", 0)
