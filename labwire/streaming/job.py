"""The continuous job (S1 -> K1 + K4) as a Structured Streaming query.

The stream carries the same ``DataFrame -> DataFrame`` transforms as the batch
plans.  There is no watermark, window or state (R1, R2): every record is
routed on its own, and the only keyed work — last write wins and the merge —
happens per micro-batch inside ``foreachBatch`` (K5), where the orders of the
batch are persisted once, checked against the table's contract (C6) and fed
to both sinks.  Offsets live in the checkpoint, so a
restart resumes where the last committed batch ended and the idempotent merge
absorbs a replayed batch (R4); a fresh checkpoint replays the whole topic.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labwire.operators import contracts
from labwire.operators.orders import ORDER_COLUMNS
from labwire.operators.routing import ROUTES, dead_letters
from labwire.plans.pipeline import route_records, valid_rows
from labwire.sources.records import ARRIVAL, RAW_SCHEMA

QUERY_NAME = "lab-orders-to-table"
# K2: the original sink flushed at least every 200 ms
DEFAULT_TRIGGER = {"processingTime": "200 milliseconds"}

BatchFn = Callable[[DataFrame, int], None]
# A reference table, read anew for each batch (codes may be added meanwhile).
Reference = Callable[[SparkSession], DataFrame]

# A batch with a violating row fails (as a database with these constraints
# rejects it), or such rows go to a sink of their own, or nothing is checked.
CONTRACT_MODES = ("fail", "quarantine", "off")


# What the sinks read of a routed record.
BATCH_COLUMNS = [*ARRIVAL, *ORDER_COLUMNS, "route"]
COMPRESSED = "spark.sql.inMemoryColumnarStorage.compressed"


def observe_routes(routed: DataFrame, name: str = "routes") -> DataFrame:
    """G1 for streams: per-route counts in every progress report."""
    return routed.observe(name, *[F.count_if(F.col("route") == r).alias(r) for r in ROUTES])


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder of raw records (the Kafka stand-in used in tests)."""
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


class FanOut:
    """K5: one routed micro-batch -> upsert sink (valid) + dead-letter sink.

    The rows that reach a sink are persisted once (dropped records are not,
    and the raw text only of dead letters) and all sinks read them.  With
    ``parallel`` the sinks run as concurrent Spark jobs (the dead-letter
    write is a single narrow stage that fills cores the merge leaves idle),
    once one job has parsed the batch: concurrent jobs over rows that are not
    stored yet would each parse them.  An error in any sink fails the batch,
    which Spark then re-runs.

    ``contract`` is one of ``CONTRACT_MODES``.  Every valid row is checked,
    also one that a later row of the batch replaces.  ``fail`` raises before
    any sink has written; ``quarantine`` hands the violating rows (with their
    ``violations``) to the sink of that name and the clean ones to the table.
    ``facilities`` and ``labs`` add the reference checks J1 and J2.

    ``counts`` receives every record of the batch with its ``route`` (G1); the
    dropped ones are then persisted too, without their text.
    """

    def __init__(self, upsert: BatchFn, dead: BatchFn, parallel: bool = True, contract: str = "fail",
                 quarantine: BatchFn | None = None, facilities: Reference | None = None,
                 labs: Reference | None = None, counts: BatchFn | None = None):
        if contract not in CONTRACT_MODES:
            raise ValueError(f"contract is one of {CONTRACT_MODES}, not {contract!r}")
        if contract == "quarantine" and quarantine is None:
            raise ValueError("quarantine needs a sink for the violating rows")
        self.upsert = upsert
        self.dead = dead
        self.parallel = parallel
        self.contract = contract
        self.quarantine = quarantine
        self.facilities = facilities
        self.labs = labs
        self.counts = counts

    def _jobs(self, routed: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        valid = valid_rows(routed)
        jobs = [lambda: self.dead(dead_letters(routed), batch_id)]
        if self.contract == "off":
            return [lambda: self.upsert(valid, batch_id), *jobs]
        spark = routed.sparkSession
        checked = contracts.check(valid, self.facilities and self.facilities(spark), self.labs and self.labs(spark))
        broken = F.size("violations") > 0
        if self.contract == "fail":
            first = checked.filter(broken).select(contracts.KEY, "violations").take(1)
            if first:
                raise contracts.ContractViolation(f"contract broken: {first[0].asDict(recursive=True)}")
            return [lambda: self.upsert(valid, batch_id), *jobs]
        return [lambda: self.upsert(checked.filter(~broken).drop("violations"), batch_id),
                lambda: self.quarantine(checked.filter(broken), batch_id), *jobs]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        letters = F.when(F.col("route") == "dlq", F.col("raw_message"))
        routed = batch if self.counts else batch.filter(F.col("route").isin("valid", "dlq"))
        routed = routed.withColumn("raw_message", letters).select(*BATCH_COLUMNS)
        # read once or twice: not worth trying encodings on every value (the setting counts when the rows are stored)
        conf, compressed = routed.sparkSession.conf, routed.sparkSession.conf.get(COMPRESSED)
        conf.set(COMPRESSED, "false")
        routed = routed.persist()
        try:
            jobs = self._jobs(routed, batch_id)
            if self.counts:
                jobs.append(lambda: self.counts(routed, batch_id))
            if not self.parallel:
                for job in jobs:
                    job()
                return
            routed.count()
            with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
                for f in [pool.submit(job) for job in jobs]:
                    f.result()
        finally:
            routed.unpersist()
            conf.set(COMPRESSED, compressed)


def start(
    raw: DataFrame,
    on_batch: BatchFn,
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str = QUERY_NAME,
) -> StreamingQuery:
    """Start the job; ``trigger={"availableNow": True}`` for a bounded run."""
    routed = observe_routes(route_records(raw))
    return (
        routed.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(query_name)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )
