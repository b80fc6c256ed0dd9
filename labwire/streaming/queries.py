"""Registered stream queries: bounded ``availableNow`` runs over a file source
fed in chunks, restarting from the checkpoint for every chunk (S1 S2 K1 K2
K4 K5 R1-R5).  The expected result is the batch result over all records."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwire.operators.contracts import MAX_LENGTH, NOT_NULL
from labwire.operators.schema import LAB_ORDER_SCHEMA, STORED_COLUMNS
from labwire.operators.upsert import latest
from labwire.plans.oracle import ORACLE, _q
from labwire.plans.pipeline import default_width, facilities, facility_renames, lab_prefixes, order_count, route_records, valid_rows
from labwire.session import scratch_dir
from labwire.sinks import dead_letters as dlq_sink
from labwire.sinks import files
from labwire.sinks.deltas import DeltaTable
from labwire.sinks.table import TableUpsertSink
from labwire.sources.fixtures import records_from_dir
from labwire.sources.records import offset_range
from labwire.streaming.job import FanOut, file_source, start
from labwire.streaming.metrics import read_counts, write_counts

CHUNKS = 3


def _dead_to(paths: dict):
    return lambda df, bid: dlq_sink.to_files(df, paths["dlq"], bid, files.query_id(df.sparkSession, paths["checkpoint"]))


def _paths(spark: SparkSession) -> dict:
    base = scratch_dir(spark, f"stream-{uuid.uuid4().hex[:12]}")
    return {k: f"{base}/{k}" for k in ("source", "table", "dlq", "quarantine", "counts", "checkpoint")}


def _chunk(spark: SparkSession, sf_dir: str, i: int, chunks: int) -> DataFrame:
    """The raw records of one of ``chunks`` offset ranges, dealt evenly over the cores: the range
    lies in a few row groups of the orders, and a task of the stream reads a file of the chunk."""
    n = order_count(spark, sf_dir)
    return records_from_dir(spark, sf_dir, default_width(spark), (i * n // chunks, (i + 1) * n // chunks))


def _land(chunk: DataFrame, path: str) -> int:
    """Write a chunk as the next files of the source, one a partition, the same number each time;
    a trigger of so many files then reads one chunk.  Returns that number."""
    chunk.write.mode("append").parquet(path)
    return default_width(chunk.sparkSession)


def _drain(spark: SparkSession, paths: dict, fan: FanOut, files_per_batch: int | None = None) -> None:
    q = start(file_source(spark, paths["source"], files_per_batch), fan, paths["checkpoint"], trigger={"availableNow": True},
              query_name=f"lab_orders_{uuid.uuid4().hex[:8]}")
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_chunked_stream(spark: SparkSession, sf_dir: str, chunks: int = CHUNKS, make_contract=lambda paths: {},
                       make_sink=lambda path, i: DeltaTable(path)) -> dict:
    """Feed the records in ``chunks`` offset ranges; after each chunk lands,
    restart the query from its checkpoint and drain it (``availableNow``).
    ``make_contract`` gives the job's contract options (default: unchecked),
    ``make_sink`` the table as the job knows it at chunk ``i``."""
    paths = _paths(spark)
    for i in range(chunks):
        _land(_chunk(spark, sf_dir, i, chunks), paths["source"])
        sink = make_sink(paths["table"], i)
        _drain(spark, paths, FanOut(sink.for_query(paths["checkpoint"]), _dead_to(paths), **({"contract": "off"} | make_contract(paths))))
    paths["sink"] = sink
    return paths


def replay_stream(spark: SparkSession, paths: dict) -> None:
    """Redeploy without state: a fresh checkpoint re-reads every record."""
    fresh = {**paths, "checkpoint": paths["checkpoint"] + "-replay"}
    _drain(spark, fresh, FanOut(paths["sink"].for_query(fresh["checkpoint"]), lambda df, bid: None, contract="off"))


def q_stream_redeploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain two thirds, wipe the checkpoint, and redeploy at the *same* path: all
    records are read again in other batches, with the last third behind them."""
    paths = _paths(spark)
    sink = DeltaTable(paths["table"])
    fan = FanOut(sink.for_query(paths["checkpoint"]), _dead_to(paths), contract="off")
    for i in range(2):
        _land(_chunk(spark, sf_dir, i, 3), paths["source"])
        _drain(spark, paths, fan)
    files.delete(spark, paths["checkpoint"])
    n_files = _land(_chunk(spark, sf_dir, 2, 3), paths["source"])
    _drain(spark, paths, fan, files_per_batch=n_files)
    return sink.read(spark)


def q_stream_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the first third is stored by a job that does not know ``lab_code``, the rest by one
    that does, into the same table; rows of before read null."""
    before = type(LAB_ORDER_SCHEMA)([f for f in LAB_ORDER_SCHEMA.fields if f.name != "lab_code"])
    paths = run_chunked_stream(spark, sf_dir, make_sink=lambda path, i: DeltaTable(path, before if i == 0 else LAB_ORDER_SCHEMA))
    return paths["sink"].read(spark)


def q_stored_facility_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility codes change between two stretches of the stream.  Stored rows follow;
    rows that later messages write keep the code that they carry."""
    paths = _paths(spark)
    sink = DeltaTable(paths["table"])
    fan = FanOut(sink.for_query(paths["checkpoint"]), _dead_to(paths), contract="off")
    for i in range(2):
        _land(_chunk(spark, sf_dir, i, 2), paths["source"])
        _drain(spark, paths, fan)
        if i == 0:
            sink.rename_facilities(spark, facility_renames(spark, sf_dir), name="codes-1")
    return sink.read(spark)


def q_stream_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 in the stream: counts stored by query and batch, with a failure after a batch's
    counts were written; the batch that runs again overwrites them."""
    paths = _paths(spark)
    sink, failed = DeltaTable(paths["table"]), []

    def counts(df, bid):
        write_counts(df, paths["counts"], bid, files.query_id(df.sparkSession, paths["checkpoint"]))
        if bid == 1 and not failed:
            failed.append(bid)
            raise Injected("after the counts")

    fan = FanOut(sink.for_query(paths["checkpoint"]), _dead_to(paths), contract="off", counts=counts)
    _until_done(spark, sf_dir, paths, fan, CHUNKS)
    return read_counts(spark, paths["counts"])


def q_stream_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job under its own 200 ms trigger, one chunk a flush, stopped when the
    source is drained."""
    paths = _paths(spark)
    for i in range(CHUNKS):
        n_files = _land(_chunk(spark, sf_dir, i, CHUNKS), paths["source"])
    sink = DeltaTable(paths["table"])
    fan = FanOut(sink.for_query(paths["checkpoint"]), _dead_to(paths), contract="off")
    q = start(file_source(spark, paths["source"], n_files), fan, paths["checkpoint"], query_name=f"lab_orders_{uuid.uuid4().hex[:8]}")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return sink.read(spark)


class Injected(Exception):
    """A failure on purpose."""


def _fail_once(step, when=lambda *args: True):
    """``step`` that fails after its first run for which ``when`` holds."""
    failed = []

    def run(*args, **kw):
        out = step(*args, **kw)
        if not failed and when(*args):
            failed.append(True)
            raise Injected(getattr(step, "__name__", "step"))
        return out

    return run


def _until_done(spark, sf_dir, paths, fan, chunks) -> None:
    """All chunks, one a batch; a query that an injected failure ends is started again, once."""
    if not files.exists(spark, paths["source"]):
        for i in range(chunks):
            paths["n_files"] = _land(_chunk(spark, sf_dir, i, chunks), paths["source"])
    try:
        _drain(spark, paths, fan, paths["n_files"])
    except Exception as e:  # noqa: BLE001 - only the injected one is expected
        if "Injected" not in str(e):
            raise
        _drain(spark, paths, fan, paths["n_files"])
    else:
        raise AssertionError("the injected failure did not happen")


#: Steps of a batch after which the job dies, by sink.
CRASHES = [("deltas", "before"), ("deltas", "torn"), ("deltas", "written"),
           ("buckets", "staged"), ("buckets", "state"), ("buckets", "replaced")]


def _crashing(kind: str, step: str, path: str, checkpoint: str):
    """(table, merge of the query): the second batch dies once, after the named step."""
    if kind == "buckets":
        table = TableUpsertSink(path, buckets=8)
        name = {"staged": "_stage", "state": "_record_max_id", "replaced": "_replace"}[step]
        passed = iter([False, True])  # a batch takes each step once: the first batch passes
        setattr(table, name, _fail_once(getattr(table, name), lambda *a: next(passed, True)))
        return table, table.for_query(checkpoint)
    table = DeltaTable(path)
    append = table.for_query(checkpoint)

    def torn(rows, batch_id):
        append(rows, batch_id)
        for marker in files.matches(rows.sparkSession, f"{path}/seq=*/writer=*/batch={batch_id}/_SUCCESS"):
            files.delete(rows.sparkSession, marker)

    second_batch = lambda rows, batch_id: batch_id == 1
    if step == "written":
        return table, _fail_once(append, second_batch)
    broken = _fail_once(torn if step == "torn" else lambda rows, batch_id: None, second_batch)

    def merge(rows, batch_id):
        if batch_id == 1:
            broken(rows, batch_id)  # raises the first time; the second time the append repairs it
        append(rows, batch_id)

    return table, merge


def q_stream_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job dies after each step of a batch's write and is started again; the table is
    the same as without the failure, for both file tables."""
    out, shared = [], _paths(spark)
    for kind, step in CRASHES:
        paths = {**_paths(spark), "source": shared["source"], "n_files": shared.get("n_files")}
        table, merge = _crashing(kind, step, paths["table"], paths["checkpoint"])
        _until_done(spark, sf_dir, paths, FanOut(merge, _dead_to(paths), contract="off"), 2)
        shared["n_files"] = paths["n_files"]
        out.append(table.read(spark).select(F.lit(f"{kind}:{step}").alias("died_after"), "id", *STORED_COLUMNS))
    return functools.reduce(DataFrame.unionByName, out)


def _stretch(n: int) -> tuple[dict, dict]:
    return {0: n // 4, 1: 0}, {0: n // 2, 1: n // 3}


def q_replay_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stretch of offsets by partition, replayed alone."""
    begin, end = _stretch(order_count(spark, sf_dir))
    stretch = offset_range(records_from_dir(spark, sf_dir, default_width(spark)), begin, end)
    return latest(valid_rows(route_records(stretch))).select(*STORED_COLUMNS)


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_chunked_stream(spark, sf_dir)
    return paths["sink"].read(spark)


def q_stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_chunked_stream(spark, sf_dir)
    return spark.read.parquet(paths["dlq"]).select("value")


def q_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_chunked_stream(spark, sf_dir)
    replay_stream(spark, paths)
    return paths["sink"].read(spark)


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1, C2, C6, J1, J2 in the job: clean rows are stored, violating ones set
    aside with every rule they break."""
    def options(paths):
        def quarantine(df, bid):
            dlq_sink.to_files(df, paths["quarantine"], bid, files.query_id(df.sparkSession, paths["checkpoint"]))

        return {"contract": "quarantine", "quarantine": quarantine,
                "facilities": lambda s: facilities(s, sf_dir), "labs": lambda s: lab_prefixes(s, sf_dir)}

    paths = run_chunked_stream(spark, sf_dir, make_contract=options)
    rules = F.array_join(F.transform("violations", lambda x: F.concat_ws(":", x["rule"], x["column_name"])), ",")
    aside = spark.read.parquet(paths["quarantine"]).select(
        F.lit("quarantined").alias("kind"), F.lit(None).cast("long").alias("id"), *STORED_COLUMNS, rules.alias("violations"))
    kept = paths["sink"].read(spark).select(F.lit("stored").alias("kind"), "id", *STORED_COLUMNS, F.lit("").alias("violations"))
    return kept.unionByName(aside)


_STORED = "order_id, message_ref_id, mfl_code, order_date, order_time, sending_application, test_id, lab_code"
_ALL_UPSERTED = f"""
, ids AS (SELECT message_ref_id, row_number() OVER (ORDER BY min(k)) AS id FROM v GROUP BY message_ref_id)
SELECT ids.id, {_STORED} FROM st JOIN ids USING (message_ref_id)
"""

_RULES = [f"CASE WHEN {c} IS NULL THEN 'not_null:{c}' END" for c in NOT_NULL] + [
    f"CASE WHEN length({c}) > {n} THEN 'max_length:{c}' END" for c, n in MAX_LENGTH.items()] + [
    f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {t}) THEN 'reference:{c}' END"
    for c, t in (("mfl_code", "fac"), ("lab_code", "labs"))]
_QUARANTINE = f"""
, fac AS (SELECT DISTINCT CAST(1000 + c_custkey % 9000 AS VARCHAR) AS mfl_code FROM customer WHERE c_custkey % 20 <> 0),
labs AS (SELECT 'L' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS lab_code FROM nation WHERE n_nationkey <= 22),
chk AS (SELECT v.*, concat_ws(',', {", ".join(_RULES)}) AS violations FROM v),
clean AS (SELECT *, min(k) OVER (PARTITION BY message_ref_id) AS first_k FROM chk WHERE violations = ''),
kept AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY message_ref_id ORDER BY k DESC) = 1)
SELECT 'stored' AS kind, row_number() OVER (ORDER BY first_k) AS id, {_STORED}, violations FROM kept
UNION ALL
SELECT 'quarantined', NULL, {_STORED}, violations FROM chk WHERE violations <> ''
"""

_RENAMED = f"""
, ren AS (SELECT DISTINCT CAST(1000 + c_custkey % 9000 AS VARCHAR) AS old_code,
                 '9' || right(CAST(1000 + c_custkey % 9000 AS VARCHAR), 3) AS new_code
          FROM customer WHERE c_custkey % 50 = 0),
ids AS (SELECT message_ref_id, row_number() OVER (ORDER BY min(k)) AS id FROM v GROUP BY message_ref_id)
SELECT ids.id, {_STORED.replace("mfl_code", "CASE WHEN k < n // 2 THEN coalesce(new_code, mfl_code) ELSE mfl_code END AS mfl_code")}
FROM st JOIN ids USING (message_ref_id) LEFT JOIN ren ON mfl_code = old_code
"""
_EVOLVED = _ALL_UPSERTED.replace("lab_code FROM", "CASE WHEN k < n // 3 THEN NULL ELSE lab_code END AS lab_code FROM")
_CRASHED = f"""
, ids AS (SELECT message_ref_id, row_number() OVER (ORDER BY min(k)) AS id FROM v GROUP BY message_ref_id)
SELECT died_after, ids.id, {_STORED} FROM st JOIN ids USING (message_ref_id),
  (VALUES {", ".join(f"('{kind}:{step}')" for kind, step in CRASHES)}) AS c(died_after)
"""
_RANGE = f"""
SELECT {_STORED} FROM v WHERE (part = 0 AND k >= n // 4 AND k < n // 2) OR (part = 1 AND k < n // 3)
QUALIFY row_number() OVER (PARTITION BY message_ref_id ORDER BY k DESC) = 1
"""

STREAM_QUERIES = {
    "stream_upsert": q_stream_upsert,
    "stream_dlq": q_stream_dlq,
    "stream_replay": q_stream_replay,
    "stream_redeploy": q_stream_redeploy,
    "stream_quarantine": q_stream_quarantine,
    "stream_evolved": q_stream_evolved,
    "stored_facility_cascade": q_stored_facility_cascade,
    "stream_route_counts": q_stream_route_counts,
    "stream_timed": q_stream_timed,
    "stream_crash": q_stream_crash,
    "replay_range": q_replay_range,
}
STREAM_ORACLE = {
    "stream_upsert": _q(_ALL_UPSERTED),
    "stream_dlq": ORACLE["dead_letters"],
    "stream_replay": _q(_ALL_UPSERTED),
    "stream_redeploy": _q(_ALL_UPSERTED),
    "stream_quarantine": _q(_QUARANTINE),
    "stream_evolved": _q(_EVOLVED),
    "stored_facility_cascade": _q(_RENAMED),
    "stream_route_counts": ORACLE["route_counts"],
    "stream_timed": _q(_ALL_UPSERTED),
    "stream_crash": _q(_CRASHED),
    "replay_range": _q(_RANGE),
}
