"""The continuous job as a ``spark-submit`` entry point.

    spark-submit --py-files labwire.zip labwire/streaming/main.py \\
        --bootstrap <servers> --topic lab-orders --checkpoint <shared path> \\
        --table <path> | --jdbc-url <url> --jdbc-user <user> \\
        [--dlq-topic lab-orders-dlq | --dlq-path <path>] \\
        [--contract fail | --contract quarantine --quarantine-path <path>] [--replay]

A batch is bounded by ``--max-offsets-per-trigger`` (Kafka) or
``--max-files-per-trigger`` (files), so a backlog becomes many batches and
nothing is skipped.  ``--replay`` forgets the saved offsets and reads the
topic from its start, as a redeploy of the original job does; the upsert is
idempotent, so the table converges.

Secrets (SASL password, JDBC password) are read from the environment
variables named by ``--sasl-password-env`` / ``--jdbc-password-env``; there
are no defaults for hosts, users or passwords: a missing value stops the job.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from labwire.session import apply_recommended_conf
from labwire.sinks import dead_letters as dlq
from labwire.sinks import files
from labwire.sinks.deltas import DeltaTable
from labwire.sinks.jdbc import JdbcTarget, upsert_batch
from labwire.sinks.table import TableUpsertSink
from labwire.sources.kafka import KafkaSecurity, read_stream, writer_options
from labwire.streaming.job import CONTRACT_MODES, DEFAULT_TRIGGER, QUERY_NAME, FanOut, file_source, start
from labwire.streaming.metrics import write_counts


def _secret(env_name: str | None) -> str:
    if not env_name or not os.environ.get(env_name):
        raise SystemExit(f"secret variable {env_name!r} is not set")
    return os.environ[env_name]


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = p.add_argument_group("source")
    src.add_argument("--bootstrap", help="Kafka bootstrap servers")
    src.add_argument("--topic", default="lab-orders")
    src.add_argument("--group-id")
    src.add_argument("--max-offsets-per-trigger", type=int, default=1_000_000)
    src.add_argument("--max-files-per-trigger", type=int, default=1_000)
    src.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE",
                     help="a further Kafka client setting (repeatable)")
    src.add_argument("--min-partitions", type=int)
    src.add_argument("--security-protocol")
    src.add_argument("--sasl-mechanism")
    src.add_argument("--sasl-user")
    src.add_argument("--sasl-password-env")
    src.add_argument("--source-path", help="parquet folder of raw records instead of Kafka")
    out = p.add_argument_group("sinks")
    out.add_argument("--table", help="parquet upsert table path")
    out.add_argument("--buckets", type=int, default=64)
    out.add_argument("--delta-table", help="path of a merge-on-read table (a batch costs what it holds)")
    out.add_argument("--counts-path", help="folder for the route counters of each batch")
    out.add_argument("--jdbc-url")
    out.add_argument("--jdbc-user")
    out.add_argument("--jdbc-password-env")
    out.add_argument("--jdbc-table", default="crt.lab_order")
    out.add_argument("--dlq-topic")
    out.add_argument("--dlq-path")
    rules = p.add_argument_group("contract")
    rules.add_argument("--contract", choices=CONTRACT_MODES, default="fail")
    rules.add_argument("--quarantine-path", help="folder for violating rows")
    rules.add_argument("--facilities", help="parquet table with mfl_code")
    rules.add_argument("--labs", help="parquet table with lab_code")
    run = p.add_argument_group("run")
    run.add_argument("--replay", action="store_true", help="read everything again from the start")
    run.add_argument("--checkpoint", required=True, help="shared folder for the query checkpoint")
    run.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    run.add_argument("--query-name", default=QUERY_NAME)
    a = p.parse_args(argv)
    if a.contract == "quarantine" and not a.quarantine_path:
        p.error("--contract quarantine needs --quarantine-path")
    if bad := [o for o in a.kafka_option if "=" not in o]:
        p.error(f"--kafka-option wants NAME=VALUE, not {bad[0]!r}")
    return a


def main(argv=None) -> None:
    a = parse_args(argv)
    spark = SparkSession.builder.appName(a.query_name).getOrCreate()
    apply_recommended_conf(spark)

    if a.replay:
        files.delete(spark, a.checkpoint)

    security = None
    extra = dict(o.split("=", 1) for o in a.kafka_option)
    if a.source_path:
        raw = file_source(spark, a.source_path, a.max_files_per_trigger)
    else:
        if a.security_protocol:
            security = KafkaSecurity(a.security_protocol, a.sasl_mechanism, a.sasl_user, _secret(a.sasl_password_env))
        raw = read_stream(spark, bootstrap=a.bootstrap, topic=a.topic, group_id=a.group_id, security=security,
                          max_offsets_per_trigger=a.max_offsets_per_trigger, min_partitions=a.min_partitions,
                          extra=extra)

    if a.table:
        upsert = TableUpsertSink(a.table, buckets=a.buckets).for_query(a.checkpoint)
    elif a.delta_table:
        upsert = DeltaTable(a.delta_table).for_query(a.checkpoint)
    elif a.jdbc_url:
        target = JdbcTarget(a.jdbc_url, a.jdbc_user, _secret(a.jdbc_password_env), a.jdbc_table)
        from labwire.operators.upsert import latest

        def upsert(rows, batch_id):
            upsert_batch(latest(rows), batch_id, target, files.query_id(rows.sparkSession, a.checkpoint))
    else:
        raise SystemExit("give --table, --delta-table or --jdbc-url")

    if a.dlq_topic:
        if not a.bootstrap:
            raise SystemExit("--dlq-topic needs --bootstrap")
        kafka_opts = writer_options(security, extra)

        def dead(df, batch_id):
            dlq.to_kafka(df, a.bootstrap, a.dlq_topic, kafka_opts)
    elif a.dlq_path:
        def dead(df, batch_id):
            dlq.to_files(df, a.dlq_path, batch_id, files.query_id(df.sparkSession, a.checkpoint))
    else:
        raise SystemExit("give --dlq-topic or --dlq-path")

    def quarantine(df, batch_id):
        dlq.to_files(df, a.quarantine_path, batch_id, files.query_id(df.sparkSession, a.checkpoint))

    def counts(df, batch_id):
        write_counts(df, a.counts_path, batch_id, files.query_id(df.sparkSession, a.checkpoint))

    def reference(path):
        return (lambda s: s.read.parquet(path)) if path else None

    fan = FanOut(upsert, dead, contract=a.contract, quarantine=quarantine,
                 facilities=reference(a.facilities), labs=reference(a.labs),
                 counts=counts if a.counts_path else None)
    trigger = {"availableNow": True} if a.available_now else DEFAULT_TRIGGER
    q = start(raw, fan, a.checkpoint, trigger=trigger, query_name=a.query_name)
    q.awaitTermination()


if __name__ == "__main__":
    main()
