"""K4: dead letters as raw message text (Kafka topic, or files in tests)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Fixed value: the dead-letter topic name.
DLQ_TOPIC = "lab-orders-dlq"


def to_kafka(dead: DataFrame, bootstrap: str, topic: str = DLQ_TOPIC,
             options: Mapping[str, str] | None = None) -> None:
    """Null key, UTF-8 value; at-least-once (a replay re-sends)."""
    w = dead.selectExpr("CAST(NULL AS BINARY) AS key", "CAST(value AS BINARY) AS value").write.format("kafka")
    w = w.option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def to_files(dead: DataFrame, path: str, batch_id: int, query: str = "default") -> None:
    """One folder per query (see ``files.query_id``) and batch id, overwritten on a
    replay of that batch; another query's letters stay."""
    dead.write.mode("overwrite").parquet(f"{path.rstrip('/')}/query={query}/batch={batch_id}")
