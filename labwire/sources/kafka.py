"""Kafka source/sink options (S1, S2, S4-S6) for ``spark.read(Stream)``.

The Kafka connector jar is not part of the build container, so the options
are built and unit-tested here and the tests drive the same transforms from
a file source with the raw record schema.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from labwire.sources.records import RAW_COLUMNS

# The input topic and the client settings of the original job
# (defaults; each can be overridden by ``extra``).
DEFAULT_TOPIC = "lab-orders"
CLIENT_DEFAULTS = {
    "kafka.max.poll.records": "50",
    "kafka.max.poll.interval.ms": "10000",
    "kafka.request.timeout.ms": "2540000",
    "kafka.default.api.timeout.ms": "2540000",
}
# The delivery timeout is a producer's setting: it applies to the dead-letter writer.
PRODUCER_DEFAULTS = {"kafka.delivery.timeout.ms": "120000"}


@dataclass(frozen=True)
class KafkaSecurity:
    """SASL/SCRAM settings; values come from the caller's secrets, never defaults."""

    protocol: str
    mechanism: str
    username: str
    password: str

    def options(self) -> dict[str, str]:
        jaas = (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f'username="{self.username}" password="{self.password}";'
        )
        return {
            "kafka.security.protocol": self.protocol,
            "kafka.sasl.mechanism": self.mechanism,
            "kafka.sasl.jaas.config": jaas,
        }


def reader_options(
    bootstrap: str,
    topic: str = DEFAULT_TOPIC,
    group_id: str | None = None,
    security: KafkaSecurity | None = None,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """S1/S2/S4/S5/S6.  Offsets live in the query checkpoint (Spark refuses
    ``enable.auto.commit``); a fresh checkpoint + ``earliest`` replays all.
    ``extra`` passes any further ``kafka.*`` setting on and wins over a default."""
    if not bootstrap:
        raise ValueError("bootstrap servers are required")
    o = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        **CLIENT_DEFAULTS,
    }
    if group_id:
        o["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        o["minPartitions"] = str(min_partitions)
    if security:
        o.update(security.options())
    o.update(client_settings(extra))
    return o


def client_settings(extra: Mapping[str, str] | None) -> dict[str, str]:
    """Client settings by their Kafka names, with or without the ``kafka.`` prefix."""
    return {k if k.startswith("kafka.") else f"kafka.{k}": str(v) for k, v in (extra or {}).items()}


def writer_options(security: KafkaSecurity | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the dead-letter writer besides servers and topic."""
    return {**PRODUCER_DEFAULTS, **(security.options() if security else {}), **client_settings(extra)}


def read_stream(spark: SparkSession, **kw) -> DataFrame:
    return spark.readStream.format("kafka").options(**reader_options(**kw)).load().select(*RAW_COLUMNS)


def range_options(bootstrap: str, start: Mapping[int, int], end: Mapping[int, int], topic: str = DEFAULT_TOPIC,
                  security: KafkaSecurity | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """S2 for a stretch: options of a batch read of ``[start, end)`` by partition.  A partition
    that only one of them names begins at its earliest or ends at its latest offset."""
    parts = sorted({*start, *end})
    if not parts:
        raise ValueError("name at least one partition")
    if bad := [p for p in parts if p in start and p in end and start[p] > end[p]]:
        raise ValueError(f"partition {bad[0]} ends before it starts")
    o = reader_options(bootstrap, topic, security=security, extra=extra)
    del o["subscribe"]
    earliest, latest = -2, -1  # fixed values of the connector
    o["assign"] = json.dumps({topic: parts})
    o["startingOffsets"] = json.dumps({topic: {str(p): start.get(p, earliest) for p in parts}})
    o["endingOffsets"] = json.dumps({topic: {str(p): end.get(p, latest) for p in parts}})
    return o


def read_range(spark: SparkSession, **kw) -> DataFrame:
    """The raw records of a stretch of the topic (see :func:`range_options`)."""
    return spark.read.format("kafka").options(**range_options(**kw)).load().select(*RAW_COLUMNS)
