"""The raw record shape (D1) shared by Kafka, files and tables, and the
decode step (S3, F1) that turns payload bytes into message text."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwire.functions.text import decode_payload, is_empty_payload

RAW_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Columns that identify a record and its arrival order; they ride along with
# every stage so that dedup (last write wins) can order by them.
ARRIVAL = ["partition", "offset"]


def decode(records: DataFrame) -> DataFrame:
    """Value-only decode: ``is_empty`` flag and ``raw_message`` text.

    The key is ignored, as with a value-only deserializer.
    """
    return records.select(
        *ARRIVAL,
        is_empty_payload("value").alias("is_empty"),
        decode_payload("value").alias("raw_message"),
    )


def offset_range(records: DataFrame, start: Mapping[int, int], end: Mapping[int, int]) -> DataFrame:
    """S2 for a stretch of stored records: those of ``[start, end)`` by partition, with the
    rules of ``kafka.range_options``.  The filter reaches the scan of a stored table."""
    def one(p):
        keep = F.col("partition") == p
        if p in start:
            keep &= F.col("offset") >= start[p]
        return keep & (F.col("offset") < end[p]) if p in end else keep

    return records.filter(functools.reduce(operator.or_, [one(p) for p in sorted({*start, *end})], F.lit(False)))
