"""Order extraction (P5-P15) and the header / patient projections."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwire.functions.dates import format_date, parse_exact_timestamp, parse_hl7_date, parse_hl7_datetime
from labwire.functions.hl7 import gender_name, message_type_name
from labwire.operators.parse import (
    GATE_POSITIONS,
    HEADER_POSITIONS,
    ORDER_POSITIONS,
    PATIENT_POSITIONS,
    gate_columns,
    raw_fields,
    raw_name,
    v,
)
from labwire.sources.records import ARRIVAL

# Columns of one extracted order (D3 without the always-null header/test id).
ORDER_COLUMNS = [
    "message_ref_id", "sending_application", "mfl_code", "lab_code",
    "order_id", "loinc", "order_date", "order_time", "raw_message",
]
PASS_THROUGH = [*ARRIVAL, "is_empty", "is_er7", "raw_message"]
# What routing alone (F8) reads: the gate and three header values.
ROUTE_POSITIONS = GATE_POSITIONS + (("msh", 4, 2), ("msh", 6, 1), ("msh", 10, 1))


def order_columns() -> list[Column]:
    """P5-P14 text fields over ``raw_fields(…, ORDER_POSITIONS)``."""
    return [
        v("msh", 10).alias("message_ref_id"),
        F.coalesce(v("msh", 3), F.lit("")).alias("sending_application"),
        F.coalesce(v("msh", 4, 2), F.lit("")).alias("mfl_code"),
        v("msh", 6).alias("lab_code"),
        v("orc", 2).alias("order_id"),
        F.coalesce(v("obr", 4, 1), v("obr", 4, 4)).alias("loinc"),
    ]


def extract_orders(parsed: DataFrame, fence: bool = True) -> DataFrame:
    """Every parsed record with gate inputs and the order fields.

    The raw positions are one fenced stage; the typed fields and the order
    date/time (from the OBR-7 column) are derived from it, so filters and
    routes on these columns never re-derive them from the message.
    """
    if "flat" in parsed.columns:  # a plain message passed the ER7 check
        parsed = parsed.withColumn("is_er7", F.col("flat").isNotNull() | F.col("is_er7"))
    raw = raw_fields(parsed, GATE_POSITIONS + ORDER_POSITIONS, PASS_THROUGH, fence=fence)
    typed = raw.select(*PASS_THROUGH, *_typed_exprs())
    keep = [c for c in typed.columns if c != "_dt"]
    return typed.select(*keep, F.col("_dt.date").alias("order_date"), F.col("_dt.time").alias("order_time"))


@functools.cache
def _typed_exprs() -> list[Column]:
    return [*gate_columns(), *order_columns(), parse_hl7_datetime(v("obr", 7)).alias("_dt")]


def extract_routing(parsed: DataFrame) -> DataFrame:
    """The columns that F8 reads and nothing else: header positions only, no
    order, patient or raw text (``parse_messages(…, ("msh",), with_raw=False)``)."""
    keep = [*ARRIVAL, "is_empty", "is_er7"]
    raw = raw_fields(parsed, ROUTE_POSITIONS, keep)
    return raw.select(*keep, *gate_columns(), v("msh", 10).alias("message_ref_id"),
                      F.coalesce(v("msh", 4, 2), F.lit("")).alias("mfl_code"), v("msh", 6).alias("lab_code"))


def sink_projection(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 8 stored columns (after the ``keep`` columns); the LOINC code
    is stored as ``test_id``."""
    return orders.select(
        *keep,
        "order_id", "message_ref_id", "mfl_code",
        F.col("order_date").cast("date").alias("order_date"),
        "order_time", "sending_application",
        F.col("loinc").alias("test_id"), "lab_code",
    )


def header_struct(fix_oml: bool = False) -> Column:
    """P16 over ``raw_fields(…, HEADER_POSITIONS)``: null where a strict
    reader would throw (no message structure, or a date/time that is not an
    exact yyyyMMddHHmmss)."""
    structure = v("msh", 9, 3)
    ts = parse_exact_timestamp(v("msh", 7))
    fields = F.struct(
        message_type_name(structure, fix_oml).alias("message_type"),
        v("msh", 12).alias("version"),
        ts.alias("timestamp"),
        v("msh", 4, 2).alias("sender_id"),
        v("msh", 6).alias("receiver_id"),
        v("msh", 10).alias("message_id"),
        v("msh", 16).alias("ack_type"),
    )
    return F.when(structure.isNotNull() & ts.isNotNull(), fields)


def patient_struct() -> Column:
    """P17 over ``raw_fields(…, PATIENT_POSITIONS)``: null where a strict
    reader would throw (no sex, or a birth date that is not an exact yyyyMMdd)."""
    sex = v("pid", 8)
    dob = parse_hl7_date(v("pid", 7))
    fields = F.struct(
        v("pid", 3).alias("id"),
        v("pid", 5, 2).alias("first_name"),
        v("pid", 5, 1).alias("last_name"),
        gender_name(sex).alias("gender"),
        format_date(dob).alias("dob"),
    )
    return F.when(sex.isNotNull() & dob.isNotNull(), fields)


def project(parsed: DataFrame, what: str, fix_oml: bool = False) -> DataFrame:
    """Gate columns plus the header (``what="header"``) or patient struct ``h``/``p``.

    The struct is built in its own projection over a materialised
    timestamp / birth date, so the date rules read columns, not expressions.
    """
    positions = GATE_POSITIONS + (HEADER_POSITIONS if what == "header" else PATIENT_POSITIONS)
    raw = raw_fields(parsed, positions, [*ARRIVAL, "is_er7"])
    return raw.select(*ARRIVAL, "is_er7", *gate_columns(),
                      (header_struct(fix_oml) if what == "header" else patient_struct()).alias(what[0]))


__all__ = ["ORDER_COLUMNS", "order_columns", "extract_orders", "extract_routing", "sink_projection", "header_struct",
           "patient_struct", "project", "raw_name"]
