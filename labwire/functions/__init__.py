"""Scalar column functions (no Python UDFs): text cleanup, HL7 positions,
escape handling, lenient date parsing and value maps."""

from labwire.functions.text import decode_payload, is_empty_payload, sanitize, preview
from labwire.functions.hl7 import (
    Encoding,
    encoding_of,
    normalize_segments,
    first_order_position,
    segment_at,
    segment_start,
    split_pattern,
    split_fields,
    field,
    component,
    has_escape,
    unescape,
    value,
    message_type_name,
    gender_name,
)
from labwire.functions.dates import (
    parse_hl7_datetime,
    parse_hl7_date,
    parse_exact_timestamp,
    format_date,
)

__all__ = [
    "decode_payload", "is_empty_payload", "sanitize", "preview",
    "Encoding", "encoding_of", "normalize_segments", "first_order_position", "segment_at", "segment_start",
    "split_pattern", "split_fields", "field", "component", "has_escape", "unescape", "value",
    "message_type_name", "gender_name",
    "parse_hl7_datetime", "parse_hl7_date", "parse_exact_timestamp", "format_date",
]
