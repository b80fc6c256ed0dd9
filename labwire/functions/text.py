"""Payload decoding and message cleanup (S3, P1 = T1..T3, T13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwire.functions._util import col_of


def is_empty_payload(value: Column | str) -> Column:
    """a null or zero-length payload carries no message."""
    v = col_of(value)
    return v.isNull() | (F.octet_length(v) == 0)


def decode_payload(value: Column | str) -> Column:
    """S3: bytes -> text as UTF-8; malformed byte sequences become U+FFFD.

    ``decode`` would raise on malformed input; ``make_valid_utf8`` substitutes
    instead, which is what a lenient byte-to-string constructor does.
    """
    return F.make_valid_utf8(col_of(value).cast("string"))


# Fixed values that must match the original job's cleanup, in its order:
#   1. every "\n" becomes "\r"
#   2. one pass of "\r\r" -> "\r"
#   3. multiline regex  (?m)^NTE\|.*(?:\r?\n)?  removed (java.util.regex, so
#      "^" also matches right after a bare "\r")
#   4. one more pass of "\r\r" -> "\r"
NTE_LINE_PATTERN = r"(?m)^NTE\|.*(?:\r?\n)?"


def _once(pair: str, by: str):
    return lambda t: F.replace(t, F.lit(pair), F.lit(by))


#: The cleanup in its order: a text that holds no such literal is not changed by the step.
SANITIZE_STEPS = (
    ("\n", _once("\n", "\r")),
    ("\r\r", _once("\r\r", "\r")),
    ("NTE|", lambda t: F.regexp_replace(t, NTE_LINE_PATTERN, "")),
    ("\r\r", _once("\r\r", "\r")),
)


def sanitized(df: DataFrame, text: str, name: str) -> DataFrame:
    """:func:`sanitize` of column ``text`` as column ``name``, a projection a step.

    ``contains`` looks at a byte where ``replace`` compares its needle and a regex decodes
    the text, so each step runs for the texts that hold its literal.  In one expression
    each guard would copy the steps before it."""
    src = text
    for literal, step in SANITIZE_STEPS:
        t = F.col(src)
        df = df.withColumn(name, F.when(t.contains(literal), step(t)).otherwise(t))
        src = name
    return df


def sanitize(text: Column | str) -> Column:
    """Normalise line endings and strip NTE (note) segments."""
    t = col_of(text)
    for _, step in SANITIZE_STEPS:
        t = step(t)
    return t


def preview(text: Column | str, n: int = 100) -> Column:
    """The first ``n`` characters, as logged for rejected messages."""
    return F.substring(col_of(text), 1, n)
