"""Lenient ("smart") HL7 date/time parsing with native expressions.

A smart resolver accepts day-of-month 29..31 for any month and clamps it to
the month's last day, reads hour 24 at minute 0 as midnight of the next day,
and rejects month 13, hour 25, minute 60, year 0 and non-digits.  Spark's own
parsers are strict (Feb 31 -> null, 24:00 -> null), so the rule is written
out with integer arithmetic.  Nothing here can raise under ANSI mode: every
cast is a ``try_cast`` and dates are built from validated parts only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwire.functions._util import col_of


def _int(s: Column, pos: int, length: int) -> Column:
    return F.substring(s, pos, length).try_cast("int")


def _clamped_date(y: Column, m: Column, d: Column, extra_days: Column) -> Column:
    first = F.make_date(y, m, F.lit(1))
    day = F.least(d, F.dayofmonth(F.last_day(first)))
    return F.date_add(first, day - 1 + extra_days)


def _date_ok(y: Column, m: Column, d: Column) -> Column:
    return (y >= 1) & m.between(1, 12) & d.between(1, 31)


def parse_hl7_datetime(v: Column | str) -> Column:
    """``struct<date: date, time: string>`` from the first 12 characters
    (``yyyyMMddHHmm``) of a DTM value; seconds and zone are ignored.

    Null when the value is shorter than 12 characters or does not resolve.
    """
    s = col_of(v)
    y, m, d, h, mi = _int(s, 1, 4), _int(s, 5, 2), _int(s, 7, 2), _int(s, 9, 2), _int(s, 11, 2)
    ok = (
        s.rlike("^[0-9]{12}")
        & _date_ok(y, m, d)
        & (mi <= 59)
        & ((h <= 23) | ((h == 24) & (mi == 0)))
    )
    rolled = F.when(h == 24, F.lit(1)).otherwise(F.lit(0))
    return F.when(
        ok,
        F.struct(
            _clamped_date(y, m, d, rolled).alias("date"),
            F.concat(F.when(h == 24, F.lit("00")).otherwise(F.substring(s, 9, 2)), F.lit(":"), F.substring(s, 11, 2), F.lit(":00")).alias("time"),
        ),
    )


def parse_hl7_date(v: Column | str) -> Column:
    """An exact ``yyyyMMdd`` value -> date (day clamped), else null."""
    s = col_of(v)
    y, m, d = _int(s, 1, 4), _int(s, 5, 2), _int(s, 7, 2)
    ok = s.rlike("^[0-9]{8}$") & _date_ok(y, m, d)
    return F.when(ok, _clamped_date(y, m, d, F.lit(0)))


def parse_exact_timestamp(v: Column | str) -> Column:
    """An exact ``yyyyMMddHHmmss`` value -> ``yyyy-MM-dd HH:mm:ss`` text, else null."""
    s = col_of(v)
    y, m, d = _int(s, 1, 4), _int(s, 5, 2), _int(s, 7, 2)
    h, mi, sec = _int(s, 9, 2), _int(s, 11, 2), _int(s, 13, 2)
    ok = (
        s.rlike("^[0-9]{14}$")
        & _date_ok(y, m, d)
        & (mi <= 59)
        & (sec <= 59)
        & ((h <= 23) | ((h == 24) & (mi == 0) & (sec == 0)))
    )
    rolled = F.when(h == 24, F.lit(1)).otherwise(F.lit(0))
    return F.when(
        ok,
        F.concat(
            format_date(_clamped_date(y, m, d, rolled)),
            F.format_string(" %02d:%02d:%02d", h % 24, mi, sec),
        ),
    )


def format_date(d: Column | str) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(col_of(d), "yyyy-MM-dd")
