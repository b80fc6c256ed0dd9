import calendar
import datetime as dt

from hypothesis import given, settings, strategies as st

from labwire.functions.dates import parse_exact_timestamp, parse_hl7_date, parse_hl7_datetime
from tests.helpers import lit_col


def _dt(spark, values):
    df = lit_col(spark, values).select("i", parse_hl7_datetime("v").alias("d"))
    return [(r["d"]["date"], r["d"]["time"]) if r["d"] else None for r in df.orderBy("i").collect()]


def test_smart_datetime_edge_rows(spark):
    got = _dt(spark, ["202402311015", "202404312330", "202412312400", "20240101123437+0200"])
    assert got == [
        (dt.date(2024, 2, 29), "10:15:00"),
        (dt.date(2024, 4, 30), "23:30:00"),
        (dt.date(2025, 1, 1), "00:00:00"),
        (dt.date(2024, 1, 1), "12:34:00"),
    ]


def test_smart_datetime_rejects(spark):
    bad = ["202413010000", "202401012500", "202401012401", "202401010060", "000001010000",
           "20240101123", "2024010112.3", "", None, "202401320000", "202400010000"]
    assert _dt(spark, bad) == [None] * len(bad)


def _smart(s):
    """Python statement of the lenient rule, for the property test."""
    if s is None or len(s) < 12 or not s[:12].isdigit():
        return None
    y, m, d, h, mi = int(s[:4]), int(s[4:6]), int(s[6:8]), int(s[8:10]), int(s[10:12])
    if y < 1 or not 1 <= m <= 12 or not 1 <= d <= 31 or mi > 59:
        return None
    if h > 24 or (h == 24 and mi != 0):
        return None
    day = min(d, calendar.monthrange(y, m)[1])
    date = dt.date(y, m, day) + dt.timedelta(days=1 if h == 24 else 0)
    return (date, f"{h % 24:02d}:{mi:02d}:00")


digits = st.text(alphabet="0123456789", min_size=12, max_size=14)
plausible = st.builds(
    lambda y, m, d, h, mi, tail: f"{y:04d}{m:02d}{d:02d}{h:02d}{mi:02d}{tail}",
    st.integers(0, 9999), st.integers(0, 14), st.integers(0, 33), st.integers(0, 26),
    st.integers(0, 61), st.sampled_from(["", "00", "37+0200", "x"]),
)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(digits, plausible), min_size=200, max_size=200))
def test_smart_datetime_matches_rule(spark, values):
    assert _dt(spark, values) == [_smart(v) for v in values]


def test_birth_date_and_exact_timestamp(spark):
    df = lit_col(spark, ["19900231", "199001", "19900102", "1990010a"])
    got = [r[0] for r in df.orderBy("i").select(parse_hl7_date("v")).collect()]
    assert got == [dt.date(1990, 2, 28), None, dt.date(1990, 1, 2), None]
    df = lit_col(spark, ["20240101080000", "202401010800", "20241231240000", "20240101235960"])
    got = [r[0] for r in df.orderBy("i").select(parse_exact_timestamp("v")).collect()]
    assert got == ["2024-01-01 08:00:00", None, "2025-01-01 00:00:00", None]
