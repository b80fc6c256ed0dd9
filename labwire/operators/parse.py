"""ER7 parsing as a table-level Spark job (P1-P4, P2 long form).

Parsing is staged, and every stage is fenced (:func:`stage`):

1. ``clean_messages``: decode, sanitize, delimiters, and the per-message
   helper columns (split pattern, whether an escape occurs);
2. ``locate_segments``: segment positions by literal search, then the
   header, first ORC, first-order OBR and first PID split into field arrays,
   of which a caller names those it reads (a fence is not pruned through);
3. ``raw_fields``: each HL7 position a query needs, as one plain string
   column (component picked, then escapes resolved), computed exactly once.

Everything after that (nulls, gates, dates, routes, structs) reads those
columns.  Keeping each value a column keeps the generated code small: an
expression that repeats its input inside conditional branches is not
de-duplicated by Spark's code generator.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwire.functions.hl7 import (
    SEGMENT_SEP,
    Encoding,
    before_opening,
    encoding_of,
    component,
    field,
    first_order_position,
    first_segment,
    from_position,
    has_escape,
    normalize_segments,
    opened_at,
    plain_fields,
    plain_values,
    segment_at,
    segment_start,
    split_fields,
    split_pattern,
    unescape,
    value,
)
from labwire.functions.text import sanitized
from labwire.sources.records import ARRIVAL, decode

ENCODING_COLUMNS = ["fs", "cs", "rs", "esc", "ss"]
SEGMENTS = ("msh", "orc", "obr", "pid")
# The values of a plain message and whether one of them holds an escape character.
FLAT = ("flat", "flat_esc")

Position = tuple[str, int, int]  # (segment array, field, component)

# HL7 positions read by each projection.
GATE_POSITIONS: tuple[Position, ...] = (("msh", 9, 1), ("msh", 9, 2), ("msh", 9, 3), ("msh", 12, 1))
ORDER_POSITIONS: tuple[Position, ...] = (
    ("msh", 3, 1), ("msh", 4, 2), ("msh", 6, 1), ("msh", 10, 1),
    ("orc", 2, 1), ("obr", 4, 1), ("obr", 4, 4), ("obr", 7, 1),
)
# What the one-pass match of a plain message gives (``hl7.plain_values``).
FLAT_POSITIONS = GATE_POSITIONS + ORDER_POSITIONS
HEADER_POSITIONS: tuple[Position, ...] = (
    ("msh", 4, 2), ("msh", 6, 1), ("msh", 7, 1), ("msh", 9, 3), ("msh", 10, 1), ("msh", 12, 1), ("msh", 16, 1),
)
PATIENT_POSITIONS: tuple[Position, ...] = (
    ("pid", 3, 1), ("pid", 5, 1), ("pid", 5, 2), ("pid", 7, 1), ("pid", 8, 1),
)


def stage(df: DataFrame) -> DataFrame:
    """Fence a costly stage from the optimiser.

    A filter on a derived column is normally pushed below the projections
    that derive it, which re-inlines the whole parse expression into the
    filter and evaluates it twice per row.  A generator is not crossed by
    predicate pushdown or projection collapse, so ``inline(array(struct(*)))``
    (one row in, the same row out) keeps each stage computed exactly once
    while staying inside whole-stage code generation.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


# Expression lists are built once per process and reused by every plan
# (columns are immutable expression trees); this keeps plan construction,
# which is many small JVM calls, out of each query's running time.

@functools.cache
def _clean_exprs() -> tuple[Column, list[Column], list[Column]]:
    msg = normalize_segments("clean").alias("msg")
    enc = encoding_of("msg")
    delims = [enc[n].alias(n) for n in ENCODING_COLUMNS]
    e = Encoding.from_columns()
    final = [
        split_pattern(e.fs).alias("fs_pat"),
        has_escape(F.col("msg"), e).alias("has_esc"),
        F.col("msg"),
    ]
    return msg, delims, final


def clean_messages(records: DataFrame, with_raw: bool = True, flat: bool = False) -> DataFrame:
    """S3 + P1: raw records -> ``partition offset is_empty [raw_message]`` +
    delimiters + helpers + ``msg`` (the clean text).

    With ``flat``, a plain message gives the array ``flat`` of its ``FLAT_POSITIONS`` in one
    pass and has no ``msg``: the steps that follow meet a null and do nothing."""
    msg, delims, final = _clean_exprs()
    kept = [*ARRIVAL, "is_empty", *(["raw_message"] if with_raw else []), *(FLAT if flat else [])]
    decoded, text = decode(records), "raw_message"
    if flat:
        joined = decoded.withColumn("_joined", plain_values(text))
        decoded = joined.withColumns({"flat": plain_fields("_joined"), "flat_esc": F.col("_joined").contains("\\")})
        decoded, text = decoded.withColumn("_text", F.when(F.col("flat").isNull(), F.col(text))), "_text"
    s1 = sanitized(decoded, text, "clean").select(*kept, msg)
    s2 = s1.select("*", *delims)
    return s2.select(*kept, *ENCODING_COLUMNS, *final)


def er7_ok(msg: Column, fs: Column) -> Column:
    """Structural ER7 check: starts with MSH, every segment of 4+ characters
    has the field separator 4th, and at least 11 field separators overall."""
    # the first segment's 4th character is the separator by definition, so
    # only segments after a "\\r" can break the rule
    bad_segment = F.concat(F.lit("\\r[^\\r]{3}(?!\\Q"), fs, F.lit("\\E)[^\\r]"))
    # the text before the 11th separator: all of it when there are fewer
    before_11th = F.call_function("substring_index", msg, fs, F.lit(11))
    return (
        msg.startswith("MSH")
        & (F.octet_length(msg) >= 4)  # of characters too: the first three are one byte each
        & (F.call_function("regexp_instr", msg, bad_segment) == 0)
        & (F.octet_length(before_11th) < F.octet_length(msg))
    )


def locate_segments(cleaned: DataFrame, segments: Sequence[str] = SEGMENTS) -> DataFrame:
    """Split the header, first ORC, first-order OBR and first PID into field arrays.

    Segments are found by literal search and then cut at their positions.  Each
    search and each position is a column of a projection of its own, so it runs
    once per message.  Only the arrays named by ``segments`` leave the stage.
    """
    carried = [c for c in ("raw_message", *FLAT) if c in cleaned.columns]
    keep = [*ARRIVAL, "is_empty", *carried, *ENCODING_COLUMNS, "has_esc"]
    searches, found, rest, second, arrays = _locate_exprs()
    base = [*keep, "msg", "fs_pat"]
    positions = cleaned.select(*base, *searches).select(*base, "is_er7", *found).select("*", rest)
    positions = positions.select("*", before_opening("from_orc", "ORC").alias("b_orc2")).select("*", second)
    return positions.select(*keep, "is_er7", *[arrays[s] for s in SEGMENTS if s in segments])


@functools.cache
def _locate_exprs() -> tuple[list[Column], list[Column], Column, Column, dict[str, Column]]:
    msg, fs, pat = F.col("msg"), F.col("fs"), F.col("fs_pat")
    names = ("ORC", "OBR", "PID")
    searches = [er7_ok(msg, fs).alias("is_er7"), *[before_opening(msg, n).alias(f"b_{n.lower()}") for n in names]]
    found = [opened_at(msg, F.col(f"b_{n.lower()}"), n, fs, segment_start(msg, n, fs)).alias(f"p_{n.lower()}") for n in names]
    p_orc, from_orc = F.col("p_orc"), F.col("from_orc")
    rest = from_position(msg, p_orc).alias("from_orc")
    # without a first ORC the rest is empty, and nothing is found in it
    second = opened_at(from_orc, F.col("b_orc2"), "ORC", fs, segment_start(msg, "ORC", fs, p_orc + 1), p_orc).alias("p_orc2")
    obr = first_order_position(F.col("p_obr"), p_orc, F.col("p_orc2"))
    arrays = {
        "msh": split_fields(first_segment(msg), pat).alias("msh"),
        "orc": split_fields(first_segment(from_orc), pat).alias("orc"),
        "obr": split_fields(segment_at(msg, obr), pat).alias("obr"),
        "pid": split_fields(segment_at(msg, F.col("p_pid")), pat).alias("pid"),
    }
    return searches, found, rest, second, arrays


def spread(records: DataFrame, min_partitions: int | None) -> DataFrame:
    """Split a feed that arrives in too few partitions (one small file, a
    topic with few partitions) before the per-row parse, which is the costly
    part; a feed that is already wide is left alone (no shuffle).

    Call it on a scan: counting a scan's partitions only lists files, while
    on a plan with exchanges it would run those stages first.
    """
    if not min_partitions:
        return records
    if records.rdd.getNumPartitions() >= min_partitions:
        return records
    return records.repartition(min_partitions)


def segments_of(positions: Iterable[Position]) -> tuple[str, ...]:
    """The segment arrays that a set of positions reads."""
    used = {seg for seg, _, _ in positions}
    return tuple(s for s in SEGMENTS if s in used)


def parse_messages(records: DataFrame, fence: bool = True, min_partitions: int | None = None,
                   segments: Sequence[str] = SEGMENTS, with_raw: bool = True, flat: bool = False) -> DataFrame:
    """Raw records -> one row per record with delimiters and segment arrays.

    ``min_partitions`` (like Kafka's ``minPartitions``) widens a narrow feed;
    ``segments`` and ``with_raw`` name what leaves the parse.  With ``flat`` a
    plain message has the values of ``FLAT_POSITIONS`` in ``flat`` and no segment
    arrays (``raw_fields`` reads either).
    """
    cleaned = clean_messages(spread(records, min_partitions), with_raw, flat)
    if fence:
        cleaned = stage(cleaned)
    located = locate_segments(cleaned, segments)
    return stage(located) if fence else located


def raw_name(pos: Position) -> str:
    seg, n, c = pos
    return f"{seg}_{n}_{c}"


def raw_fields(parsed: DataFrame, positions: Iterable[Position], keep: Sequence[str] = (), fence: bool = True) -> DataFrame:
    """The given HL7 positions as string columns named ``{seg}_{n}_{c}``
    ('' when absent), plus the ``keep`` columns of the parsed frame."""
    positions, flat = tuple(dict.fromkeys(positions)), "flat" in parsed.columns
    if flat and positions != FLAT_POSITIONS:
        raise ValueError("a frame of plain messages holds FLAT_POSITIONS alone")
    picked, resolved, cols = _raw_exprs(positions)
    out = parsed.select(*keep, *(_flat_encoding() if flat else ENCODING_COLUMNS), *(_flat_exprs(picked) if flat else ["has_esc", picked]))
    out = out.select(*keep, resolved).select(*keep, *cols)
    return stage(out) if fence else out


def _flat_encoding() -> list[Column]:
    """The usual delimiters where a message is plain."""
    return [F.coalesce(n, F.lit(d)).alias(n) for n, d in zip(ENCODING_COLUMNS, "|^~\\&")]


def _flat_exprs(picked: Column) -> list[Column]:
    flat = F.col("flat")
    return [F.when(flat.isNotNull(), F.col("flat_esc")).otherwise(F.col("has_esc")).alias("has_esc"),
            F.when(flat.isNotNull(), flat).otherwise(picked).alias("_picked")]


@functools.cache
def _raw_exprs(positions: tuple[Position, ...]) -> tuple[Column, Column, list[Column]]:
    # the values go through one array, so the escape rule is generated once
    # (not per position) and runs only for messages that hold an escape
    enc, picked = Encoding.from_columns(), F.col("_picked")
    values = F.array(*[component(field(F.col(seg), n, msh=(seg == "msh")), enc, c) for seg, n, c in positions])
    # a value without the escape character is left as it is, without a regex
    one = lambda v: F.when(v.contains(enc.esc), unescape(v, enc)).otherwise(v)
    resolved = F.when(F.col("has_esc"), F.transform(picked, one)).otherwise(picked)
    cols = [F.get(F.col("_values"), i).alias(raw_name(p)) for i, p in enumerate(positions)]
    return values.alias("_picked"), resolved.alias("_values"), cols


def v(seg: str, n: int, c: int = 1) -> Column:
    """Value at an HL7 position (a ``raw_fields`` column), empty -> null."""
    return value(F.col(raw_name((seg, n, c))))


def message_structure() -> Column:
    """MSH-9.3, or ``MSH-9.1 _ MSH-9.2`` when the structure is not given."""
    return F.coalesce(v("msh", 9, 3), F.concat_ws("_", v("msh", 9, 1), v("msh", 9, 2)))


def accepts(structure: str, version: str = "2.5") -> Column:
    """P3/P4 gate: an ER7 message of the given structure and version.

    Needs ``is_er7``, ``structure`` and ``version`` columns.
    """
    return F.col("is_er7") & (F.col("version") == version) & (F.col("structure") == structure)


def gate_columns() -> list[Column]:
    """``structure`` and ``version`` over ``raw_fields(…, GATE_POSITIONS)``."""
    return [message_structure().alias("structure"), v("msh", 12).alias("version")]


def segments_long(cleaned: DataFrame, with_fields: bool = False) -> DataFrame:
    """P2 long form: one row per segment ``(offset, seg_idx, seg_name, n_fields)``,
    plus the unescaped ``fields`` array when ``with_fields`` is set.

    Segments shorter than 3 characters (blank lines left by note removal)
    are skipped, as a parser would, and ``seg_idx`` counts the kept ones
    from 1; only ER7-shaped messages (starting with MSH) take part.
    """
    er7 = stage(cleaned).filter(F.col("msg").startswith("MSH"))
    # drop short segments (with their separator) before splitting, so the
    # positions of the kept segments are dense; a short last segment has no
    # separator after it and is dropped after the explode (it is last)
    compact = F.regexp_replace(F.col("msg"), "(?:^|(?<=\\r))[^\\r]{0,2}\\r", "")
    exploded = er7.select(*ARRIVAL, *ENCODING_COLUMNS, "fs_pat", "has_esc", F.posexplode(F.split(compact, SEGMENT_SEP, -1)).alias("pos", "segment"))
    kept = exploded.filter(F.length("segment") >= 3)
    fields = split_fields(F.col("segment"), F.col("fs_pat"))
    cols = [
        *ARRIVAL,
        (F.col("pos") + 1).alias("seg_idx"),
        F.call_function("substring_index", F.col("segment"), F.col("fs"), F.lit(1)).alias("seg_name"),
        F.size(fields).alias("n_fields"),
    ]
    if with_fields:
        enc = Encoding.from_columns()
        cols.append(F.when(F.col("has_esc"), F.transform(fields, lambda f: unescape(f, enc))).otherwise(fields).alias("fields"))
    return kept.select(*cols)
