"""HL7 v2 (ER7, pipe-delimited) positional access as Spark column expressions.

Conventions (1-based, as HL7 counts):

* the field separator is the 4th character of the message; MSH-2 holds the
  component, repetition, escape and subcomponent characters, in that order;
* ``MSH-n`` is element ``n-1`` of the MSH segment split on the field separator
  (MSH-1 *is* the separator); for every other segment ``X-n`` is element ``n``;
* a value is taken from the first repetition, then the component, then the
  first subcomponent, then escape sequences are resolved; empty means null.

Delimiters are read per message, so no literal ``|`` is baked into the logic.
All patterns built from a per-row delimiter are identical for every row of a
well-formed feed, and Spark's regexp expressions recompile only when the
pattern string changes, so the dynamic patterns cost one compile per task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwire.functions._util import col_of

SEGMENT_SEP = "\r"


@dataclass(frozen=True)
class Encoding:
    """Per-message delimiter columns (use materialised column names)."""

    fs: Column  # field separator
    cs: Column  # component separator
    rs: Column  # repetition separator
    esc: Column  # escape character
    ss: Column  # subcomponent separator

    @staticmethod
    def from_columns(prefix: str = "") -> "Encoding":
        return Encoding(*(F.col(prefix + n) for n in ("fs", "cs", "rs", "esc", "ss")))


# Stand-in for a delimiter the header does not declare: it never occurs in
# text, so a search for it finds nothing and the whole value is kept.
NO_DELIMITER = "\u0000"


def encoding_of(msg: Column | str) -> dict[str, Column]:
    """Delimiter columns ``fs cs rs esc ss`` read from the message header."""
    m = col_of(msg)
    fs = F.substring(m, 4, 1)
    # a separator that ends the segment is not in it
    msh2 = F.when(fs == SEGMENT_SEP, F.lit("")).otherwise(_last_part(_parts(F.substring_index(m, SEGMENT_SEP, 1), fs, 2), fs))

    def char(i: int) -> Column:
        c = F.substring(msh2, i, 1)
        return F.when(c == "", F.lit(NO_DELIMITER)).otherwise(c)

    return {"fs": fs, "cs": char(1), "rs": char(2), "esc": char(3), "ss": char(4)}


# Characters a segment may be indented with; a parser skips them.
_LEADING_BLANKS = "[\\t\\x0B\\f \\x1C-\\x1F]"


def normalize_segments(msg: Column | str) -> Column:
    """Strip leading blanks of every segment after the first."""
    # the replacement is a real carriage return: in a Java replacement string
    # a backslash only quotes the next character ("\\r" would give "r")
    return F.regexp_replace(col_of(msg), "\\r" + _LEADING_BLANKS + "+", SEGMENT_SEP)


def _quote(c: Column) -> Column:
    return F.concat(F.lit("\\Q"), c, F.lit("\\E"))


def _locate(needle: Column, hay: Column, start: Column | int = 1) -> Column:
    return F.call_function("locate", needle, hay, start if isinstance(start, Column) else F.lit(start))


def segment_start(msg: Column | str, name: str, fs: Column, after: Column | int = 1) -> Column:
    """Position of the ``\\r`` that opens the first ``name`` segment at or
    after ``after`` (0 when absent).  The message starts with MSH, so every
    other segment follows a segment separator.  The name is followed by the
    field separator, or stands alone on its line (a segment without fields);
    literal searches, no regex."""
    m, opening = col_of(msg), F.lit(SEGMENT_SEP + name)
    last = F.length(m) - len(name)  # a bare segment at the end of the text
    return F.coalesce(
        F.least(
            F.nullif(_locate(F.concat(opening, fs), m, after), F.lit(0)),
            F.nullif(_locate(F.lit(SEGMENT_SEP + name + SEGMENT_SEP), m, after), F.lit(0)),
            F.when(m.endswith(opening) & (last >= after), last),
        ),
        F.lit(0),
    )


def before_opening(text: Column | str, name: str) -> Column:
    """Number of characters before the first ``\\r`` + ``name``, all when there is none.

    A search by bytes; ``locate`` compares the needle at every character and
    took a third of the parse."""
    return F.length(F.substring_index(col_of(text), SEGMENT_SEP + name, 1))


def opened_at(text: Column | str, before: Column, name: str, fs: Column, exact: Column, skipped: Column | int = 0) -> Column:
    """:func:`segment_start` from ``before``, a column of :func:`before_opening` over ``text``,
    which is the message without its first ``skipped`` characters.

    Every segment of the name begins with that opening, so where the first one is
    followed by the field separator, a segment separator or nothing, it is the
    segment; else (a longer name) ``exact`` is evaluated."""
    t = col_of(text)
    after = F.substring(t, before + 2 + len(name), F.lit(1))
    return (
        F.when(before >= F.length(t), 0)
        .when((after == fs) | (after == SEGMENT_SEP) | (after == ""), before + 1 + skipped)
        .otherwise(exact)
    )


def from_position(msg: Column | str, pos: Column) -> Column:
    """The text right after the ``\\r`` at ``pos`` ('' when 0); a materialised column."""
    return F.when(pos > 0, F.substring(col_of(msg), pos + 1, F.lit(2**31 - 1))).otherwise(F.lit(""))


def first_segment(text: Column | str) -> Column:
    """The text up to the first segment separator."""
    return F.substring_index(col_of(text), SEGMENT_SEP, 1)


def segment_at(msg: Column | str, pos: Column) -> Column:
    """The segment that starts right after the ``\\r`` at ``pos`` ('' when 0).

    ``pos`` should be a materialised column (see :func:`segment_start`)."""
    return first_segment(from_position(msg, pos))


def first_order_position(obr_pos: Column, orc_pos: Column, orc2_pos: Column) -> Column:
    """Keep a segment position only inside the first order group: before the
    second ORC (the group is the first ORC plus what follows until the next)."""
    return F.when((obr_pos > 0) & ((orc2_pos == 0) | (obr_pos < orc2_pos)), obr_pos).otherwise(F.lit(0))


def split_pattern(fs: Column) -> Column:
    """Regex for ``split`` on the field separator.

    A backslash-escaped punctuation character takes Java's no-regex fast path,
    a letter or digit is already literal; materialise it once per message.
    """
    return (
        F.when(fs == "", F.lit("\u0000"))  # no separator (not a message): one field
        .when(fs.rlike("^[0-9A-Za-z]$"), fs)
        .otherwise(F.concat(F.lit("\\"), fs))
    )


def split_fields(segment: Column | str, pattern: Column) -> Column:
    """Array of the fields of one segment (element 0 is the segment name);
    ``pattern`` comes from :func:`split_pattern`."""
    return F.call_function("split", col_of(segment), pattern, F.lit(-1))


def field(fields: Column | str, n: int, msh: bool = False) -> Column:
    """Field ``n`` of a split segment ('' when absent)."""
    idx = n - 1 if msh else n
    return F.coalesce(F.get(col_of(fields), idx), F.lit(""))


def _parts(s: Column, delim: Column, n: int) -> Column:
    """The first ``n`` parts of the text with the ``delim`` between them (all when
    there are fewer), without splitting the whole string into an array."""
    return F.call_function("substring_index", s, delim, F.lit(n))


def _first_part(s: Column, delim: Column) -> Column:
    return _parts(s, delim, 1)


def _last_part(s: Column, delim: Column) -> Column:
    return F.call_function("substring_index", s, delim, F.lit(-1))


def _part(s: Column, delim: Column, n: int) -> Column:
    """Part ``n`` (2 or more), '' when absent, as ``split_part``, which decodes the text and
    splits all of it by a regex."""
    absent = F.octet_length(_parts(s, delim, n - 1)) == F.octet_length(s)
    return F.when(absent, F.lit("")).otherwise(_last_part(_parts(s, delim, n), delim))


def component(fld: Column, enc: Encoding, c: int = 1) -> Column:
    """First repetition -> component ``c`` -> first subcomponent (raw, escaped)."""
    rep = _first_part(fld, enc.rs)
    comp = _first_part(rep, enc.cs) if c == 1 else _part(rep, enc.cs, c)
    return _first_part(comp, enc.ss)


# The standard escape sequences and what they stand for:
# F S T R E -> field, component, subcomponent, repetition, escape character.
ESCAPE_CODES = "FSTRE"


def has_escape(msg: Column, enc: Encoding) -> Column:
    """Does an escape character occur behind the header's own declaration?"""
    return (enc.esc != NO_DELIMITER) & F.substring(msg, 9, 2**31 - 1).contains(enc.esc)


def unescape(v: Column, enc: Encoding) -> Column:
    """Resolve ``\\F\\ \\S\\ \\T\\ \\R\\ \\E\\`` in a value that was split out before.

    A split value holds no field separator, so that character can tag the
    sequences: one regex pass finds them as a left-to-right scan would and
    leaves the separator and the code, then each tag is replaced, the field
    separator's own last.  No other character of the text is touched.
    """
    pattern = F.concat(_quote(enc.esc), F.lit("([" + ESCAPE_CODES + "])"), _quote(enc.esc))
    # in a Java replacement string a backslash quotes the separator
    out = F.call_function("regexp_replace", v, pattern, F.concat(F.lit("\\"), enc.fs, F.lit("$1")))
    for code, char in (("S", enc.cs), ("T", enc.ss), ("R", enc.rs), ("E", enc.esc), ("F", enc.fs)):
        out = F.replace(out, F.concat(enc.fs, F.lit(code)), char)
    return out


# A message in the usual delimiters, matched as a whole: its lines end with "\r\n", "\r" or "\n",
# begin with no blank and are not empty, and their 4th character, if any, is the separator.  No
# step of the cleanup then moves a value, and the ER7 check holds.  Every repeat is atomic or
# possessive, so a text is walked through once, in a loop.  (A class repeated in an atomic group is
# a tight loop in java.util.regex, a possessive one is not; a class of single characters below 256
# is a table.)  No match: a header of another shape, an ORC after an OBR without one.
_ENDS = r"\r\n\x85"
# Line ends of a regex beyond that table; texts that hold one are not matched.
_WIDE_ENDS = ("\u2028", "\u2029")
# The two bytes that both begin with.
_WIDE_BYTES = b"\xe2\x80"
_EOL = r"(?:\r\n?+|\n)"
_IN_LINE = f"(?>[^{_ENDS}]*)"
_IN_FIELD = f"(?>[^|{_ENDS}]*)"
_IN_COMPONENT = rf"(?>[^|\^~{_ENDS}]*)"
_VALUE = rf"(?>[^|\^~\&{_ENDS}]*)"
_LINE = rf"[^{_ENDS}\t\x0B\f \x1C\x1D\x1E\x1F][^{_ENDS}]{{0,2}}+(?:\|{_IN_LINE})?+"


def _components(names: dict[int, str]) -> str:
    """A field, up to its end, whose named components are groups."""
    out = ""
    for c in range(max(names, default=0), 0, -1):
        one = f"(?<{names[c]}>{_VALUE}){_IN_COMPONENT}" if c in names else _IN_COMPONENT
        out = one + out if c == 1 else rf"(?:\^{one}{out})?+"
    return out + _IN_FIELD


def _segment(fields: dict[int, dict[int, str]]) -> str:
    """Fields 1, 2, ... of a segment, each of which may be absent, up to the end of the line."""
    out = _IN_LINE
    for n in range(max(fields), 0, -1):
        out = rf"(?:\|{_components(fields.get(n, {}))}{out})?+"
    return out


def _plain_message() -> str:
    header = {3: {1: "msh31"}, 4: {2: "msh42"}, 6: {1: "msh61"}, 9: {1: "msh91", 2: "msh92", 3: "msh93"}, 10: {1: "msh101"}, 12: {1: "msh121"}}
    msh = r"\AMSH\|\^~\\&" + "".join(r"\|" + _components(header.get(n, {})) for n in range(3, 13)) + _IN_LINE
    orc = _EOL + "ORC" + _segment({2: {1: "orc21"}})
    obr, early = (_EOL + "OBR" + _segment({4: {1: f"obr41{x}", 4: f"obr44{x}"}, 7: {1: f"obr71{x}"}}) for x in ("", "b"))
    other, no_orc, line = (f"(?:{_EOL}{but}{_LINE})*+" for but in ("(?!ORC|OBR)", "(?!ORC)", ""))
    return f"{msh}{other}(?:{orc}{other}(?:{obr})?+{line}|{early}{no_orc})?+{_EOL}?+\\z"


PLAIN_MESSAGE = _plain_message()
PLAIN_HEADER = "MSH|^~\\&|"
# The values of a plain message, in the order of ``parse.FLAT_POSITIONS``; only one of two groups is set.
_GROUPS = {name: f"${i}" for i, name in enumerate(re.findall(r"\(\?<(\w+)>", PLAIN_MESSAGE), 1)}
_PLAIN_VALUES = SEGMENT_SEP.join("".join(_GROUPS[name] for name in names.split("+")) for names in (
    "msh91", "msh92", "msh93", "msh121", "msh31", "msh42", "msh61", "msh101",
    "orc21", "obr41+obr41b", "obr44+obr44b", "obr71+obr71b"))


def plain_values(text: Column | str) -> Column:
    """The header and order values of a plain message, joined by the segment separator, in one
    pass; any other text that begins like one is returned as it is, and the rest are null."""
    t = col_of(text)
    # one search by bytes for most texts
    ends = ~t.contains(F.lit(_WIDE_BYTES).cast("string")) | ~(t.contains(_WIDE_ENDS[0]) | t.contains(_WIDE_ENDS[1]))
    return F.when(t.startswith(PLAIN_HEADER) & ends, F.regexp_replace(t, PLAIN_MESSAGE, _PLAIN_VALUES))


def plain_fields(joined: Column | str) -> Column:
    """:func:`plain_values` as an array, null for a message that is not plain: its text still
    begins with its header, and a value holds no separator."""
    j = col_of(joined)
    return F.when(~j.startswith("MSH|"), F.split(j, SEGMENT_SEP, -1))


def value(raw: Column) -> Column:
    """HL7 empty means null."""
    return F.nullif(raw, F.lit(""))


# Fixed values of the message-type map: structure name -> type, else ACK.
# "OML_021" is spelled with a digit zero, as in the original mapping, so a
# real OML_O21 header maps to ACK unless ``fix_oml`` is set.
MESSAGE_TYPES = ("ORU_R01", "OML_021")


def message_type_name(structure: Column, fix_oml: bool = False) -> Column:
    """Message structure -> type name; null structure -> null."""
    s = structure
    out = F.when(s == "ORU_R01", F.lit("ORU_R01")).when(s == "OML_021", F.lit("OML_021"))
    if fix_oml:
        out = out.when(s == "OML_O21", F.lit("OML_021"))
    return F.when(s.isNotNull(), out.otherwise(F.lit("ACK")))


# Fixed values of the sex map: M -> MALE, F -> FEMALE, anything else -> OTHER.
def gender_name(sex: Column) -> Column:
    """Administrative sex -> gender; null stays null (caller nulls the struct)."""
    return (
        F.when(sex.isNull(), F.lit(None).cast("string"))
        .when(sex == "M", F.lit("MALE"))
        .when(sex == "F", F.lit("FEMALE"))
        .otherwise(F.lit("OTHER"))
    )
