"""Prefix-target chat formatting.

A turn is formatted as ``<s>role\\ntext</s>``.  Control strings (``<s>``,
``</s>``, ``[INST]``, ``[/INST]`` and whatever begins with ``<`` or ``[``)
cannot occur inside: ``\\`` becomes ``\\b``, ``<`` becomes ``\\l``, ``[`` becomes
``\\k``, and a line feed in a role ``\\n``; each code is reversed exactly.

Every assistant turn is exploded into an example of its own: all earlier turns
of its conversation as context, and only that reply trainable.  A conversation
that does not end in a reply gets one more row set, its whole text without a
trainable span (``is_target`` false), so that its last turns are not lost.

An example is written in chunks: a turn belongs to the chunk of
``CHUNK_CHARS`` characters in which it begins, and an example holds every
earlier chunk of its conversation whole and its own up to its reply.  Reading
an example's chunks in order gives its text; the loss span ``[loss_start,
loss_end)`` counts characters from the example's start and stands with its
last chunk.  The output is the examples' full text, so it grows with the
square of a conversation's turns, as the method does.  No value is longer than
a chunk and a turn, and a long conversation's contexts are made by (chunk of
the target, earlier chunk), so they are spread over tasks by the join.

Positions come from a window over the conversation, which keeps a running
count.  (A conversation's SHA-256 is sequential by definition, so one task
reads it through, streamed.)

Defined results: a null text or role is empty; turns are ordered by number
(null first), equal numbers by role and text; a null conversation id is a
conversation of its own; one without an assistant turn has no example, only
its text; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labwire.llm import common as c

OPEN, CLOSE = "<s>", "</s>"
TARGET = "assistant"
#: Fixed codes of the template: character -> code after a backslash.
CODES = [("\\", "\\b"), ("<", "\\l"), ("[", "\\k")]
LINE = ("\n", "\\n")
#: Characters of a chunk of a conversation; a turn that begins in it is whole.
CHUNK_CHARS = 1 << 16
PROBE = "</s>[INST] ok [/INST]"


def escape(col, line: bool = False):
    for ch, code in CODES + ([LINE] if line else []):
        col = F.replace(col, F.lit(ch), F.lit(code))
    return col


def unescape(col, line: bool = False):
    for ch, code in ([LINE] if line else []) + CODES[::-1]:
        col = F.replace(col, F.lit(code), F.lit(ch))
    return col


def _positions(turns: DataFrame, chunk_chars: int) -> DataFrame:
    """One row per turn: conv_id, position, segment, is_target, is_last, chunk, begin, head_chars, chars."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), line=True), F.lit("\n"))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("head", head).withColumn("segment", F.concat("head", escape(F.col("text")), F.lit(CLOSE)))
    rows = rows.withColumn("head_chars", F.length("head")).withColumn("chars", F.length("segment"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("position", F.row_number().over(order).cast("bigint") - 1).withColumn("begin", upto - F.col("chars"))
    return rows.select(
        "conv_id", "position", "segment", (F.col("role") == TARGET).alias("is_target"), F.lead("chars").over(order).isNull().alias("is_last"),
        F.floor(F.col("begin") / chunk_chars).alias("chunk"), "begin", "head_chars", "chars")


def prefix_targets(turns: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The examples in chunks: conv_id, position (of the target), chunk, begin (the chunk's first character in the
    example), text, is_target, is_last (the conversation's last turn), loss_start, loss_end (with the last chunk)."""
    end = F.col("begin") + F.col("chars")
    target = F.when(F.col("is_target") | F.col("is_last"), F.struct(
        "position", "is_target", "is_last", end.alias("end"),
        F.when(F.col("is_target"), F.col("begin") + F.col("head_chars")).alias("loss_start"),
        F.when(F.col("is_target"), end - len(CLOSE)).alias("loss_end")))
    chunks = _positions(turns, chunk_chars).groupBy("conv_id", "chunk").agg(  # a group is a chunk's turns
        F.min("begin").alias("begin"),
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("position", "segment"))), lambda x: x["segment"])).alias("text"),
        F.collect_list(target).alias("targets"))
    chunks = c.staged(chunks, "chunks")
    named = [F.col("t.position").alias("position"), "chunk", "begin", "text", F.col("t.is_target").alias("is_target"), F.col("t.is_last").alias("is_last")]
    own = chunks.select("conv_id", "chunk", "begin", "text", F.explode("targets").alias("t")).withColumn(
        "text", F.expr("substring(text, 1, cast(t.end - begin as int))"))
    own = own.select("conv_id", *named, F.col("t.loss_start").alias("loss_start"), F.col("t.loss_end").alias("loss_end"))
    none = F.lit(None).cast("bigint")
    later = chunks.filter((F.col("chunk") > 0) & (F.size("targets") > 0)).select(
        F.col("conv_id").alias("of"), "targets", F.explode(F.expr("sequence(0, chunk - 1)")).alias("earlier"))
    before = chunks.drop("targets").join(later, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("earlier"))).select(
        "conv_id", "chunk", "begin", "text", F.explode("targets").alias("t"))
    return own.unionByName(before.select("conv_id", *named, none.alias("loss_start"), none.alias("loss_end")))


def render(output: DataFrame, chosen: DataFrame) -> DataFrame:
    """Full texts of the chosen examples (conv_id, position): conv_id, position, example, loss_start, loss_end."""
    want = chosen.select(F.col("conv_id").alias("of"), F.col("position").alias("target")).distinct()
    got = output.join(want, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("position") == F.col("target")), "left_semi")
    return got.groupBy("conv_id", "position").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda x: x["text"])).alias("example"),
        F.max("loss_start").alias("loss_start"), F.max("loss_end").alias("loss_end"))


def _parsed(output: DataFrame) -> DataFrame:
    """The turns of whole conversations (from the example of each one's last turn): conv_id, kind 0, place, role, text, chars."""
    pieces = output.filter("is_last").select("conv_id", "begin", F.posexplode(F.split("text", CLOSE, -1)).alias("n", "piece"))
    body = F.expr(f"substring(piece, {len(OPEN) + 1})")
    cut = F.expr("instr(body, '\n')")
    return (
        pieces.filter("piece <> ''").withColumn("body", body).withColumn("cut", cut)  # what follows a chunk's last mark is empty
        .select("conv_id", F.lit(0).alias("kind"), "begin", "n",
                unescape(F.expr("substring(body, 1, cut - 1)"), line=True).alias("role"), unescape(F.expr("substring(body, cut + 1)")).alias("text"),
                (F.length("piece") + len(CLOSE)).cast("bigint").alias("chars"))
    )


def read_back(output: DataFrame) -> DataFrame:
    """Per conversation, parsed from the output: counts and digests of its turns and of all text under the examples' loss spans."""
    none = F.lit(None).cast("string")
    loss = output.filter("loss_start is not null").select(
        "conv_id", F.lit(1).alias("kind"), F.col("position").alias("begin"), F.lit(0).alias("n"), none.alias("role"),
        unescape(F.expr("substring(text, cast(loss_start - begin + 1 as int), cast(loss_end - loss_start as int))")).alias("text"),
        F.lit(0).cast("bigint").alias("chars"))
    sizes = output.filter("is_target").groupBy("conv_id").agg(F.sum(F.length("text")).cast("bigint").alias("chars")).select(
        "conv_id", F.lit(2).alias("kind"), F.lit(0).cast("bigint").alias("begin"), F.lit(0).alias("n"), none.alias("role"), none.alias("text"), "chars")
    rows = _parsed(output).unionByName(loss).unionByName(sizes)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "begin", "n")
    ddl = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
           "n_examples bigint, example_chars bigint")
    names = [x.split()[0] for x in ddl.split(", ")]

    def run(batches):
        state = None
        done: list[tuple] = []

        def finish():
            conv, n, turns, loss_n, loss, chars, examples, total = state
            done.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars, examples, total))

        def flush():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names)
            done.clear()
            return out

        for b in batches:
            for conv, kind, role, text, chars in zip(*(b.column(k).to_pylist() for k in ("conv_id", "kind", "role", "text", "chars"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        finish()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                if kind == 0:
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[5] += chars
                elif kind == 1:
                    state[3] += len(text)
                    state[4].update(text.encode())
                    state[6] += 1
                else:
                    state[7] = chars
            if done:
                yield flush()
        if state is not None:
            finish()
            yield flush()

    return rows.mapInArrow(c.task(run), ddl)


def op8(spark, sf_dir: str) -> DataFrame:
    turns = c.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, TARGET, PROBE)], "conv_id bigint, turn bigint, role string, text string")
    return read_back(c.staged(prefix_targets(turns.unionByName(probe)), "chat"))


_ESC = "replace(replace(replace({x}, chr(92), chr(92) || 'b'), '<', chr(92) || 'l'), '[', chr(92) || 'k')"
ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, '{TARGET}', '{PROBE}'),
f AS (SELECT *, length({_ESC.format(x='text')}) + length(replace({_ESC.format(x='role')}, chr(10), chr(92) || 'n')) + {len(OPEN) + len(CLOSE) + 1} AS chars FROM t),
g AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM f)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{TARGET}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{TARGET}'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) FILTER (role = '{TARGET}') AS n_examples,
  CAST(coalesce(sum(upto) FILTER (role = '{TARGET}'), 0) AS BIGINT) AS example_chars
FROM g GROUP BY conv_id
"""
