"""Benchmark decontamination by winnowed fingerprints.

Both sides are lower-cased (A-Z) and cut into words.  Every run of ``gram``
words is hashed; of each ``window - gram + 1`` consecutive hashes the smallest
is kept (all of them on ties).  Equal spans of ``window`` words hold the same
hashes, so both sides keep the same smallest one: every shared span of that
length shares a fingerprint.  Fingerprints are joined, and each hit is
extended word by word to both sides by at most ``window - gram`` words, which
covers every shared window that holds the fingerprint.  The words themselves
are compared, so a hash collision cannot add a hit.

An item of fewer than ``window`` words is one window of its own length: its
fingerprint is the hash of the whole item (a winnowing window of one).

Only fingerprints that pass a bitmap of the items' fingerprints leave the
map tasks.  The bitmap has at most ``common.MAX_BITS`` bits whatever the items are;
a full one only lets more rows through to the join, which decides.

Defined results: a null or empty text has no words; items without words, or
without an id, are ignored; repeated items count once by id; repeated
documents are judged row by row; an empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c

GRAM = 5
WINDOW = 13
#: A document is contaminated when hit words reach this share (1 in 20).
ONE_IN = 20

CAND = pa.struct([("k", pa.int32()), ("fp", pa.int64()), ("pos", pa.int64()), ("ctx", pa.list_(pa.string()))])
CAND_DDL = "array<struct<k:int,fp:bigint,pos:bigint,ctx:array<string>>>"


def _slide(x: np.ndarray, w: int, best) -> np.ndarray:
    """``best`` over each run of ``w`` values (length ``len(x) - w + 1``)."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Marks the values that are smallest in some run of ``w``."""
    if len(h) < w:
        return np.zeros(len(h), bool)
    low = _slide(h, w, np.minimum)
    pad = np.zeros(w - 1, low.dtype)
    return _slide(np.concatenate([pad, low, pad]), w, np.maximum) == h


def _context(words: c.Words, text_of: np.ndarray, at: np.ndarray, left: int, width: int) -> pa.Array:
    """The ``width`` words from ``at - left`` on, null outside the text."""
    idx = at[:, None] - left + np.arange(width)[None, :]
    t = text_of[at]
    bad = (idx < words.bounds[t][:, None]) | (idx >= words.bounds[t + 1][:, None])
    codes = words.codes[np.clip(idx, 0, len(words.codes) - 1)]
    flat = pa.array(codes.ravel(), mask=bad.ravel())
    return c.lists(words.vocab.take(flat).cast(pa.string()), np.full(len(at), width))


def _fingerprints(words: c.Words, h: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) that winnowing keeps."""
    g = c.gram_hashes(h, gram)
    ok = c.inside(words, gram)
    g = np.where(ok, g, np.uint64(2**64 - 1))
    keep = np.flatnonzero(winnow(g, window - gram + 1) & ok)
    return keep, g[keep]


def _words(col) -> tuple[c.Words, np.ndarray]:
    words = c.split_words(col, c.ALNUM, lower=True)
    return words, c.byte_hashes(words.vocab)[words.codes]


def item_fingerprints(items: DataFrame, gram: int, window: int) -> DataFrame:
    """(k, fp, ctx, item_id) of every item."""

    def run(batches):
        for whole in batches:
            for b in c.slices(whole, "text"):
                words, h = _words(b.column("text"))
                t = words.text_of
                counts = words.counts
                long = counts >= window
                out = []
                at, fp = _fingerprints(words, h, gram, window)
                keep = long[t[at]] if len(at) else np.zeros(0, bool)
                at, fp = at[keep], fp[keep]
                if len(at):
                    span = 2 * window - gram
                    out.append((np.full(len(at), gram), fp, _context(words, t, at, window - gram, span), t[at], True))
                for m in np.unique(counts[(counts > 0) & ~long]):
                    rows = np.flatnonzero(counts == m)
                    at = words.bounds[rows]
                    fp = c.gram_hashes(h, int(m))[at]
                    out.append((np.full(len(at), m), fp, _context(words, t, at, 0, int(m)), rows, False))
                for k, fp, ctx, rows, is_long in out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k, pa.int32()), pa.array(fp.view(np.int64)), ctx, b.column("item_id").take(pa.array(rows)),
                         pa.array(np.full(len(fp), is_long))], ["k", "fp", "ctx", "item_id", "long"])

    return items.select("item_id", "text").filter("item_id is not null").mapInArrow(
        c.task(run), "k int, fp bigint, ctx array<string>, item_id bigint, long boolean")


def contaminated(docs: DataFrame, items: DataFrame, gram: int = GRAM, window: int = WINDOW, one_in: int = ONE_IN,
                 extra: list[str] = ()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): columns ``extra``, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    fps = c.staged(item_fingerprints(items, gram, window), "items")
    bits, log2 = c.bitmap(fps, "fp")
    short = sorted(r[0] for r in fps.filter("not long").select("k").distinct().collect())  # fewer than `window`
    shared = spark.sparkContext.broadcast(bits)  # of bounded size

    def run(batches):
        bits = shared.value

        def known(fp):
            return c.in_bitmap(bits, log2, fp)

        for whole in batches:
            for b in c.slices(whole, "text"):
                words, h = _words(b.column("text"))
                t = words.text_of
                parts = []
                at, fp = _fingerprints(words, h, gram, window)
                keep = known(fp)
                parts.append((gram, at[keep], fp[keep], window - gram, 2 * window - gram))
                for m in short:
                    g = c.gram_hashes(h, m)
                    at = np.flatnonzero(known(g) & c.inside(words, m)) if len(g) else np.zeros(0, np.int64)
                    parts.append((m, at, g[at], 0, m))
                parts = [p for p in parts if len(p[1])]
                counts = np.zeros(b.num_rows, np.int64)
                if parts:
                    at = np.concatenate([p[1] for p in parts])
                    order = np.argsort(t[at], kind="stable")
                    counts = np.bincount(t[at], minlength=b.num_rows)
                    ctx = pa.concat_arrays([_context(words, t, p[1], p[3], p[4]) for p in parts])
                    cand = pa.StructArray.from_arrays(
                        [pa.array(np.concatenate([np.full(len(p[1]), p[0]) for p in parts]), pa.int32()),
                         pa.array(np.concatenate([p[2] for p in parts]).view(np.int64)),
                         pa.array(at - words.bounds[t[at]]), ctx], fields=list(CAND)).take(pa.array(order))
                else:
                    cand = pa.array([], CAND)
                yield pa.RecordBatch.from_arrays(
                    [b.column(x) for x in kept] + [pa.array(words.counts), c.lists(cand, counts)], kept + ["n_words", "cands"])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *extra, "text")
    kept = rows.columns[:-1]
    ddl = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema.fields[:-1])
    found = c.staged(rows.mapInArrow(c.task(run), f"{ddl}, n_words bigint, cands {CAND_DDL}"), "fingerprints")
    shared.unpersist()

    # one row per distinct context: the ids of the items that hold it
    known = fps.groupBy("k", "fp", "long", F.col("ctx").alias("ictx")).agg(F.collect_set("item_id").alias("items"))
    hits = (
        found.select("rid", F.inline("cands")).join(known, ["k", "fp"])
        .withColumn("left", F.when(F.col("long"), window - gram).otherwise(0))
        .filter(F.size("ctx") == F.size("ictx"))
        .withColumn("eq", F.zip_with("ctx", "ictx", lambda a, b: F.coalesce(a == b, F.lit(False))))
        .filter(F.expr("forall(slice(eq, left + 1, k), x -> x)"))
        .withColumn("l", F.expr("coalesce(nullif(array_position(reverse(slice(eq, 1, left)), false), 0) - 1, left)"))
        .withColumn("r", F.expr("coalesce(nullif(array_position(slice(eq, left + k + 1, left), false), 0) - 1, left)"))
        .filter(F.expr("not long or l + k + r >= %d" % window))
        .select("rid", F.struct((F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("k") + F.col("r")).alias("z")).alias("span"), "items")
    )
    by_doc = hits.groupBy("rid").agg(
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string"))).alias("ids"))
    covered = F.expr(
        "aggregate(spans, struct(0L as n, 0L as upto), (s, x) -> struct("
        "s.n + greatest(0L, x.z - greatest(x.a, s.upto)) as n, greatest(s.upto, x.z) as upto), s -> s.n)")
    by_doc = by_doc.select("rid", covered.alias("n_hit"), F.size("ids").cast("bigint").alias("n_items"), F.concat_ws(",", "ids").alias("ids"))
    return (
        found.select(*kept, "n_words").join(by_doc, "rid", "left")
        .select("doc_id", *extra, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
                F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
    )


def op1(spark, sf_dir: str) -> DataFrame:
    return contaminated(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(t='text')} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format(t='text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS p FROM i WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM iw),
dw AS (
  SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, ms WHERE len(w) >= m)),
hit AS (SELECT doc_id, p, m, item_id FROM dw JOIN iw USING (m, g)),
pos AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
