"""SimHash near duplicates with pivot distance tables.

A document's fingerprint has bit ``b`` set where over half of its 4-word
shingles (repeats included) have bit ``b`` set in their XXH64.  Fingerprints
link at ``DIFFER`` or fewer differing bits; components follow from the links.

1. *Classes.*  Documents with one fingerprint are one class; only distinct
   fingerprints (8 bytes each) go on.
2. *Blocks.*  The 64 bits are cut into ``pieces`` pieces.  Four differing bits
   touch four pieces at most, so two linked fingerprints agree in some choice
   of ``pieces - 4`` pieces; each choice is a block key.  More fingerprints get
   more pieces, so that unrelated ones seldom share a block; the result is the
   same with any number of pieces.
3. *Pivot tables.*  In a block the Hamming distances of every fingerprint to
   ``PIVOTS`` reference fingerprints are computed once.  By the triangle
   inequality two distances to one pivot differ by no more than the
   fingerprints do: the block is sorted by its first pivot, each fingerprint
   looks only as far ahead as that distance allows, and a pair is discarded
   where any other coordinate differs by more than ``DIFFER``.  The pivots are
   Walsh functions: over all 64 of them the squared coordinate differences of
   two fingerprints sum to 64 times their distance, so unlike pairs stand out
   somewhere.  Survivors are verified.  Pairs that the block has joined
   already are skipped, and a block returns a spanning forest of its links.
4. *Tiles.*  A block of more than ``TILE`` fingerprints is dealt to tiles, and
   each pair of tiles is a run of its own, so a task holds at most two tiles of
   one block beside its chunk; no pair is lost.

Runs are streamed in order through tasks, many to a chunk, so a block needs
no group of its own.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; repeated rows are one class; a component's id is its least
non-null doc_id (null if it has none).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm.components import components

SHINGLE = 4
SEED = 42
DIFFER = 4
#: Shingles hashed at once.
HASHED = 1 << 17
#: Expected partners by chance in a block, at most.
BY_CHANCE = 8
TILE = 8192
#: Rows searched at once.
CHUNK = 1 << 18
N_PIVOTS = 32

_U = np.uint64
#: The byte lanes of SPREAD[x] are the bits of x, so 255 of them add up without carries.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view(_U)


def _walsh(k: int) -> int:
    """Bit i is the parity of the bits that i and k share."""
    return sum((bin(i & k).count("1") & 1) << i for i in range(64))


#: Reference fingerprints; odd steps through the 64 Walsh functions mix slow and fast ones.
PIVOTS = np.array([_walsh(k * 37 % 64) for k in range(1, N_PIVOTS + 1)], _U)


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with one space between words, starts and ends of words in them, first word of each text)."""
    w = c.NOT_SPACE[data]
    n = len(data)
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    at = off[:-1][off[:-1] < n]
    first[at] = w[at]
    at = off[1:][off[1:] > 0] - 1
    last[at] = w[at]
    kept = w.copy()
    kept[1:] |= w[:-1]  # the byte after a word is its space
    place = np.cumsum(kept) - 1
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return np.where(w, data, 32).astype(np.uint8)[kept], place[starts], place[ends] + 1, np.searchsorted(starts, off)


def _bit_counts(h: np.ndarray, text: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out[text, bit]`` the number of hashes with the bit set; ``text`` ascends."""
    new = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    cuts = np.unique(np.r_[new, np.arange(0, len(h), 255)])
    rows = text[cuts]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    low = h.view(np.uint8).reshape(-1, 8)
    for b in range(8):
        lanes = np.add.reduceat(SPREAD[low[:, b]], cuts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[rows[starts], 8 * b: 8 * b + 8] += np.add.reduceat(lanes, starts, axis=0)


def fingerprints(col, k: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text of an Arrow string column."""
    data, off = c.text_bytes(col)
    m = len(off) - 1
    counts = np.zeros((m, 64), np.int64)
    if not len(data):
        return np.zeros(m, _U)
    flat, starts, ends, bounds = spans(c.LOWER[data], off)
    n_words = np.diff(bounds)
    n_grams = np.where(n_words > 0, np.maximum(n_words - k + 1, 1), 0)
    text = np.repeat(np.arange(m), n_grams)
    at = np.arange(len(text)) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams) + bounds[text]
    a, z = starts[at], ends[at + np.minimum(n_words[text], k) - 1]
    raw, digest = flat.tobytes(), xxhash.xxh64_intdigest
    for s in range(0, len(a), HASHED):
        h = np.array([digest(raw[i:j], SEED) for i, j in zip(a[s:s + HASHED].tolist(), z[s:s + HASHED].tolist())], _U)
        _bit_counts(h, text[s:s + HASHED], counts)
    bits = (2 * counts > n_grams[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view(_U)


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a bigint) of every row."""
    def run(batches):
        for whole in batches:
            for b in c.slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fingerprints(b.column("text")).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(c.task(run), f"doc_id {kind}, fp bigint")


def masks(pieces: int) -> list[int]:
    """Bits of every choice of ``pieces - DIFFER`` of the pieces."""
    edge = [64 * i // pieces for i in range(pieces + 1)]
    part = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(pieces)]
    return [sum(x) for x in combinations(part, pieces - DIFFER)]


def pieces_for(n: int) -> int:
    """The least number of pieces (6 or more) with few partners by chance in the widest block."""
    for pieces in range(DIFFER + 2, 10):
        if n <= BY_CHANCE << min(m.bit_count() for m in masks(pieces)):
            return pieces
    return 10


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(run: np.ndarray, fp: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a spanning forest of the links inside each run.

    ``run`` ascends; of a run whose ``side`` is not negative only pairs of
    different sides are looked at."""
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], run))
    table, run, fp, side = table[order], run[order], fp[order], side[order]
    n = len(fp)
    parent = list(range(n))
    root = np.arange(n)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    u, v = [], []
    ahead, lag = np.arange(n), 0
    while True:
        lag += 1
        ahead = ahead[ahead + lag < n]
        ahead = ahead[(run[ahead] == run[ahead + lag]) & (table[ahead + lag, 0] - table[ahead, 0] <= DIFFER)]
        if not len(ahead):
            break
        i = ahead[(root[ahead] != root[ahead + lag]) & ((side[ahead] < 0) | (side[ahead] != side[ahead + lag]))]
        for p in range(1, len(PIVOTS)):
            if not len(i):
                break
            i = i[np.abs(table[i, p] - table[i + lag, p]) <= DIFFER]
        i = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= DIFFER]
        again = 0
        for a in i.tolist():
            x, y = find(a), find(a + lag)
            if x == y:
                again += 1
            else:
                parent[max(x, y)] = min(x, y)
                u.append(a)
                v.append(a + lag)
        if again > 256 or lag & (lag - 1) == 0:  # let the arrays know what is joined
            root = np.array(parent)
            while (root[root] != root).any():
                root = root[root]
    return order[np.array(u, np.int64)], order[np.array(v, np.int64)]


def _search(batches):
    """Rows sorted by (choice, value, i, j) -> links; runs are worked on whole, many to a chunk."""
    names = ["choice", "value", "i", "j", "fp", "own"]

    def links(cols, run):
        side = np.where(cols["i"] == cols["j"], -1, cols["own"])
        fp = cols["fp"].view(_U)
        u, v = forest(run, fp, side)
        return pa.RecordBatch.from_arrays([pa.array(cols["fp"][u]), pa.array(cols["fp"][v])], ["u", "v"])

    kept, size, least = [], 0, CHUNK
    for b in batches:
        kept.append(b)
        size += b.num_rows
        if size < least:
            continue
        cols, run = _runs(kept, names)
        cut = int(np.searchsorted(run, run[-1]))  # the last run may go on
        if cut:
            yield links({k: x[:cut] for k, x in cols.items()}, run[:cut])
        kept = [pa.RecordBatch.from_arrays([pa.array(cols[k][cut:]) for k in names], names)]
        size = size - cut
        least = CHUNK + size
    if size:
        yield links(*_runs(kept, names))


def _runs(batches: list, names: list[str]) -> tuple[dict, np.ndarray]:
    cols = {k: np.concatenate([b.column(k).to_numpy() for b in batches]) for k in names}
    new = np.zeros(len(cols["fp"]), np.int64)
    for k in names[:4]:
        new[1:] |= cols[k][1:] != cols[k][:-1]
    return cols, np.cumsum(new)


def links(classes: DataFrame, pieces: int, tile: int = TILE) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``fp`` that join what all links join."""
    fp = F.col("fp")
    keys = classes.select("fp", F.inline(F.array(*[
        F.struct(F.lit(i).cast("int").alias("choice"), fp.bitwiseAND(F.lit(_signed(m))).alias("value")) for i, m in enumerate(masks(pieces))])))
    sizes = keys.groupBy("choice", "value").agg(F.count("*").alias("m")).filter("m > 1").select(
        "choice", "value", F.ceil(F.col("m") / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = (
        keys.join(sizes, ["choice", "value"]).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("choice", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "own")
    )
    runs = ["choice", "value", "i", "j"]
    return dealt.repartition(*runs).sortWithinPartitions(*runs).mapInArrow(c.task(_search), "u bigint, v bigint")


def near(docs: DataFrame, pieces: int | None = None, tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component (a fingerprint), component_id."""
    rows = c.staged(prints(docs), "prints")
    classes = c.staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints-distinct")
    found = c.staged(links(classes, pieces or pieces_for(classes.count()), tile), "prints-links")
    part = components(found)
    named = classes.join(part.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = c.staged(named, "prints-named")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return rows.join(named.join(ids, "component").select("fp", "component", "component_id"), "fp").select("doc_id", "fp", "component", "component_id")


def op13(spark, sf_dir: str) -> DataFrame:
    return near(c.read(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
