"""Self-join of documents by the Jaccard similarity of their shingle sets, with
an R-tree over count vectors, and the components of its links.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (of
its whole word sequence if shorter).  The join finds every pair of different
sets with similarity of at least ``num / den`` that matters for components:

1. *Shared counts.*  A partner shares at least ``num / den`` of a document's
   shingles, so documents of which fewer shingles occur in any other document
   are done.  Map tasks send each hash once per slice to a bucket of the hash
   space (32 bits within its bucket: a false match only keeps a document).
2. *Classes.*  Documents with equal sets are one class; only class
   representatives go on.
3. *Blocks.*  Shingles are ordered by frequency among representatives; two
   linked sets share one of their rarest ``n - ceil(n num / den) + 1`` (prefix
   filter).  Each such shingle is a block of representatives.
4. *Stars.*  Every representative is verified against the least one it shares
   a block with: a near-copy family, however large, becomes one component
   with one comparison a member.
5. *R-tree.*  Only blocks with two or more components remain.  In each, a
   set's shingles are hashed into ``GROUPS`` groups and the group counts are a
   point; points are bulk-loaded into an R-tree.  The overlap of two sets is
   at most the sum over coordinates of the smaller count; of two nodes, of
   the smaller upper corner.  Node pairs and then point pairs below the
   needed overlap, or of one component, are dropped.  Of what the other pairs join a
   block returns stars, less than one row a set, and the components of these
   candidates are *families*: every pair that may be linked lies in one.
6. *Verification.*  The sets of a family meet in one task, where the same tree
   gives the pairs again and bit rows verify them; what a link has joined is not
   tested again, and stars of what the links join are returned.  Components follow
   from all links (alternating stars).

Blocks and families of more than ``TILE`` sets or ``TILE_BYTES`` are
split into tiles, and each pair of tiles is a task's group, so no group grows
with the data and no pair is lost.

Defined results: a document without words, or a null text, has the empty set
and is linked with nothing; repeated rows are one class; a component's id is
its least non-null doc_id (null if it has none).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm.components import components

SHINGLE = 5
NUM, DEN = 75, 100
GROUPS = 256
TILE = 1024
FANOUT = 16
#: Pairs of nodes or points tested at once.
CHUNK = 10_000
#: Bytes of the sets of a family's tile (two tiles meet in a task), and of bit rows compared at once.
TILE_BYTES, BIT_BYTES = 2 << 20, 4 << 20
#: Scan bytes whose shingles make about one bucket.
BUCKET_BYTES = 4 << 20

_U = np.uint64


def shingle_sets(col, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of the distinct shingles of each text, in text order."""
    words = c.split_words(col, c.NOT_SPACE, lower=True)
    h = c.byte_hashes(words.vocab)[words.codes]
    at = np.flatnonzero(c.inside(words, k))
    hashes, text = c.gram_hashes(h, k)[at], words.text_of[at]
    counts = words.counts
    short = (counts > 0) & (counts < k)
    if short.any():
        parts, rows = [hashes], [text]
        for m in range(1, k):
            r = np.flatnonzero(counts == m)
            if len(r):
                parts.append(c.mix(c.gram_hashes(h, m)[words.bounds[r]] + _U(m)))
                rows.append(r)
        hashes, text = np.concatenate(parts), np.concatenate(rows)
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    first = ~pd.Series(c.mix(hashes ^ c.mix(text.astype(_U) + _U(1)))).duplicated().to_numpy()
    return hashes[first], text[first]


def _sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Wrapping sums of consecutive runs of ``x``."""
    cum = np.zeros(len(x) + 1, _U)
    np.cumsum(x, out=cum[1:])
    ends = np.cumsum(counts)
    return cum[ends] - cum[ends - counts]


def _blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as binary values."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * values.itemsize, out=off[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))])


SENT = ("bucket int, sid bigint, key bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, shared bigint, "
        "runs binary, lengths binary, once binary, more binary")


def send_hashes(docs: DataFrame, log_buckets: int, k: int) -> DataFrame:
    """Rows of two kinds: each document (key, n, digest, shingles known to be
    shared inside its slice); for each slice ``sid`` and bucket, the hashes seen
    in one document (``once``, with ``runs`` of documents) and in ``more``."""
    names = [f.split()[0] for f in SENT.split(", ")]
    n_buckets = 1 << log_buckets

    def run(batches):
        from pyspark import TaskContext

        sid = TaskContext.get().partitionId() << 32
        for whole in batches:
            for b in c.slices(whole, "text"):
                sid += 1
                keys = b.column("key").to_numpy()
                h, text = shingle_sets(b.column("text"), k)
                counts = np.bincount(text, minlength=b.num_rows)
                again = pd.Series(h).duplicated(keep=False).to_numpy()
                nulls = pa.nulls(b.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([
                    pa.array((keys & (n_buckets - 1)).astype(np.int32)), pa.array(np.full(b.num_rows, sid)), pa.array(keys), b.column("doc_id"), pa.array(counts),
                    pa.array(_sums(c.mix(h), counts).view(np.int64)), pa.array(_sums(c.mix(h ^ _U(0x5851F42D4C957F2D)), counts).view(np.int64)),
                    pa.array(np.bincount(text[again], minlength=b.num_rows)), nulls, nulls, nulls, nulls], names)
                if not len(h):
                    continue
                bucket = (h >> _U(64 - log_buckets)).astype(np.int64) if log_buckets else np.zeros(len(h), np.int64)
                value = (h >> _U(32 - log_buckets)).astype(np.uint32)
                one = np.flatnonzero(~again)
                one = one[np.argsort(bucket[one].astype(np.uint16 if log_buckets <= 16 else np.int64), kind="stable")]
                multi = np.flatnonzero(again)
                multi = multi[~pd.Series(h[multi]).duplicated().to_numpy()]
                multi = multi[np.argsort(bucket[multi], kind="stable")]
                ob, ot = bucket[one], text[one]
                new = np.flatnonzero(np.r_[True, (ob[1:] != ob[:-1]) | (ot[1:] != ot[:-1])]) if len(one) else one
                lengths = np.diff(np.r_[new, len(one)])
                per = [np.bincount(x, minlength=n_buckets) for x in (ob[new], ob, bucket[multi])]
                used = np.flatnonzero(per[1] + per[2])
                zero = pa.nulls(len(used), pa.int64())
                cols = [_blobs(keys[ot[new]], per[0]), _blobs(lengths.astype(np.int32), per[0]), _blobs(value[one], per[1]), _blobs(value[multi], per[2])]
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(np.full(len(used), sid))] + [zero] * 6 + [x.take(pa.array(used)) for x in cols], names)

    return docs.select("doc_id", "text", _key()).mapInArrow(c.task(run), SENT)


def _key():
    return F.xxhash64("doc_id", "text").alias("key")


COUNTED = "sid bigint, key bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, shared bigint, runs binary, counts binary"


def count_shared(table: pa.Table) -> pa.Table:
    """Of one bucket: the document rows; for each slice, the documents with hashes
    in the bucket that some other document has, and how many."""
    is_doc = pc.is_valid(table.column("key"))
    docs = table.filter(is_doc).select(["sid", "key", "doc_id", "n", "d1", "d2", "shared"])
    none = pa.nulls(docs.num_rows, pa.binary())
    out = [docs.append_column("runs", none).append_column("counts", none)]
    rest = table.filter(pc.invert(is_doc))
    if rest.num_rows:
        raw = {k: c.text_bytes(rest.column(k)) for k in ("runs", "lengths", "once", "more")}
        once, more = (np.frombuffer(raw[k][0].tobytes(), np.uint32) for k in ("once", "more"))
        again = pd.Series(np.concatenate([once, more])).duplicated(keep=False).to_numpy()[: len(once)]
        lengths = np.frombuffer(raw["lengths"][0].tobytes(), np.int32)
        got = c.per_text(again, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
        hot = np.flatnonzero(got)
        per = np.bincount(np.searchsorted(raw["runs"][1], hot * 8, "right") - 1, minlength=rest.num_rows)
        zero = pa.nulls(rest.num_rows, pa.int64())
        out.append(pa.table(
            [rest.column("sid")] + [zero] * 6 + [_blobs(np.frombuffer(raw["runs"][0].tobytes(), np.int64)[hot], per), _blobs(got[hot].astype(np.int32), per)],
            [f.split()[0] for f in COUNTED.split(", ")]))
    return pa.concat_tables(out)


def add_shared(table: pa.Table) -> pa.Table:
    """Of one slice: its document rows with the counts of all buckets added."""
    is_doc = pc.is_valid(table.column("key"))
    docs, rest = table.filter(is_doc), table.filter(pc.invert(is_doc))
    keys = docs.column("key").to_numpy()
    names, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(names), np.int64)
    runs = np.frombuffer(c.text_bytes(rest.column("runs"))[0].tobytes(), np.int64)
    counts = np.frombuffer(c.text_bytes(rest.column("counts"))[0].tobytes(), np.int32)
    np.add.at(total, np.searchsorted(names, runs), counts)
    shared = pa.array(docs.column("shared").to_numpy() + total[at])
    return docs.select(["key", "doc_id", "n", "d1", "d2"]).append_column("shared", shared)


def needed(a, b, num: int = NUM, den: int = DEN):
    """Least overlap of two sets of sizes ``a`` and ``b`` that are linked."""
    return -(-(num * (a + b)) // (num + den))


def _levels(vec: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list]:
    """(order of the points, levels of (upper corner, least size, most size)), leaves first."""
    order = np.lexsort((vec[:, 1 % vec.shape[1]], vec[:, 0], size))
    up, lo, hi = vec[order], size[order], size[order]
    levels = [(up, lo, hi)]
    while len(up) > FANOUT:
        at = np.arange(0, len(up), FANOUT)
        up, lo, hi = np.maximum.reduceat(up, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
        levels.append((up, lo, hi))
    return order, levels


def tree_pairs(vec: np.ndarray, size: np.ndarray, group: np.ndarray, side: np.ndarray | None = None, num: int = NUM, den: int = DEN):
    """Chunks of index pairs, and by how much their bound exceeds the needed overlap, whose
    ``group`` differs (and, if given, whose ``side`` differs).  Bound: sum of the smaller coordinates."""
    order, levels = _levels(vec.astype(np.int32), size)
    group = group[order]
    side = None if side is None else side[order]

    def passing(level, i, j):
        up, lo, hi = levels[level]
        keep = den * hi[i] >= num * lo[j]
        keep &= den * hi[j] >= num * lo[i]
        i, j = i[keep], j[keep]
        slack = np.minimum(up[i], up[j]).sum(1) - needed(lo[i], lo[j], num, den)
        keep = slack >= 0
        return i[keep], j[keep], slack[keep]

    top = len(levels) - 1
    i, j = np.triu_indices(len(levels[top][0]))
    work = [(top, i, j)]
    while work:  # depth first, in bounded chunks
        level, i, j = work.pop()
        if len(i) > CHUNK:
            work += [(level, i[s:s + CHUNK], j[s:s + CHUNK]) for s in range(0, len(i), CHUNK)]
            continue
        if level == 0:
            keep = (i < j) & (group[i] != group[j])
            if side is not None:
                keep &= side[i] != side[j]
            i, j, slack = passing(0, i[keep], j[keep])
            if len(i):
                yield order[i], order[j], slack
            continue
        i, j, _ = passing(level, i, j)
        n = len(levels[level - 1][0])
        grid = np.arange(FANOUT)
        for s in range(0, len(i), 64):
            a = (i[s:s + 64, None, None] * FANOUT + grid[None, :, None]) + 0 * grid[None, None, :]
            z = (j[s:s + 64, None, None] * FANOUT + grid[None, None, :]) + 0 * grid[None, :, None]
            a, z = a.ravel(), z.ravel()
            ok = (a < n) & (z < n) & (a <= z)
            work.append((level - 1, a[ok], z[ok]))


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs (u, v), those whose sets reach the similarity."""
    one = sets.select(F.col("key").alias("u"), F.col("hashes").alias("hu"))
    two = sets.select(F.col("key").alias("v"), F.col("hashes").alias("hv"))
    both = F.size(F.array_intersect("hu", "hv")).cast("long")
    return (pairs.join(one, "u").join(two, "v").withColumn("both", both)
            .filter(den * F.col("both") >= num * (F.size("hu") + F.size("hv") - F.col("both"))).select("u", "v"))


class Joined:
    """Which points are joined; points of one of ``groups`` are from the start."""

    def __init__(self, n: int, groups: np.ndarray):
        _, first, place = np.unique(groups, return_index=True, return_inverse=True)
        self.start = self.root = first[place] if n else np.zeros(0, np.int64)

    def apart(self, i, j):
        return self.root[i] != self.root[j]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join the points of each index pair."""
        parent: dict[int, int] = {}

        def find(x):
            while x in parent:
                x = parent[x]
            return x

        for x, y in zip(self.root[i].tolist(), self.root[j].tolist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if parent:
            old = np.array(sorted(parent))
            new = np.array([find(x) for x in old.tolist()])
            at = np.minimum(np.searchsorted(old, self.root), len(old) - 1)
            self.root = np.where(old[at] == self.root, new[at], self.root)

    def stars(self, key: np.ndarray) -> pa.Table:
        """(u, v): of each set of joined points that grew, every key with the least one."""
        order = np.lexsort((key, self.root))
        root = self.root[order]
        first = np.r_[True, root[1:] != root[:-1]] if len(root) else np.zeros(0, bool)
        least = np.repeat(key[order][first], np.diff(np.r_[np.flatnonzero(first), len(root)]))
        moved = np.bincount(self.root[self.start != self.root], minlength=len(root)) > 0
        keep = moved[root] & ~first
        return pa.table({"u": pa.array(key[order][keep]), "v": pa.array(least[keep])})


def _tiled(rows: DataFrame, tiles: DataFrame, by: str, *cols: str) -> DataFrame:
    """Each row in every pair (i, j) of tiles of its group that holds its own tile."""
    own = F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
    return (
        rows.join(tiles, by).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(by, "key", *cols, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )


def _side(table: pa.Table) -> np.ndarray | None:
    """The tile of each row where the group is of two different tiles."""
    return table.column("own").to_numpy() if table.column("i")[0].as_py() != table.column("j")[0].as_py() else None


def candidates(prefix: DataFrame, part: DataFrame, vectors: DataFrame, num: int, den: int, tile: int) -> DataFrame:
    """By block, what the pairs of different components that pass the R-tree's bound join: each
    set (u) with the least one (v) that it is joined with, so less than one row a set and tile."""
    placed = prefix.join(part.withColumnRenamed("node", "key"), "key", "left").withColumn("part", F.coalesce("component", "key")).drop("component")
    placed = c.staged(placed, "placed")
    blocks = (
        placed.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("m"),
                                F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("sign"))
        .filter("lo <> hi").groupBy("m", "sign").agg(F.min("h").alias("h"))  # blocks of the same sets once
        .select("h", F.ceil(F.col("m") / tile).cast("int").alias("tiles"))
    )
    blocks = c.staged(blocks, "blocks")  # a table of its own, so that the join with a hot block is split

    def search(table: pa.Table) -> pa.Table:
        vec = np.frombuffer(c.text_bytes(table.column("vec"))[0].tobytes(), np.uint32).reshape(-1, GROUPS)
        joined = Joined(len(vec), np.arange(len(vec)))
        for i, j, _ in tree_pairs(vec, table.column("n").to_numpy().astype(np.int64), table.column("part").to_numpy(), _side(table), num, den):
            new = joined.apart(i, j)
            joined.add(i[new], j[new])
        return joined.stars(table.column("key").to_numpy())

    return (
        _tiled(placed, blocks, "h", "n", "part").join(vectors, "key").groupBy("h", "i", "j")
        .applyInArrow(search, "u bigint, v bigint").distinct()
    )


def bit_rows(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each set as bits over the hashes that occur in two sets or more (64 a word)."""
    codes, _ = pd.factorize(hashes)
    often = np.bincount(codes) > 1 if len(codes) else np.zeros(0, bool)
    column = np.cumsum(often) - 1
    keep = often[codes]
    row, col = np.repeat(np.arange(len(sizes)), sizes)[keep], column[codes[keep]]
    words = max(1, -(-int(often.sum()) // 64))
    out = np.zeros(len(sizes) * words, _U)
    np.bitwise_or.at(out, row * words + (col >> 6), _U(1) << (col & 63).astype(_U))
    return out.reshape(-1, words)


def verified(families: DataFrame, part: DataFrame, sets: DataFrame, num: int, den: int, tile: int, tile_bytes: int) -> DataFrame:
    """By tile of a family, what its links join: each set (u) with the least one (v).

    Every candidate pair lies in one family (a component of the candidates), so a set
    travels once for each pair of tiles that holds it, and once in all where the family
    fits one tile of ``tile_bytes``."""
    member = families.select(F.col("node").alias("key"), F.col("component").alias("family"))
    member = member.join(part.withColumnRenamed("node", "key"), "key", "left").withColumn("part", F.coalesce("component", "key")).drop("component")
    member = c.staged(member.join(sets.select("key", F.size("hashes").alias("n")), "key"), "family")
    tiles = member.groupBy("family").agg(F.greatest(F.sum("n") * 8 / tile_bytes, F.count("*") / tile).alias("t")).select(
        "family", F.ceil("t").cast("int").alias("tiles"))
    tiles = c.staged(tiles, "family-tiles")

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = table.column("hashes")
        h, size = pc.list_flatten(col).to_numpy().view(_U), pc.list_value_length(col).to_numpy().astype(np.int64)
        part_of = table.column("part").to_numpy()
        bits = bit_rows(h, size)
        joined = Joined(len(size), part_of)
        step = max(1, BIT_BYTES // (8 * bits.shape[1]))
        for i, j, _ in tree_pairs(_counts(h, size), size, part_of, _side(table), num, den):
            for s in range(0, len(i), step):
                a, z = i[s:s + step], j[s:s + step]
                new = joined.apart(a, z)
                a, z = a[new], z[new]
                both = np.bitwise_count(bits[a] & bits[z]).sum(1, dtype=np.int64)
                ok = den * both >= num * (size[a] + size[z] - both)
                joined.add(a[ok], z[ok])
        return joined.stars(table.column("key").to_numpy())

    return (
        _tiled(member, tiles, "family", "part").join(sets, "key").groupBy("family", "i", "j")
        .applyInArrow(search, "u bigint, v bigint").distinct()
    )


def link(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN, tile: int = TILE,
         tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, key (of id and text), n_shingles, component
    (a key), component_id (its least doc_id)."""
    spark = docs.sparkSession
    scan = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    want = docs.rdd.getNumPartitions() * max(1.0, scan / BUCKET_BYTES)
    log_buckets = min(28, max(3, int(np.ceil(np.log2(want)))))
    rows = c.staged(
        send_hashes(docs, log_buckets, k).groupBy("bucket").applyInArrow(count_shared, COUNTED)
        .groupBy("sid").applyInArrow(add_shared, "key bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, shared bigint"), "shared")

    # classes of equal sets among documents that may have a partner
    may = rows.filter((F.col("n") > 0) & (den * F.col("shared") >= num * F.col("n")))
    classes = c.staged(
        may.groupBy("d1", "d2", "n").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("rep"), F.min("doc_id").alias("least_id"))
        .select("d1", "d2", "n", F.col("rep.key").alias("rep"), F.col("rep.doc_id").alias("rep_id"), "least_id"), "classes")

    wanted = classes.select(F.col("rep").alias("key"), F.col("rep_id"))
    bits, log2 = c.bitmap(wanted, "key")
    shared = spark.sparkContext.broadcast(bits)  # of bounded size; keeps most other texts from the shuffle

    def maybe(batches):
        for b in batches:
            yield b.filter(pa.array(c.in_bitmap(shared.value, log2, b.column("key").to_numpy().view(_U))))

    def sets_of(batches):
        for whole in batches:
            for b in c.slices(whole, "text"):
                h, text = shingle_sets(b.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), c.lists(pa.array(h.view(np.int64)), np.bincount(text, minlength=b.num_rows))], ["key", "hashes"])

    texts = docs.select("doc_id", "text", _key()).mapInArrow(c.task(maybe), "doc_id bigint, text string, key bigint")
    sets = c.staged(
        texts.join(wanted, (texts.key == wanted.key) & texts.doc_id.eqNullSafe(wanted.rep_id)).select(texts.key, "text")
        .mapInArrow(c.task(sets_of), "key bigint, hashes array<bigint>").dropDuplicates(["key"]), "sets")

    # prefixes: the rarest shingles of each set, by frequency among the representatives
    flat = sets.select("key", F.explode("hashes").alias("h"))
    often = flat.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    n = F.col("n")
    prefix = (
        flat.join(often, "h").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("common"))
        .join(sets.select("key", F.size("hashes").alias("n")), "key")
        .withColumn("least", F.ceil(n * num / den))  # least overlap with any partner
        .filter(F.size("common") >= F.col("least"))
        .select("key", n, F.explode(F.slice("common", F.lit(1), (F.size("common") - F.col("least") + 1).cast("int"))).alias("x"))
        .select("key", "n", F.col("x.h").alias("h"))
    )
    prefix = c.staged(prefix, "prefix")

    # stars: each set against the least one that it shares a block with
    star = c.staged(prefix.groupBy("h").agg(F.min("key").alias("v"), F.count("*").alias("m")).filter("m > 1").select("h", "v"), "least")
    stars = prefix.join(star, "h").groupBy(F.col("key").alias("u")).agg(F.min("v").alias("v")).filter("u <> v")
    stars = c.staged(stars, "first")
    links = c.staged(_verify(stars, sets, num, den), "stars")
    part = c.staged(components(links), "parts")

    c.tidy(spark)  # each round of components leaves plans and broadcasts behind

    # blocks that still hold different components: families of candidates, verified within
    vectors = c.staged(sets.mapInArrow(c.task(_vectors), "key bigint, vec binary"), "vectors")
    families = components(candidates(prefix, part, vectors, num, den, tile))
    found = verified(families, part, sets, num, den, tile, tile_bytes)
    part = components(c.staged(links.union(found), "all-links"))

    # ids of the components, and back to the rows
    named = (
        classes.join(part.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    named = c.staged(named.select("d1", "d2", "n", "component", "least_id"), "named")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "component").select("d1", "d2", "n", "component", "component_id", F.lit(True).alias("classed"))
    return (
        rows.select("doc_id", "key", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
        .select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component"),
                F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def _counts(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The counts of each set's hashes in ``GROUPS`` groups."""
    text = np.repeat(np.arange(len(size)), size)
    return np.bincount(text * GROUPS + (h % _U(GROUPS)).astype(np.int64), minlength=len(size) * GROUPS).reshape(-1, GROUPS)


def _vectors(batches):
    for b in batches:
        col = b.column("hashes")
        vec = _counts(col.flatten().to_numpy().view(_U), col.value_lengths().to_numpy().astype(np.int64)).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([b.column("key"), _blobs(vec.ravel(), np.full(len(col), GROUPS))], ["key", "vec"])


def op6(spark, sf_dir: str) -> DataFrame:
    return link(c.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
