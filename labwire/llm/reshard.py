"""Resharding by minimum-cost flow.

From the bytes of the old shards and the capacities of the new ones (equal, to
a byte), a flow network is solved: source -> old shard (its bytes), old shard
-> new shard (cost 0 for staying, 1 a byte for moving), new shard -> sink (its
capacity).  Successive shortest paths give the transfers ``f[i][j]`` that move
the fewest bytes.  The network has one node a shard, so it is solved on the
driver; it holds no documents.

Documents follow the flows in blocks.  A block is a size class and a hash
bucket of one shard; block sums are aggregated before they are gathered (at
most shards x classes x buckets rows).  Within a shard, blocks are ordered
from small to large documents; the outgoing transfers take runs from the
front, the rest stays.  Only blocks that a run's end cuts through are ordered
document by document, so no window holds a whole shard.  A document goes
where its middle byte falls; the small errors left at the cuts are repaired
by solving the same problem again from the shards so reached (``ROUNDS``),
which moves a few of the smallest documents.

Affected shards (those that lose or gain documents) are rewritten; the others
stay where they are.

Rows of equal id and text are numbered, and each copy is placed on its own: a
hash of its number deals the copies over the blocks, so a cut may fall between
them and a row that is a third of the table fills several shards.  To write
them, copies are counted by the part of the table they were read from, and
numbered inside their part, so no task holds all copies.

Defined results: a null text has size 1; of equal rows with several sources
all count as of the least old shard; a null source is the shard of the empty
one; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labwire.llm import common as c

OLD, NEW = 12, 16
BUCKETS = 16
SLOT_BLOCKS = 256
ROUNDS = 4
ROW = ["doc_id", "key", "copy", "size", "copies", "old"]


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[list[int]]:
    """Transfers ``f[i][j]`` of all supply at least total cost, by successive shortest
    paths (Bellman-Ford) on the residual network."""
    n, m = len(supply), len(capacity)
    s, t = n + m, n + m + 1
    edges: list[list] = []  # to, left, cost
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(a, b, cap, w):
        out[a].append(len(edges))
        edges.append([b, cap, w])
        out[b].append(len(edges))
        edges.append([a, 0, -w])

    for i, x in enumerate(supply):
        add(s, i, x, 0)
    first = len(edges)
    for i in range(n):
        for j in range(m):
            add(i, n + j, supply[i], cost(i, j))
    for j, x in enumerate(capacity):
        add(n + j, t, x, 0)
    while True:
        dist, via = [math.inf] * len(out), [-1] * len(out)
        dist[s] = 0
        queue, waiting = [s], {s}
        while queue:
            a = queue.pop(0)
            waiting.discard(a)
            for e in out[a]:
                b, left, w = edges[e]
                if left > 0 and dist[a] + w < dist[b]:
                    dist[b], via[b] = dist[a] + w, e
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        if dist[t] == math.inf:
            break
        path, at = [], t
        while at != s:
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        push = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= push
            edges[e ^ 1][1] += push
    return [[edges[first + 2 * (i * m + j) + 1][1] for j in range(m)] for i in range(n)]


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _transfer(rows: DataFrame, shards: int, name: str) -> DataFrame:
    """``rows`` (doc_id, key, copy, size, copies, old, at) with ``at`` moved by the flows from the sums of ``at``."""
    spark = rows.sparkSession
    rows = rows.withColumn("class", F.floor(4 * F.log2(F.col("size").cast("double"))).cast("int")).withColumn(
        "bucket", F.pmod(F.xxhash64("key", "copy"), F.lit(BUCKETS)).cast("int"))
    blocks = rows.groupBy("at", "class", "bucket").agg(F.sum("size").alias("bytes")).collect()  # a bounded number of blocks
    supply = [0] * (max([r["at"] for r in blocks], default=0) + 1)
    for r in blocks:
        supply[r["at"]] += int(r["bytes"])
    flow = min_cost_flow(supply, capacities(sum(supply), shards), lambda i, j: 0 if i == j else 1)
    plan = []  # (at, class, bucket, first byte of the block, target, first and last byte of the target's run)
    for i in range(len(supply)):
        runs, begin = [], 0
        for j in [j for j in range(shards) if j != i] + ([i] if i < shards else []):
            if flow[i][j]:
                runs.append((j, begin, begin + flow[i][j]))
                begin += flow[i][j]
        at = 0
        for r in sorted((b for b in blocks if b["at"] == i), key=lambda b: (b["class"], b["bucket"])):
            n = int(r["bytes"])
            for j, a, z in runs:
                if a < at + n and z > at:
                    plan.append((i, r["class"], r["bucket"], at, j, a, z, a <= at and z >= at + n))
            at += n
    table = spark.createDataFrame(plan, "at int, class int, bucket int, start bigint, target int, a bigint, z bigint, whole boolean")
    block = ["at", "class", "bucket"]
    whole = rows.join(table.filter("whole"), block).select(*ROW, F.col("target").alias("at"))
    cut = table.filter("not whole")
    upto = F.sum("size").over(Window.partitionBy(*block).orderBy("key", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("start") + F.col("upto") - F.col("size") / 2
    part = (
        rows.join(cut.select(*block).distinct(), block, "left_semi").withColumn("upto", upto)
        .join(cut, block).filter((middle >= F.col("a")) & (middle < F.col("z")))
        .select(*ROW, F.col("target").alias("at"))
    )
    return c.staged(whole.union(part), name)


def assign(docs: DataFrame, old, shards: int = NEW, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, key, copy (from 0, of ``copies`` rows of equal doc_id and key), size, old, shard, slot."""
    rows = (
        docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
                    old.cast("int").alias("old"))
        .groupBy("doc_id", "key").agg(F.first("size").alias("size"), F.count("*").alias("copies"), F.min("old").alias("old"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
        .select(*ROW, F.col("old").alias("at"))
    )
    rows = c.staged(rows, "sizes")
    for i in range(rounds):
        rows = _transfer(rows, shards, f"round{i}")
    # slots: counts of blocks of each shard, then a number inside the block
    rows = rows.withColumnRenamed("at", "shard").withColumn("slot_block", F.pmod(F.xxhash64("key", "doc_id", "copy"), F.lit(SLOT_BLOCKS)).cast("int"))
    counts = rows.groupBy("shard", "slot_block").agg(F.count("*").alias("n"))  # shards x SLOT_BLOCKS rows
    before = Window.partitionBy("shard").orderBy("slot_block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "slot_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "slot_block").orderBy("key", "doc_id", "copy"))
    return rows.join(first, ["shard", "slot_block"]).select(*ROW, "shard", (F.col("first") + inside - 1).alias("slot"))


def _numbered(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose (doc_id, __key) is in ``repeated``, with ``__copy`` numbered from 0 in each."""
    at = F.monotonically_increasing_id()  # the part of the scan in the upper bits, taken before any shuffle
    rows = keyed.withColumn("__at", at)
    rows = c.staged(rows.join(repeated, (F.col("__key") == F.col("__k")) & rows.doc_id.eqNullSafe(F.col("__id")), "left_semi"), "repeats")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    sums = rows.groupBy(F.col("__key").alias("__k"), F.col("doc_id").alias("__id"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__k", "__id").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    sums = sums.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    rows = rows.withColumn("__in", F.row_number().over(Window.partitionBy("__key", "doc_id", "__part").orderBy("__at")) - 1)
    same = (F.col("__key") == F.col("__k")) & rows.doc_id.eqNullSafe(F.col("__id")) & (F.col("__part") == F.col("__p"))
    return rows.join(sums, same).select(*keyed.columns, (F.col("__before") + F.col("__in")).cast("bigint").alias("__copy"))


def rewrite(docs: DataFrame, placed: DataFrame, folder: str) -> DataFrame:
    """Writes the affected shards below ``folder`` (``__shard=<n>`` folders with whole rows, their key and copy);
    returns the shards' rows, read from there and, for shards not affected, from ``docs``."""
    spark = docs.sparkSession
    moved = placed.filter("old <> shard")
    touched = moved.select(F.explode(F.array("old", "shard")).alias("shard")).distinct().collect()  # at most the number of shards
    touched = [r["shard"] for r in touched]
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    where = placed.select(F.col("doc_id").alias("__id"), F.col("key").alias("__k"), F.col("copy").alias("__c"), F.col("shard").alias("__shard"), "copies")

    def located(rows, places):
        same = (F.col("__key") == F.col("__k")) & (F.col("__copy") == F.col("__c")) & rows.doc_id.eqNullSafe(F.col("__id"))
        return rows.join(places, same).select(*keyed.columns, "__copy", "__shard")

    rows = located(keyed.withColumn("__copy", F.lit(0).cast("bigint")), where.filter(where["copies"] == 1).drop("copies"))
    repeated = where.filter((where["copies"] > 1) & (F.col("__c") == 0)).select("__id", "__k")
    if not repeated.isEmpty():
        rows = rows.unionByName(located(_numbered(keyed, repeated), where.filter(where["copies"] > 1).drop("copies")))
    rows.filter(F.col("__shard").isin(touched)).write.partitionBy("__shard").parquet(folder)
    if not touched:
        return rows
    out = spark.read.schema(rows.schema).parquet(folder)
    if placed.filter(~F.col("shard").isin(touched)).isEmpty():
        return out
    return out.unionByName(rows.filter(~F.col("__shard").isin(touched)))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = c.read(spark, sf_dir, "documents")
    old = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % OLD
    placed = c.staged(assign(docs, old), "placed")
    files = rewrite(docs, placed, c.stage_dir(spark, "shards"))
    read = files.select(
        F.col("doc_id").alias("id"), "__key", "__copy", F.col("__shard").alias("shard"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    slots = placed.select("doc_id", "key", "copy", "slot", "old")
    same = (F.col("__key") == F.col("key")) & (F.col("__copy") == F.col("copy")) & F.col("id").eqNullSafe(F.col("doc_id"))
    return read.join(slots, same).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"))
