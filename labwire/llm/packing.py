"""Sum-of-squares packing of documents into windows of ``width`` tokens.

Documents are taken in the order of their partition.  A document's full
windows are cut off as they are; what is left, ``r`` tokens, goes online into
the open window whose level (fill) makes the sum of squared counts smallest:
with ``n[h]`` the number of open windows at level ``h``, moving one of them to
``h + r`` changes the sum by ``-2 n[h] + 1`` and ``+2 n[h + r] + 1`` (a full
window no longer counts; a new window only adds).  On ties the fullest wins.
The counts are one level array.

Open windows are bounded by ``max_open``.  Beyond that, and at the end of the
partition, all open windows are drained: the emptiest are cut to fill the
fullest, so at most one stays partly filled, and that one is cut into windows
whose lengths are powers of two.  So no window needs padding, each token lies
in exactly one piece, and a task holds at most ``max_open`` windows.

Each partition of the input packs its own windows: no shuffle, and a hot
source or key plays no part.  Window ids hold the partition's number, so a
task that runs again gives the same rows.

Defined results: a null text is empty (only its end token); repeated rows are
packed each; a null id stays null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm import encode as enc

WIDTH = 1024
END = 0
MAX_OPEN = 2048


class Levels:
    """Open windows by level; ``close(pieces)`` is called with each finished window."""

    def __init__(self, width: int, max_open: int, close):
        self.width, self.max_open, self.close = width, max_open, close
        self.n = np.zeros(width + 1, np.int64)
        self.at: list[list] = [[] for _ in range(width + 1)]
        self.open = 0

    def best_level(self, r: int) -> int:
        """Where a piece of ``r`` tokens goes; 0 is a new window."""
        n, top = self.n, self.width - r
        after = 2 * n[r:self.width + 1] + 1  # of the level reached, from level 0 up
        after[-1] = 0  # full
        change = after - 2 * n[:top + 1] + 1
        change[0] = after[0]  # a new window leaves no level
        change[1:][n[1:top + 1] == 0] = np.iinfo(np.int64).max  # none there
        return top - int(np.argmin(change[::-1]))

    def add(self, piece: tuple, r: int) -> None:
        h = self.best_level(r)
        pieces = []
        if h:
            pieces = self.at[h].pop()
            self.n[h] -= 1
            self.open -= 1
        pieces.append(piece)
        if h + r == self.width:
            self.close(pieces)
            return
        self.at[h + r].append(pieces)
        self.n[h + r] += 1
        self.open += 1
        if self.open > self.max_open:
            self.drain(last=False)

    def drain(self, last: bool) -> None:
        """Refill the open windows from each other, cutting freely."""
        held = [p for h in range(self.width, 0, -1) for w in self.at[h] for p in w]
        self.at = [[] for _ in range(self.width + 1)]
        self.n[:] = 0
        self.open = 0
        fill, pieces = 0, []
        for p in held:
            while p is not None:
                doc, start, length = p
                take = min(length, self.width - fill)
                pieces.append((doc, start, take))
                fill += take
                p = (doc, start + take, length - take) if take < length else None
                if fill == self.width:
                    self.close(pieces)
                    fill, pieces = 0, []
        if not pieces:
            return
        if not last:
            self.at[fill].append(pieces)
            self.n[fill] += 1
            self.open = 1
            return
        left = fill
        while left:
            size = 1 << (left.bit_length() - 1)
            out, need = [], size
            while need:
                doc, start, length = pieces[0]
                take = min(length, need)
                out.append((doc, start, take))
                pieces[0] = (doc, start + take, length - take)
                if take == length:
                    pieces.pop(0)
                need -= take
            self.close(out)
            left -= size


def pack(docs: DataFrame, tokenizer: str, end: int = END, width: int = WIDTH, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset,
    ids (binary, little-endian unsigned 32-bit)."""
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        encoder = enc.encoder(tokenizer)
        made = 0
        rows: list[list] = [[] for _ in names]

        def close(pieces):
            nonlocal made
            offset = 0
            for (doc, tokens, ids, first), start, length in pieces:
                for col, v in zip(rows, (doc, start, length, tokens, base + made, offset, ids[start - first:start - first + length].tobytes())):
                    col.append(v)
                offset += length
            made += 1

        def flush():
            kinds = [pa.int64()] * 6 + [pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(col, k) for col, k in zip(rows, kinds)], names)
            for col in rows:
                col.clear()
            return out

        levels = Levels(width, max_open, close)
        for whole in batches:
            for b in c.slices(whole, "text", enc.SLICE):
                ids, bounds = encoder.encode_with_end(b.column("text"), end)
                for doc, a, z in zip(b.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    n = z - a
                    full = n - n % width
                    for s in range(0, full, width):
                        close([((doc, n, ids[a + s:a + s + width], s), s, width)])
                    if n > full:
                        levels.add(((doc, n, ids[a + full:z].copy(), full), full, n - full), n - full)
                if rows[0]:
                    yield flush()
        levels.drain(last=True)
        if rows[0]:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(
        c.task(run), "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")


def op5(spark, sf_dir: str) -> DataFrame:
    out = pack(c.read(spark, sf_dir, "documents"), enc.default_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
