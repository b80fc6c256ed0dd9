"""Fixed-width bit packing of token ids, with block offsets.

File layout (little endian)::

    magic "LWBITS01" | u32 bits | u32 ids per block | u64 ids | u64 documents | u64 blocks
    document ids      i64 x documents (0 where null)
    null marks        u8  x documents
    document offsets  u64 x (documents + 1)   first id of each document
    block offsets     u64 x (blocks + 1)      byte where each block begins
    blocks            ids, ``bits`` bits each, lowest bit first, ended at a byte

``bits`` is the least number that holds every id of the vocabulary.  A range
of ids needs the blocks it touches only: their bytes are read by offset and
unpacked as whole numpy arrays.

Documents are range-partitioned by id and the first ``TIE_CHARS`` characters of
the text, so that rows of one id (or of none) are dealt over tasks, and sorted by
id and text; each task writes files of about ``FILE_IDS`` ids (a document lies in one file) under a name of its own
and renames them when complete, so a task that runs again leaves one file.
The manifest of files carries the number of ids before each file.

Defined results: a null or empty text has the end id only; null ids come
first; rows with the same id keep the order of their texts.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm import encode as enc

MAGIC = b"LWBITS01"
HEAD = struct.Struct("<8sIIQQQ")
BLOCK = 1 << 16
FILE_IDS = 1 << 22
#: Characters of a text by which rows of equal id are dealt; the range bounds on the driver hold no more of a text.
TIE_CHARS = 24
END = 2


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a folder as Spark names it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def id_bits(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` (unsigned 32-bit) at ``bits`` bits each."""
    wide = np.unpackbits(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def encode_file(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    blocks = [pack_bits(ids[i:i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    head = HEAD.size + 8 * len(doc_ids) + len(doc_ids) + 8 * len(offsets) + 8 * (len(blocks) + 1)
    at = head + np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
    return b"".join([
        HEAD.pack(MAGIC, bits, block, len(ids), len(doc_ids), len(blocks)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        offsets.tobytes(), at.astype("<u8").tobytes(), *blocks])


class Reader:
    """Random access to one file; the directory is read once."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        magic, self.bits, self.block, self.n_ids, self.n_docs, self.n_blocks = HEAD.unpack(self._at(0, HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a bit-packed token file")
        n = self.n_docs
        raw = self._at(HEAD.size, 9 * n + 8 * (n + 1) + 8 * (self.n_blocks + 1))
        null = np.frombuffer(raw, np.uint8, n, 8 * n)
        self.doc_ids = pa.array(np.frombuffer(raw, "<i8", n), mask=null.astype(bool))
        self.offsets = np.frombuffer(raw, "<u8", n + 1, 9 * n).astype(np.int64)
        self.blocks = np.frombuffer(raw, "<u8", self.n_blocks + 1, 9 * n + 8 * (n + 1)).astype(np.int64)

    def _at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids ``first`` to ``last`` (exclusive): one read of the blocks they touch."""
        if first >= last:
            return np.zeros(0, np.uint32)
        a, z = first // self.block, -(-last // self.block)
        raw = self._at(int(self.blocks[a]), int(self.blocks[z] - self.blocks[a]))
        out = []
        for i in range(a, z):
            n = min(self.block, self.n_ids - i * self.block)
            out.append(unpack_bits(raw[self.blocks[i] - self.blocks[a]:self.blocks[i + 1] - self.blocks[a]], n, self.bits))
        return np.concatenate(out)[first - a * self.block:last - a * self.block]

    def runs(self, limit: int):
        """(first document, last, ids) in runs of about ``limit`` ids."""
        i = 0
        while i < self.n_docs:
            j = max(i + 1, int(np.searchsorted(self.offsets, self.offsets[i] + limit, "right")) - 1)
            j = min(j, self.n_docs)
            yield i, j, self.ids(int(self.offsets[i]), int(self.offsets[j]))
            i = j

    def close(self):
        self.file.close()


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = END, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files below ``folder``; returns their manifest (part, file,
    path, n_ids, n_docs, start), ``start`` being the ids of all files before."""
    spark = docs.sparkSession

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = enc.encoder(tokenizer)
        bits = id_bits(encoder.vocab_size)
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        docs_, counts, ids, n, file = [], [], [], 0, 0

        def flush():
            nonlocal docs_, counts, ids, n, file
            path = f"{root}/part-{part:06d}-{file:04d}.bits"
            own = f"{root}/.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(own) as out:
                out.write(encode_file(docs_, np.concatenate(counts), np.concatenate(ids), bits))
            fs.move(own, path)  # the same bytes if a task runs again
            row = pa.RecordBatch.from_pylist([{"part": part, "file": file, "path": path, "n_ids": n, "n_docs": len(docs_)}])
            docs_, counts, ids, n, file = [], [], [], 0, file + 1
            return row

        for whole in batches:
            for b in c.slices(whole, "text", enc.SLICE):
                got, bounds = encoder.encode_with_end(b.column("text"), end)
                docs_ += b.column("doc_id").to_pylist()
                counts.append(np.diff(bounds))
                ids.append(got)
                n += len(got)
                if n >= file_ids:
                    yield flush()
        if docs_:
            yield flush()

    parts = max(1, docs.rdd.getNumPartitions())
    rows = docs.select("doc_id", "text")
    if parts > 1:
        rows = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id"), F.asc_nulls_first(F.substring("text", 1, TIE_CHARS)))
    rows = rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    manifest = c.staged(rows.mapInArrow(c.task(run), "part bigint, file bigint, path string, n_ids bigint, n_docs bigint"), "manifest")
    # ids before each partition: one number for each of them
    total = sorted(manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([r["n"] for r in total])]).tolist()
    begin = spark.createDataFrame([(r["part"], b) for r, b in zip(total, before)], "part bigint, begin bigint")
    from pyspark.sql import Window

    own = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(begin, "part").select(
        "part", "file", "path", "n_ids", "n_docs", (F.col("begin") + F.coalesce(F.sum("n_ids").over(own), F.lit(0))).alias("start"))


def read_back(manifest: DataFrame, folder: str, run_ids: int = 1 << 20) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        fs, _ = filesystem(folder)
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                r = Reader(fs, path)
                for i, j, ids in r.runs(run_ids):
                    at = r.offsets[i:j + 1] - r.offsets[i]
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [r.doc_ids.slice(i, j - i), pa.array(start + r.offsets[i:j]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
                r.close()

    return manifest.select("path", "start").mapInArrow(c.task(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = c.read(spark, sf_dir, "documents")
    folder = c.stage_dir(spark, "bits")
    manifest = c.staged(write(docs, folder, enc.default_path()), "files")
    return read_back(manifest.repartition(max(1, docs.rdd.getNumPartitions())), folder)
