"""Shared helpers: staged tables, bounded Arrow slices, vectorised word splitting.

Texts are worked on as whole Arrow buffers: a lookup table classes every
byte, word bounds come from the class changes, and Arrow's dictionary encoder
gives each distinct word of a slice a code.  No Python object is made per
word, and the result is exact (words are compared as bytes).
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwire.session import checkpoint_dir

#: Text bytes worked on at once in a task; a longer text is one slice of its own.
SLICE_BYTES = 2 << 20
#: Rows of an Arrow batch (whole texts travel in them), unless the session says otherwise.
BATCH_ROWS = 1000

_U = np.uint64
_ALL = np.arange(256)
#: Lower-cases A-Z only.
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z, every non-ASCII byte.
ALNUM = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
#: Bytes of lines.
NOT_NEWLINE = _ALL != 10


def prepare(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder of ``spark.checkpoint.dir``, or below the open :func:`scratch` folder."""
    return f"{_SCRATCH.get() or checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for the tables staged inside; it is deleted at the end, also after an error.
    What is to stay must have been written to a path taken before."""
    path = stage_dir(spark, name)
    token = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        drop_staged(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and
    what follows does not depend on the executors that computed it."""
    path = stage_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(spark: SparkSession) -> None:
    """Before a long stage: drop what the stages before left on the driver.  Spark frees
    broadcasts and shuffle files of plans that are gone only when the JVM collects them."""
    gc.collect()
    release()
    spark._jvm.System.gc()


def task(run):
    """``run`` (batches -> batches) for mapInArrow, followed by :func:`release`."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def crc_mod(col: str, m: int):
    """crc32 of the id as text, modulo ``m`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % m


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of an Arrow string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32, len(col) + 1 + col.offset)[col.offset:].astype(np.int64) \
        if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows with at most ``limit`` bytes in ``column``
    (a longer value makes a slice of its own)."""
    if not batch.num_rows:
        return
    _, off = text_bytes(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


@dataclass
class Words:
    """Words of a slice of texts, in text order."""

    codes: np.ndarray  #: int64 index into ``vocab`` of each word
    vocab: pa.Array  #: distinct words (binary), as bytes
    bounds: np.ndarray  #: first word of each text, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        """The text's index for each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def split_words(col, of_word: np.ndarray, lower: bool) -> Words:
    """Maximal runs of ``of_word`` bytes inside each text."""
    data, off = text_bytes(col)
    if lower:
        data = LOWER[data]
    w = of_word[data]
    n = len(data)
    if not n or not w.any():
        return Words(np.zeros(0, np.int64), pa.array([], pa.binary()), np.zeros(len(off), np.int64))
    edge = w.copy()
    edge[1:] &= ~w[:-1]
    at = off[:-1][off[:-1] < n]
    edge[at] = w[at]
    starts = np.flatnonzero(edge)
    edge = w.copy()
    edge[:-1] &= ~w[1:]
    at = off[1:][off[1:] > 0] - 1
    edge[at] = w[at]
    ends = np.flatnonzero(edge) + 1
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[w])])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    return Words(codes, coded.dictionary, np.searchsorted(starts, off))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every output bit depends on every input bit)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE = _U(0x9E3779B97F4A7C15)


def byte_hashes(vocab: pa.Array, upto: int | None = None) -> np.ndarray:
    """A 64-bit hash of each (non-empty) value; of its first ``upto`` bytes if given."""
    data, off = text_bytes(vocab)
    if len(off) < 2:
        return np.zeros(0, _U)
    lens = np.diff(off)
    longest = int(lens.max()) if upto is None else min(upto, int(lens.max()))
    powers = np.ones(max(1, longest), _U)
    if longest > 1:
        powers[1:] = np.cumprod(np.full(longest - 1, _BASE))
    at = np.arange(len(data)) - np.repeat(off[:-1], lens)
    part = data.astype(_U) + _U(1)
    if upto is not None:
        inside = at < longest
        part = np.where(inside, part * powers[np.minimum(at, longest - 1)], _U(0))
        lens = np.minimum(lens, longest)
    else:
        part = part * powers[at]
    return mix(np.add.reduceat(part, off[:-1]) + lens.astype(_U))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` items (of length ``len(h) - k + 1``)."""
    if len(h) < k:
        return np.zeros(0, _U)
    out = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        out = out * _BASE + h[j: len(h) - k + 1 + j]
    return mix(out)


def inside(words: Words, k: int) -> np.ndarray:
    """For each start of a run of ``k`` words: whether the run lies in one text."""
    n = len(words.codes) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = words.bounds[1:]
    return np.arange(n) + k <= np.repeat(last, words.counts)[:n]


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets (texts may be empty)."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive runs of ``values`` as lists of the given lengths."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)


#: Bits of a bitmap: 16 for each value, between 2^20 and 2^27 (16 MB).
MIN_BITS, MAX_BITS = 20, 27


def bitmap(df: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """(bits, log2 of their number) with the low bits of each value of a bigint
    column set; gathered as at most 2^MAX_BITS / 64 words, whatever ``df`` holds."""
    n = df.count()
    log2 = min(MAX_BITS, max(MIN_BITS, int(np.ceil(np.log2(max(1, n) * 16)))))
    low = F.col(column).bitwiseAND((1 << log2) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), low.bitwiseAND(63).cast("int"))
    got = df.select(F.shiftright(low, 6).cast("int").alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(1 << (log2 - 6), np.uint64)
    bits[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return bits, log2


def in_bitmap(bits: np.ndarray, log2: int, values: np.ndarray) -> np.ndarray:
    """Whether each (unsigned) value may be one of the bitmap's."""
    low = values & np.uint64((1 << log2) - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) == 1
