"""Whitening of embeddings by shifted CholeskyQR.

Every finite vector becomes a vector ``x`` of longs; the ``n`` x-vectors less
their mean are the rows of a tall matrix ``A``.  ``A`` never leaves the
tasks.  Each pass over the table sends its centred rows through triangular
solves with the factors found so far and sums one ``d x d`` Gram matrix:

1. the Gram matrix of ``A``, shifted by a multiple of the rounding error so
   that its Cholesky factor ``R1`` exists at any condition of ``A``;
2. the Gram matrix of ``A R1^-1``, whose factor is ``R2``; this pass repeats
   while the rows are still far from orthonormal (at most ``MAX_PASSES``);
3. the last Gram matrix differs from the identity by rounding alone.  Its own
   factor (its symmetric root if a direction has no variance) ends ``R``.

``R = R_k .. R2 R1`` has the singular values and right singular vectors of
``A``, so the SVD of ``R`` gives the components of the covariance without
squaring its condition.  One pass writes the whitened rows, and one more
measures their covariance against the identity.

The sums of the x-vectors, and ``deviation``, are exact integers; ``x - S/n``
is one exact difference and one division.  Partial matrices travel as rows
(row index, salt), so no task or driver gathers more than ``PARTS`` or ``d``
rows of ``d`` numbers, whatever the number of tasks.

Defined results: a vector that is null or holds a null or non-finite entry is
dropped, as are empty ones and those of another length than most have (ties:
the longer); repeated rows count each time; a null id stays null.  Entries of
which ``x`` leaves 53 bits are clamped to that.  Directions without variance
(below ``FLAT`` of the largest deviation) are no components, so equal vectors,
a single one and an empty table give no rows.
"""

from __future__ import annotations

from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c

#: x = floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows whose matrix is worked on at once.
BLOCK = 4096
#: Numbers of partial rows gathered: each row index is summed in so many parts in all.
PARTS = 1024
MAX_PASSES = 6
#: A component's deviation is at least this share of the largest one's.
FLAT = 1e-10
#: Entries of a Gram matrix may differ from the identity by so much before another pass.
NEAR = 1e-8
_LIMIT = 2.0**53
_WIDE = Context(prec=40)


def finite(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not null or empty and holds finite numbers alone."""
    ok = F.forall(column, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return df.filter(F.coalesce((F.size(column) > 0) & ok, F.lit(False)))


def common_length(df: DataFrame, column: str = "embedding") -> int | None:
    """The length that most vectors have."""
    row = df.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return None if row is None else row["d"]


def _blocks(batches, column: str):
    """(record batch, x as an int64 matrix) of at most BLOCK rows."""
    for whole in batches:
        for s in range(0, whole.num_rows, BLOCK):
            b = whole.slice(s, BLOCK)
            v = b.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            x = np.clip(np.floor(v * SCALE), -_LIMIT, _LIMIT).astype(np.int64) + OFFSET
            yield b, x


def sums(vectors: DataFrame, d: int, column: str = "embedding") -> tuple[int, list[int]]:
    """(n, S): the number of x-vectors and their exact sums by dimension."""

    def run(batches):
        n, total = 0, [0] * d
        for _, x in _blocks(batches, column):
            n += len(x)
            part = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)  # no overflow at any block
            total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, *part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))], ["dim", "v"])

    got = dict(vectors.select(column).mapInArrow(c.task(run), "dim int, v decimal(38,0)").groupBy("dim").agg(F.sum("v").alias("v")).collect())
    return int(got.get(-1, 0)), [int(got.get(j, 0)) for j in range(d)]


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S/n, from the exact n*x - S where that fits a long (else from long doubles)."""
    big = max(int(np.abs(x).max(initial=0)), int(max(abs(int(t)) for t in total) // n))
    if big * n < 2**62:
        return (x * n - total.astype(np.int64)) / n
    mean = np.array([int(t) // n for t in total], np.int64)
    rest = np.array([(int(t) % n) / n for t in total])
    return (x - mean).astype(np.float64) - rest


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows q with ``q r = a`` for an upper triangular ``r``."""
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _gathered(rows: DataFrame, d: int, width: int) -> np.ndarray:
    """Sum of partial matrices that travel as (row, part, values)."""
    def add(table: pa.Table) -> pa.Table:
        values = table.column("values").combine_chunks().flatten().to_numpy().reshape(-1, width)
        return pa.table({"row": table.column("row")[:1], "values": c.lists(pa.array(values.sum(0)), np.array([width]))})

    out = np.zeros((d, width))
    for row, values in rows.groupBy("row", "part").applyInArrow(add, "row int, values array<double>").collect():
        out[row] += values
    return out


def _partials(d: int, matrix, n_parts: int):
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() % n_parts
    return pa.RecordBatch.from_arrays(
        [pa.array(range(d), pa.int32()), pa.array([part] * d, pa.int32()), c.lists(pa.array(matrix.ravel()), np.full(d, matrix.shape[1]))], ["row", "part", "values"])


def gram(vectors: DataFrame, n: int, total: np.ndarray, factors: list[np.ndarray], column: str = "embedding") -> np.ndarray:
    """The Gram matrix of the centred rows after triangular solves with ``factors``."""
    d = len(total)
    n_parts = max(1, PARTS // d)

    def run(batches):
        g = np.zeros((d, d))
        for _, x in _blocks(batches, column):
            q = centred(x, n, total)
            for r in factors:
                q = solve(q, r)
            g += q.T @ q
        yield _partials(d, g, n_parts)

    return _gathered(vectors.select(column).mapInArrow(c.task(run), "row int, part int, values array<double>"), d, d)


def cholesky_qr(vectors: DataFrame, n: int, total: np.ndarray, column: str = "embedding") -> np.ndarray:
    """R of the centred rows (d x d; upper triangular up to a last symmetric root)."""
    d = len(total)
    eps = np.finfo(float).eps / 2
    factors: list[np.ndarray] = []
    r = np.eye(d)
    for step in range(MAX_PASSES):
        g = gram(vectors, n, total, factors, column)
        if step and np.abs(g - np.eye(d)).max() < NEAR:
            break
        if not np.trace(g) > 0:
            return np.zeros((d, d))
        shift = 11 * (float(n) * d + d * (d + 1)) * eps * np.trace(g) if step == 0 else 0.0
        try:
            f = np.linalg.cholesky(g + max(shift, 0.0) * np.eye(d)).T
            if step and f.diagonal().min() < 1e-6:
                break  # a direction without variance: it cannot be made orthonormal
        except np.linalg.LinAlgError:
            if step:
                break
            f = np.linalg.cholesky(g + 1e-8 * np.trace(g) * np.eye(d)).T  # rows so many that the bound is void
        factors.append(f)
        r = f @ r
    try:
        last = np.linalg.cholesky(g).T
    except np.linalg.LinAlgError:
        e, u = np.linalg.eigh(g)
        last = np.sqrt(np.maximum(e, 0.0))[:, None] * u.T
    return last @ r


def components(r: np.ndarray, n: int, upto: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit eigenvectors of the covariance as columns, eigenvalues, share of the trace) from R.
    Of each vector the entry farthest from zero is positive."""
    _, s, vt = np.linalg.svd(r)
    keep = int((s[:upto] > max(FLAT * s[0], 0.0)).sum()) if len(s) and s[0] > 0 else 0
    v = vt[:keep].T
    v = v * np.where(v[np.abs(v).argmax(0), range(keep)] < 0, -1.0, 1.0)
    return v, s[:keep] ** 2 / n, s[:keep] ** 2 / max((s**2).sum(), np.finfo(float).tiny)


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n*x - S)^2, exact: in longs where they suffice, else from
    21-bit limbs (each row ends in one exact integer); null beyond 38 digits."""
    exact = max(int(np.abs(x).max(initial=0)), 1) * n + max(abs(int(t)) for t in total) < 2**62
    kind = pa.decimal128(38, 0)
    if exact:
        y = np.abs(x * n - total.astype(np.int64))
        if x.shape[1] * int(y.max(initial=0)) ** 2 < 2**63:
            return pa.array((y * y).sum(1)).cast(kind)
        a, b, z = y >> 42, (y >> 21) & 0x1FFFFF, y & 0x1FFFFF
        limbs = [(p * q).sum(1).tolist() for p, q in ((a, a), (a, b), (a, z), (b, b), (b, z), (z, z))]
        out = [(aa << 84) + (ab << 64) + (az << 43) + (bb << 42) + (bz << 22) + zz for aa, ab, az, bb, bz, zz in zip(*limbs)]
    else:
        out = [sum((n * v - int(t)) ** 2 for v, t in zip(row, total)) for row in x.tolist()]
    return pa.array([_WIDE.create_decimal(v) if v < 10**38 else None for v in out], kind)


def whiten(df: DataFrame, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",), upto: int = COMPONENTS) -> DataFrame:
    """One row per remaining row of ``df`` and component: the ``keep`` columns, component,
    n, deviation (decimal), whitened, explained, identity_error."""
    spark = df.sparkSession
    kept = df.select(*keep)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    ddl += ", component int, n bigint, deviation decimal(38,0), whitened double, explained double"
    vectors = finite(df.select(*keep, F.col(column).cast("array<double>").alias("embedding")))
    d = common_length(vectors)
    n = 0
    if d is not None:
        vectors = vectors.filter(F.size("embedding") == d)
        n, whole = sums(vectors, d)
    if not n:
        return spark.createDataFrame([], f"{ddl}, identity_error double")
    total = np.array(whole, object)
    v, e, share = components(cholesky_qr(vectors, n, total), n, upto)
    k = v.shape[1]
    if not k:
        return spark.createDataFrame([], f"{ddl}, identity_error double")
    basis = v / np.sqrt(e)
    names = list(keep) + ["component", "n", "deviation", "whitened", "explained"]

    def measured(batches):
        g = np.zeros((k, k + 1))
        for _, x in _blocks(batches, "embedding"):
            z = centred(x, n, total) @ basis
            g[:, :k] += z.T @ z
            g[:, k] += z.sum(0)
        yield _partials(k, g, max(1, PARTS // d))

    m = _gathered(vectors.select("embedding").mapInArrow(c.task(measured), "row int, part int, values array<double>"), k, k + 1) / n
    # the mean of the whitened rows is rounding alone, so its square can be taken off
    error = float(np.abs(m[:, :k] - np.outer(m[:, k], m[:, k]) - np.eye(k)).max())

    def run(batches):
        for b, x in _blocks(batches, "embedding"):
            z = centred(x, n, total) @ basis
            rows = pa.array(np.repeat(np.arange(b.num_rows), k))
            fixed = [b.column(i).take(rows) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(fixed + [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)), pa.array(np.full(b.num_rows * k, n)),
                _deviations(x, n, total).take(rows), pa.array(z.ravel()), pa.array(np.tile(share, b.num_rows))], names)

    return vectors.mapInArrow(c.task(run), ddl).withColumn("identity_error", F.lit(error))


def op12(spark, sf_dir: str) -> DataFrame:
    out = whiten(c.read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))  # null beyond a long
