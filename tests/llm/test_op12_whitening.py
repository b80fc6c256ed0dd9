import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from labwire.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, label int, n string, component string"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, i % 3, "x", "y") for i, v in enumerate(vectors)], SCHEMA).repartition(3)


def good(v):
    return v and all(t is not None and math.isfinite(t) for t in v)


def brute(vectors):
    """Exact sums and deviations; components of the covariance by an eigensolver."""
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in enumerate(vectors) if good(v)]
    size = max({len(v) for _, v in kept}, key=lambda d: (sum(len(v) == d for _, v in kept), d))
    kept = [(i, [math.floor(1024 * t) + 100_000 for t in v]) for i, v in kept if len(v) == size]
    n = len(kept)
    s = [sum(x[j] for _, x in kept) for j in range(size)]
    dev = {i: sum((n * x[j] - s[j]) ** 2 for j in range(size)) for i, x in kept}
    a = np.array([[float(Fraction(n * x[j] - s[j], n)) for j in range(size)] for _, x in kept])
    e, v = np.linalg.eigh(a.T @ a / n)
    return n, dev, a, [i for i, _ in kept], e[::-1], v[:, ::-1]


def data(seed=0, n=400, d=12):
    r = np.random.default_rng(seed)
    a = r.normal(size=(n, d)) @ (r.normal(size=(d, d)) * np.geomspace(1, 1e-3, d)) * 0.5 + 0.3
    v = a.astype(np.float32).tolist()
    return v + [None, [], [0.5] * (d - 1), [float("nan")] + [0.1] * (d - 1), [float("inf")] * d, [None] + [0.2] * (d - 1), v[3], v[3]]


def test_against_eigensolver(spark):
    vectors = data()
    n, dev, a, ids, e, v = brute(vectors)
    out = w.whiten(frame(spark, vectors)).collect()
    assert len(out) == 8 * n and {r.vec_id for r in out} == set(ids)
    got = {(r.vec_id, r.component): r for r in out}
    for k in range(8):
        want = a @ v[:, k] / math.sqrt(e[k])
        have = np.array([got[i, k + 1].whitened for i in ids])
        sign = np.sign(have @ want)
        assert np.allclose(have, sign * want, rtol=1e-7, atol=1e-7)
        assert math.isclose(out[0].n, n) and math.isclose(got[ids[0], k + 1].explained, e[k] / e.sum(), rel_tol=1e-9)
    assert all(int(r.deviation) == dev[r.vec_id] for r in out)
    assert max(r.identity_error for r in out) < 1e-9


def test_badly_conditioned_rows_stay_orthonormal(spark):
    r = np.random.default_rng(1)
    a = (r.normal(size=(500, 6)) * [4000, 300, 20, 3, 0.5, 0.05]).astype(np.float32)
    out = w.whiten(frame(spark, a.tolist())).agg(F.max("identity_error"), F.max("component")).first()
    assert out[0] < 1e-7 and out[1] == 6


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[0.25, 0.5]], [[0.25, 0.5]] * 5])
def test_nothing_to_whiten(spark, vectors):
    assert w.whiten(frame(spark, vectors)).count() == 0


def test_flat_directions_are_no_components(spark):
    r = np.random.default_rng(2)
    base = (r.normal(size=(60, 2)) * 64).round()
    vectors = [[float(a), float(b), float(a), 0.5, float(a + b)] for a, b in base]
    out = w.whiten(frame(spark, vectors))
    assert {r.component for r in out.select("component").distinct().collect()} == {1, 2}
    row = out.agg(F.max("identity_error"), F.sum("explained") / F.count("*") * 2).first()
    assert row[0] < 1e-7 and math.isclose(row[1], 1.0, rel_tol=1e-9)


def test_wide_deviations_are_exact(spark):
    x = np.random.default_rng(3).integers(-10**6, 10**6, (50, 5))
    for n, scale in ((10**6, 1), (10**9, 10), (10**12, 10**4)):
        total = np.array([int(t) * n // 50 for t in (x * scale).sum(0)], object)
        got = w._deviations(x * scale, n, total).to_pylist()
        assert [int(g) for g in got if g is not None] == [
            y for y in (sum((n * int(t) - s) ** 2 for t, s in zip(row, total)) for row in x * scale) if y < 10**38]


def test_triangular_solve():
    r = np.triu(np.random.default_rng(4).normal(size=(7, 7))) + 5 * np.eye(7)
    a = np.random.default_rng(5).normal(size=(30, 7))
    assert np.allclose(w.solve(a, r) @ r, a)


def test_huge_entries_do_not_fail(spark):
    out = w.whiten(frame(spark, [[1e30, 0.0], [0.0, 1.0], [0.5, -2.0]]))
    assert out.count() > 0
