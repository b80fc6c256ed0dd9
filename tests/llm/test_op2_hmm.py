import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm import hmm
from tests.llm import data


def test_counts_and_base_score(spark, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD", 64)  # so that some words are joined
    rows = data.rows()
    out = hmm.score(data.documents(spark), c.crc_mod("doc_id", 7) == 2, states=3, rounds=2).collect()
    assert len(out) == len(rows)
    toks = [(i, data.words((t or "").translate(data.LOWER)) + [None]) for i, t, *_ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in toks]
    count = collections.Counter(w for (i, t), h in zip(toks, held) if not h for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), h, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6)) for (i, t), h in zip(toks, held))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_empty(spark):
    assert hmm.score(data.empty(spark), F.lit(False), states=2, rounds=1).count() == 0


def _model(k, g, seed):
    r = np.random.default_rng(seed)
    m = hmm.Hmm(np.full(g, 1 / g), k)
    m.update(r.random(k) * 5, r.random((k, k)) * 5, r.random((g, k)) * 50)
    return m


def test_likelihood_is_exact_across_segments():
    m, r = _model(3, 5, 1), np.random.default_rng(2)
    texts = [r.integers(0, 5, n) for n in (1, 7, 8, 9, 40, 23, 16)]
    got = hmm.likelihood(m, np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts]), size=8)
    for t, x in zip(texts, got):
        a, log = m.start * m.emit[t[0]], 0.0
        for o in t[1:]:
            a = (a @ m.move) * m.emit[o]
            log += math.log(a.sum())
            a = a / a.sum()
        assert abs(log + math.log(a.sum()) - x) < 1e-9


def test_likelihoods_of_all_sequences_sum_to_one():
    m = _model(2, 3, 4)
    grid = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
    p = np.exp(hmm.likelihood(m, grid.ravel(), np.arange(0, grid.size + 1, 5), size=2))
    assert abs(p.sum() - 1) < 1e-9


def test_rounds_do_not_lower_the_likelihood(monkeypatch):
    monkeypatch.setattr(hmm, "PRIOR", 0.0)
    m, r = _model(3, 6, 5), np.random.default_rng(6)
    seq = np.concatenate([np.tile([0, 1, 2], 40), np.tile([3, 4, 5], 40), r.integers(0, 6, 60)])
    start, length, _ = hmm.segments(seq, np.array([0, 120, 240, 300]), 50)
    last = -math.inf
    for _ in range(5):
        first, move, emit, total = hmm.expected(m, seq, start, length)
        assert abs(first.sum() - len(start)) < 1e-6 and abs(emit.sum() - len(seq)) < 1e-6
        assert total > last - 1e-6
        last = total
        m.start, m.move, m.emit = first / first.sum(), (move + 1e-12) / (move + 1e-12).sum(1, keepdims=True), (emit + 1e-12) / (emit + 1e-12).sum(0)
