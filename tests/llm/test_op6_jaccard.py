import collections

import numpy as np
import pytest

from labwire.llm import jaccard as j
from labwire.llm.components import components
from tests.llm import data


def shingles(t):
    w = data.words((t or "").translate(data.LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def classes(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = classes(len(sets), links)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[label[i]] = min(doc, least.get(label[i], doc))
    return collections.Counter((r[0], len(s), least.get(k)) for r, s, k in zip(rows, sets, label))


@pytest.mark.parametrize("tile,tile_bytes", [(3, j.TILE_BYTES), (j.TILE, 4000), (j.TILE, j.TILE_BYTES)])
def test_against_brute_force(spark, tile, tile_bytes):
    rows = data.rows()
    # a chain of near copies: many links, some ends not linked with each other
    base = [f"c{i}" for i in range(120)]
    for step in range(14):
        rows.append((700 + step, " ".join(base[:step * 4] + [f"n{step}{i}" for i in range(step % 3)] + base[step * 4 + 2:]), "en", "s"))
    out = j.link(data.documents(spark, rows), tile=tile, tile_bytes=tile_bytes).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute(rows)


def test_a_family_of_unlinked_near_copies_gives_linear_rows(spark, monkeypatch):
    rows = {}
    staged = j.c.staged

    def counted(df, name):
        out = staged(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(j.c, "staged", counted)
    g, most = np.random.default_rng(3), []
    for n in (100, 200, 400):
        texts = []
        for m in range(n):  # each shares about two thirds of its shingles with any other
            w = [f"b{i}" for i in range(300)]
            for at in g.choice(300, 6, replace=False):
                w[at] = f"m{m}x{at}"
            texts.append((m, " ".join(w), "en", "s"))
        rows.clear()
        assert j.link(data.documents(spark, texts)).count() == n
        most.append({k: max(v) for k, v in rows.items()})
    assert most[2]["family"] > 100  # the family did reach verification
    shingles = ("prefix", "placed", "least", "blocks")  # rows of shingles: about 75 a set
    for n, rows_of in zip((100, 200, 400), most):
        assert max(v for k, v in rows_of.items() if k not in shingles) <= 4 * n, rows_of
        assert max(rows_of[k] for k in shingles) <= 75 * n, rows_of


def test_joined_returns_stars():
    g = np.random.default_rng(4)
    key, groups = g.permutation(50).astype(np.int64), np.arange(50) // 2
    for rounds in (0, 1, 6):
        joined, links = j.Joined(50, groups), [(2 * k, 2 * k + 1) for k in range(25)]
        for _ in range(rounds):
            a, b = g.integers(0, 50, (2, 5))
            joined.add(a, b)
            links += list(zip(a.tolist(), b.tolist()))
        want = classes(50, links)
        members = collections.defaultdict(list)
        for x, k in enumerate(want):
            members[k].append(int(key[x]))
        t = joined.stars(key)
        assert sorted(zip(*(t.column(k).to_pylist() for k in "uv"))) == sorted((y, min(m)) for m in members.values() if len(m) > 2 for y in m if y != min(m))


def test_empty(spark):
    assert j.link(data.empty(spark)).count() == 0


def test_tree_loses_no_pair():
    r = np.random.default_rng(0)
    sets = []
    for _ in range(40):
        s = set(r.integers(0, 10**6, r.integers(1, 120)).tolist())
        sets.append(s)
        for _ in range(4):
            t = set(s)
            for x in list(t)[: int(len(t) * 0.13)]:
                t.discard(x)
            sets.append(t | set(r.integers(0, 10**6, len(s) // 30).tolist()))
    vec = np.zeros((len(sets), j.GROUPS), np.int64)
    for i, s in enumerate(sets):
        for x in s:
            vec[i, x % j.GROUPS] += 1
    size = np.array([len(s) for s in sets])
    found = set()
    for u, v, _ in j.tree_pairs(vec, size, np.arange(len(sets))):
        found |= {(min(a, b), max(a, b)) for a, b in zip(u.tolist(), v.tolist())}
    linked = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert linked and linked <= found
    assert len(found) < len(sets) ** 2 / 8


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert all(out[i] == 0 for i in range(61)) and {out[100], out[150], out[200]} == {100} and len(out) == 64
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
