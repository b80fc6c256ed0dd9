import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labwire.llm import decontaminate as d
from tests.llm import data

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(t):
    return WORD.findall((t or "").translate(data.LOWER))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, ids = cut(t), set(), set()
        for item, s in items:
            v = cut(s)
            m = min(13, len(v))
            grams = {tuple(v[p:p + m]) for p in range(len(v) - m + 1)} if v and item is not None else set()
            for p in range(len(w) - m + 1) if grams else ():
                if tuple(w[p:p + m]) in grams:
                    hit.update(range(p, p + m))
                    ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def items_of(docs):
    long = " ".join(cut(docs[7][1])[2:28])
    return [(1, long), (2, long), (2, long), (3, "W1 w2"), (10, "the"), (4, None), (5, ""), (None, "a the"), (6, " ".join(cut(docs[20][1])[:13])), (7, "word " * 13)]


def test_against_brute_force(spark):
    rows = data.rows()
    items = items_of(rows)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(d.contaminated(data.documents(spark), table)) == brute([r[:2] for r in rows], items)


@pytest.mark.parametrize("which", ["docs", "items"])
def test_empty(spark, which):
    table = spark.createDataFrame([(1, "the a")], "item_id bigint, text string")
    out = d.contaminated(data.empty(spark) if which == "docs" else data.documents(spark), table if which == "docs" else table.limit(0))
    assert out.filter("n_hit > 0").count() == 0
    assert out.count() == (0 if which == "docs" else len(data.rows()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=13, max_size=60), st.data())
def test_shared_spans_share_a_fingerprint(symbols, draw):
    import numpy as np
    import pyarrow as pa

    p = draw.draw(st.integers(0, len(symbols) - 13))
    left = [f"v{x}" for x in symbols]
    right = ["z"] * 3 + left[p:p + 13] + ["y"] * 4
    prints = []
    for w in (left, right):
        words, h = d._words(pa.array([" ".join(w)]))
        prints.append(set(d._fingerprints(words, h, d.GRAM, d.WINDOW)[1].tolist()))
    assert prints[0] & prints[1]
    assert not np.any(d.winnow(np.zeros(0, np.uint64), 3))
