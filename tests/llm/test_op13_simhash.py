import collections

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from labwire.llm import simhash as s
from tests.llm import data
from tests.llm.test_op6_jaccard import classes


def fingerprint(text):
    w = data.words((text or "").translate(data.LOWER))
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def brute(ids, fps):
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    label = classes(len(fps), links)
    least = {}
    for doc, k in zip(ids, label):
        if doc is not None:
            least[k] = min(doc, least.get(k, doc))
    return collections.Counter((d, f, least.get(k)) for d, f, k in zip(ids, fps, label))


def near_rows():
    """Chains and balls of long texts with few changed words, beside the awkward rows."""
    rows = data.rows()
    r = np.random.default_rng(5)
    for family in range(3):
        base = [f"f{family}x{i}" for i in range(400)]
        for m in range(30):
            w = list(base)
            for at in r.integers(0, 400, 1 + m // 6):
                w[at] = f"m{m}"
            rows.append((1000 + 100 * family + m, (" " * (1 + m % 3)).join(w) + "\n" * (m % 2), "en", "s"))
    return rows


@pytest.mark.parametrize("pieces,tile", [(None, s.TILE), (6, 5), (5, 7), (7, 3), (8, s.TILE)])
def test_against_brute_force(spark, pieces, tile):
    rows = near_rows()
    fps = [fingerprint(t) for _, t, *_ in rows]
    out = s.near(data.documents(spark, rows), pieces, tile).collect()
    got = collections.Counter((x.doc_id, x.fp % 2**64, x.component_id) for x in out)
    assert got == brute([x[0] for x in rows], fps)
    assert len({k[2] for k in got}) < len(set(fps))  # something was linked


def test_query_columns(spark, tmp_dir):
    data.documents(spark, [(7, "one two", "en", "s"), (3, None, "en", "s"), (None, " \t", "en", "s")]).write.parquet(f"{tmp_dir}/documents.parquet")
    out = {x.doc_id: x for x in s.op13(spark, tmp_dir).collect()}
    assert out[7].fingerprint == f"{xxhash.xxh64_intdigest('one two'.encode(), 42):016x}"
    assert out[3].fingerprint == out[None].fingerprint == "0" * 16 and out[3].component_id == out[None].component_id == 3


def test_hash_is_sparks(spark):
    row = spark.sql("SELECT xxhash64('one two') AS h").first()
    assert row.h % 2**64 == int(s.fingerprints(pa.array(["One\n two"]))[0])


def test_empty(spark):
    assert s.near(data.empty(spark)).count() == 0


def test_blocks_lose_no_pair():
    r = np.random.default_rng(0)
    for pieces in (5, 6, 7, 8, 9, 10):
        for _ in range(200):
            differ = sum(1 << int(b) for b in r.choice(64, 4, replace=False))
            assert any(m & differ == 0 for m in s.masks(pieces))
    assert s.pieces_for(1000) == 6 and s.pieces_for(10**8) == 7 and s.pieces_for(10**10) == 8


def test_pivots_bound_the_distance():
    assert len(set(s.PIVOTS.tolist())) == s.N_PIVOTS
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 2**64, 2000, dtype=np.uint64) for _ in range(2))
    t = [np.bitwise_count(x[:, None] ^ s.PIVOTS).astype(int) for x in (a, b)]
    differ = np.abs(t[0] - t[1]).max(1)
    assert (differ <= np.bitwise_count(a ^ b)).all()  # never discards a pair within the bound
    assert (differ > s.DIFFER).mean() > 0.99  # and discards nearly all unlike ones


def test_a_family_gives_linear_links(spark):
    """A ball of n fingerprints of which all pairs link returns n - 1 links a block, not n squared."""
    r = np.random.default_rng(2)
    base = int(r.integers(0, 2**63))
    for n in (200, 400, 800):
        fps = {base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(a)}
        df = spark.createDataFrame([(x,) for x in sorted(fps)[:n]], "fp bigint")
        got = s.links(df, 6)
        assert got.count() <= len(s.masks(6)) * (n - 1)
        assert got.agg(F.count_if(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 4)).first()[0] == 0


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = s.fingerprints(pa.array([text, None, "a b c d e", text]))
    monkeypatch.setattr(s, "HASHED", 100)
    assert (s.fingerprints(pa.array([text, None, "a b c d e", text])) == whole).all()
    assert int(whole[0]) == fingerprint(text)
