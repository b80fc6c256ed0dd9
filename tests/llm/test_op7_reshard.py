import itertools
import tempfile

from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm import reshard as r
from tests.llm import data


def test_flow_moves_the_fewest_bytes():
    for supply in ([7, 0, 5], [1, 1, 10], [0, 0, 0], [4]):
        cap = r.capacities(sum(supply), 3)
        f = r.min_cost_flow(supply, cap, lambda i, j: 0 if i == j else 1)
        assert [sum(x) for x in f] == supply and [sum(x[j] for x in f) for j in range(3)] == cap
        moved = sum(f[i][j] for i, j in itertools.product(range(len(supply)), range(3)) if i != j)
        assert moved == sum(max(0, s - (cap[i] if i < 3 else 0)) for i, s in enumerate(supply))


def test_flow_heeds_costs():
    f = r.min_cost_flow([3, 3], [3, 3], lambda i, j: 0 if i != j else 5)
    assert f == [[0, 3], [3, 0]]


def test_shards(spark):
    docs = data.documents(spark)
    old = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 3
    placed = c.staged(r.assign(docs, old, shards=4), "t")
    files = r.rewrite(docs, placed, tempfile.mkdtemp() + "/o").collect()
    rows = data.rows()
    assert sorted((str(x.doc_id), str(x.text)) for x in files) == sorted((str(i), str(t)) for i, t, *_ in rows)
    assert all(x.shard == "9" for x in files)  # a clashing column stays
    total, slots = {}, {}
    for x in placed.collect():
        total[x.shard] = total.get(x.shard, 0) + x.size
        slots.setdefault(x.shard, []).append(x.slot)
    assert sum(total.values()) == sum(len((t or "").encode()) + 1 for _, t, *_ in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_near_equal_bytes(spark):
    rows = [x for x in data.rows() if len(x[1] or "") < 10_000]
    docs = data.documents(spark, rows)
    total = [0] * 4
    for x in r.assign(docs, F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 3, shards=4).collect():
        total[x.shard] += x.size
    assert max(total) - min(total) <= max(len((t or "").encode()) + 1 for _, t, *_ in rows)


def test_rows_that_repeat_in_full_fill_several_shards(spark, tmp_path):
    rows = [(1, "z" * 200, "en", "hot")] * 900 + [(i, "y" * (i % 60), "en", "s") for i in range(2, 102)] + [(None, None, "en", "s")] * 5
    docs = data.documents(spark, rows).repartition(7)
    placed = c.staged(r.assign(docs, F.crc32(F.col("source").cast("binary")) % 3, shards=4), "t")
    files = r.rewrite(docs, placed, str(tmp_path / "o"))
    where = {(x.doc_id, x.key, x.copy): (x.shard, x.slot) for x in placed.collect()}
    got = [(x.doc_id, x.text, *where[x.doc_id, x["__key"], x["__copy"]], x["__shard"]) for x in files.collect()]
    got = [(i, text, of, shard, slot) for i, text, of, slot, shard in got]
    assert sorted((str(a), str(b)) for a, b, *_ in got) == sorted((str(a), str(b)) for a, b, *_ in rows)
    assert all(of == shard for *_, of, shard, _ in got)
    total = [sum(len(text or "") + 1 for _, text, shard, *_ in got if shard == k) for k in range(4)]
    assert max(total) - min(total) <= 201
    for k in range(4):
        assert sorted(slot for *_, shard, slot in got if shard == k) == list(range(sum(x[3] == k for x in got)))


def test_empty(spark):
    assert r.assign(data.empty(spark), F.lit(0), shards=4).count() == 0
