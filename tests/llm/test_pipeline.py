import os
import random
import tempfile

import corpus_pipeline as p
from tests.llm import data
from tests.llm.test_op1_decontaminate import brute as hits
from tests.llm.test_op4_quality import brute as counts
from tests.llm.test_op6_jaccard import shingles


def _tables(spark, docs, items, labels):
    folder = tempfile.mkdtemp()
    docs.write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(os.path.join(folder, "labels.parquet"))
    return folder


def test_stages_against_brute_force(spark):
    rows = [r for r in data.rows()]
    item = " ".join(next(t for _, t, *_ in rows if t and len(t.split()) == 200).split()[10:60])
    sf = _tables(spark, data.documents(spark), [(1, item), (2, None)], [(0, 1, 0)])
    docs = spark.read.parquet(sf + "/documents.parquet")
    seen = {"": rows}
    for name, stage in p.STAGES[:-1]:
        docs = p.c.staged(stage(spark, docs, sf), name)
        assert docs.columns == [x.split()[0] for x in data.DOCS.split(", ")]
        seen[name] = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    key = lambda x: sorted(map(repr, x))

    def good(t):
        b = counts(t)
        return b[0] >= 50 and 100 * b[4] <= 50 * b[0]

    assert key(seen["quality"]) == key([r for r in rows if good(r[1])])
    assert key(seen["toxicity"]) == key(seen["quality"])  # no toxic label
    left = []
    for r in sorted(seen["toxicity"], key=lambda r: (r[0] is None, r[0] or 0)):
        s = shingles(r[1])
        if not any(100 * len(s & shingles(k[1])) >= 75 * len(s | shingles(k[1])) for k in left):
            left.append(r)
    assert key(seen["near_duplicates"]) == key(left)  # copies here are linked with the least one
    dirty = {x[0] for x in hits([r[:2] for r in left], [(1, item)]) if x[-1]}
    assert dirty and key(seen["decontamination"]) == key([r for r in left if r[0] not in dirty])
    shared = p.c.stage_dir(spark, "x").removeprefix("file:").rsplit("/", 1)[0]
    before = set(os.listdir(shared))
    out = p.run(spark, sf)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r[0] for r in seen["decontamination"]}
    left = set(os.listdir(shared)) - before
    assert len(left) == 1 and left.pop().startswith("llm-packing-")  # of its tables a run leaves the result alone


def test_scratch_is_deleted_after_an_error(spark):
    try:
        with p.c.scratch(spark, "outer") as folder:
            assert p.c.staged(spark.range(3), "rows").count() == 3
            local = folder.removeprefix("file:")
            assert [x.split("-")[1] for x in os.listdir(local)] == ["rows"]
            raise ValueError
    except ValueError:
        pass
    assert not os.path.exists(local)
    assert not p.c.stage_dir(spark, "after").startswith(folder)


def test_certified_rules_and_the_classifier_reject_rows(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(1600):
        words = [f"w{r.randrange(300)}" for _ in range(60)]
        junk, rude = i % 4 == 0, i % 5 == 1
        if junk:
            words = [w + "***" for w in words]
        if rude:
            for _ in range(3):
                words[r.randrange(60)] = "grobian" + r.choice(["", "er", "s", "in"])
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(not junk), int(rude)))
    sf = _tables(spark, data.documents(spark, rows), [(1, "x")], labels)
    docs = spark.read.parquet(sf + "/documents.parquet")
    good = {i for i, quality, _ in labels if quality}
    docs = p.c.staged(p.quality_rules(spark, docs, sf), "quality")
    kept = {x.doc_id for x in docs.collect()}
    assert kept <= good and len(kept) >= 0.99 * len(good)
    left = {x.doc_id for x in p.toxic(spark, docs, sf).collect()}
    rude = {i for i, _, toxic in labels if toxic} & kept
    assert len(left & rude) <= 0.05 * len(rude)
    assert len((kept - rude) - left) <= 0.01 * len(kept - rude)


def test_empty(spark):
    sf = _tables(spark, data.empty(spark), [], [])
    assert p.run(spark, sf).count() == 0
