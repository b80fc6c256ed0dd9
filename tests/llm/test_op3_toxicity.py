import random

from pyspark.sql import functions as F

from labwire.llm import toxicity as t
from tests.llm import data


def _labelled(n=400):
    r = random.Random(3)
    plain = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [r.choice(plain) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w[r.randrange(60)] = "grobian" + r.choice(["", "er", "s", "in"])
        docs.append((i, " ".join(w), "en" if i % 2 else "de", "s"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_awkward_rows(spark):
    docs, labels = _labelled()
    extra = [(1000, None, "en", None), (1001, "", None, "s"), (None, "grobian " * 50, "en", "s"), (1002, "grobianen " + "x " * 50_000, None, "s")]
    table = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in t.classify(data.documents(spark, docs + extra), table).collect()}
    held = [r for r in out.values() if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    truth = {i: y for i, _, y in labels}
    assert sum((r.score >= t.CUTOFF) == (truth[r.doc_id] == 1) for r in held) >= 0.95 * len(held)
    assert len(out) == len(docs) + len(extra)
    assert all(0 <= r.score <= 1 for r in out.values())
    assert out[1000].score == out[1001].score < t.CUTOFF
    assert out[1002].score >= t.CUTOFF  # the whole text counts


def test_without_toxic_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = t.classify(data.documents(spark), none)
    assert out.filter("score <> 0 or flagged").count() == 0
    assert t.classify(data.empty(spark), none).count() == 0


def test_language_picks_the_threshold_only(spark):
    docs, labels = _labelled(200)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    a = data.documents(spark, docs)
    model, cuts = t.fit(a, table, F.lit(False))
    b = a.withColumn("lang", F.lit("xx"))
    keep = ["doc_id", "lang"]
    x = {r.doc_id: r.score for r in t.score(a, model, cuts, keep).collect()}
    y = {r.doc_id: r.score for r in t.score(b, model, cuts, keep).collect()}
    assert x.keys() == y.keys() and all(abs(x[i] - y[i]) < 1e-5 for i in x)  # equal but for the rounding of sums


def _spanish():
    docs, labels = _labelled(600)
    docs = [(i, text, "es" if i % 10 == 0 else lang, s) for i, text, lang, s in docs]  # 60 Spanish rows, all toxic
    docs[15] = (15, docs[15][1] + " w1" * 400, "de", "s")  # longer than the sample's texts
    return docs, labels


def test_thresholds_use_all_labelled_rows(spark):
    docs, labels = _spanish()
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    _, cuts = t.fit(data.documents(spark, docs), table, F.col("doc_id") % 4 == 1, sample_rows=150, sample_chars=1000)
    assert set(cuts) == {"", "en", "es"}  # each with 20 toxic rows or more of its own, far fewer in the sample


def test_counts_hold_every_labelled_row(spark):
    docs, labels = _spanish()
    lab = spark.createDataFrame([(i, y) for i, _, y in labels], "doc_id bigint, toxic int")
    model = t.Model()
    out = t.counts(data.documents(spark, docs + [(9999, "x", "fr", "s")]), lab, [model, model], F.col("doc_id") % 2).collect()
    got, want = {}, {}
    for r in out:
        pos, neg = got.get(r.lang, (0, 0))
        got[r.lang] = (pos + r.pos, neg + r.neg)
    for (_, _, lang, _), (_, _, y) in zip(docs, labels):
        pos, neg = want.get(lang, (0, 0))
        want[lang] = (pos + y, neg + 1 - y)
    assert got == want


def test_binned_calibration_is_that_of_the_rows():
    import numpy as np

    r = np.random.default_rng(5)
    y = (r.random(4000) < 0.2).astype(float)
    x = r.standard_normal(4000) * 2 + 3 * y - 2
    rows, bins = t.Model(), t.Model()
    rows.calibrate(x, y, 1 - y)
    b = np.unique(np.floor(x * t.FINE), return_inverse=True)[1]
    n, pos = np.bincount(b), np.bincount(b, weights=y)
    mean = np.bincount(b, weights=x) / n
    bins.calibrate(mean, pos, n - pos)
    assert np.allclose(rows.scale, bins.scale, atol=1e-3)
    p, q = t.sigmoid(x * rows.scale[0] + rows.scale[1]), t.sigmoid(mean * rows.scale[0] + rows.scale[1])
    assert abs(t.best_threshold(p, y, 1 - y) - t.best_threshold(q, pos, n - pos)) < 0.026


def test_sample_takes_toxic_and_clean_rows_separately():
    assert t.SAMPLE_ROWS >= 20_000
    assert t.sample_shares(100, 900, 2000) == (1.0, 1.0)
    assert t.sample_shares(100, 10_000, 1000) == (1.0, 0.09)  # rare toxic rows are all learned from
    assert t.sample_shares(10_000, 10_000, 1000) == (0.05, 0.05)
    assert t.sample_shares(10_000, 100, 1000) == (0.09, 1.0)


def test_sample_is_spread_over_the_whole_hash_range(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    assert abs(ids.filter(t._picked(0.25)).count() - 10_000) < 400
    assert ids.filter(t._picked(0.0)).count() == 0 and ids.filter(t._picked(1.0)).count() == 40_000
    assert spark.range(1).select(F.lit(1).alias("doc_id")).filter(t._picked(1e-12)).count() in (0, 1)


def test_every_rare_toxic_row_is_learned_from(spark, monkeypatch):
    docs, labels = _labelled(600)
    labels = [(i, 1, int(i % 50 == 0)) for i, _, _ in labels]  # 12 toxic rows
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    seen, inner = [], t.trained
    def spy(s, path, splits):
        seen.append(s.read.parquet(path).select("doc_id", "toxic").collect())
        return inner(s, path, splits)
    monkeypatch.setattr(t, "trained", spy)
    t.fit(data.documents(spark, docs), table, F.lit(False), sample_rows=100)
    assert {r.doc_id for r in seen[0] if r.toxic} == {i for i, _, y in labels if y}
    assert 60 <= len(seen[0]) <= 140


def _plain_logit(model, text):
    """The classifier by its definition, a word, window and filter at a time."""
    import re

    import numpy as np
    import pyarrow as pa

    words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    emb = [sum(model.table[r] for r in t.word_rows(pa.array([w.encode()], pa.binary()))[0]) for w in words]
    out = model.bias
    for i, k in enumerate(t.WIDTHS):
        for f in range(t.FILTERS):
            responses = [sum(float(np.dot(emb[at + j], model.conv[i][j, :, f])) for j in range(k)) for at in range(len(emb) - k + 1)]
            out += np.tanh(max(responses, default=0.0)) * model.out[i * t.FILTERS + f]
    return out


TEXTS = ["grobian du", "", "Ein Wort", "one", "a b c d e a b", "né 漢字 x1 a", "Grobian Grobian grobianer!", " - "]


def test_logits_are_those_of_plain_loops():
    import numpy as np
    import pyarrow as pa

    model = t.Model()
    model.table *= 50
    model.bias = 0.25
    got = model.raw(pa.array(TEXTS))
    assert np.allclose(got, [_plain_logit(model, x) for x in TEXTS], atol=1e-4)


def test_a_training_step_follows_the_gradient_of_plain_loops():
    import copy

    import numpy as np
    import pyarrow as pa

    y = np.array([1, 0, 0, 1, 0, 1, 1, 0], float)
    before = t.Model()
    before.table *= 50
    after = copy.deepcopy(before)
    square = {"table": np.full(after.table.shape[0], 1e-2, np.float32), "out": np.full(after.out.shape, 1e-2), "bias": 1e-2,
              "conv": [np.full(w.shape, 1e-2, np.float32) for w in after.conv]}
    after._step(t.c.split_words(pa.array(TEXTS), t.c.ALNUM, lower=True), y, square)

    def loss(model):
        p = t.sigmoid(np.array([_plain_logit(model, x) for x in TEXTS]))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    def slope(change, h=1e-3):
        up, down = copy.deepcopy(before), copy.deepcopy(before)
        change(up, h), change(down, -h)
        return (loss(up) - loss(down)) / (2 * h)

    def bias(m, h):
        m.bias += h

    def out(i):
        def change(m, h):
            m.out[i] += h
        return change

    def conv(i, j, d, f):
        def change(m, h):
            m.conv[i][j, d, f] += h
        return change

    def step(g):
        return -t.RATE * g / np.sqrt(1e-2 + g * g)

    assert np.isclose(after.bias - before.bias, step(slope(bias)), atol=1e-3)
    for i in (0, 7, 17):
        assert np.isclose(after.out[i] - before.out[i], step(slope(out(i))), atol=1e-3)
    for at in ((0, 0, 3, 1), (1, 1, 5, 2), (2, 2, 0, 4)):
        i, *rest = at
        assert np.isclose(after.conv[i][tuple(rest)] - before.conv[i][tuple(rest)], step(slope(conv(*at))), atol=2e-3)
