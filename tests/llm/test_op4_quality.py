import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np

from labwire.llm import quality as q
from tests.llm import data


def brute(t):
    t = t or ""
    w = data.words(t)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if data.words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_counts(spark):
    extra = [(900, "a b c\na b c\n \n \nx | y\na b c", "en", "s"), (901, "# É é\r\n# É é\r\n", "en", "s"), (902, "a a a a", "de", "s")]
    rows = data.rows() + extra
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = q.judge(data.documents(spark, rows), none).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in out)
    want = []
    for i, t, *_ in rows:
        b = brute(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((str(i), *b, failed, not failed))  # no labels: the base rule alone
    assert got == sorted(want)
    assert q.judge(data.empty(spark), none).count() == 0


def test_exact_binomial_tail():
    for k, n, p in ((0, 10, 0.1), (3, 50, 0.02), (7, 400, 0.01)):
        f = Fraction(p)
        exact = sum(math.comb(n, i) * f**i * (1 - f) ** (n - i) for i in range(k + 1))
        assert abs(q.tail(k, n, p) - float(exact)) < 1e-9
    assert not q.certified(0, 0, 0.01, 0.05)
    assert q.certified(0, 400, 0.01, 0.05) and not q.certified(0, 200, 0.01, 0.05)


def test_certified_cutoffs_keep_their_promise():
    rng, broken = np.random.default_rng(0), 0
    for _ in range(200):
        scores = rng.random(1500)  # cutoff b rejects a share 1 - b / 100 of good documents
        good = np.bincount((scores * 100).astype(int), minlength=100)
        b = q.choose(good, np.full(100, 50), len(scores), 0.05, 0.05, 0.0)
        broken += b is not None and 1 - b / 100 > 0.05 + 1e-9
    assert broken <= 0.05 * 200 + 6


def test_junk_is_rejected_and_good_documents_stay(spark):
    rows, labels = [], []
    for i in range(1600):
        bad = i % 4 == 0
        words = [f"word{(i * 31 + j * j) % 997}" + ("***" if bad else "") for j in range(60)]
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 0 if bad else 1, 0))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = q.judge(data.documents(spark, rows), table, alpha=0.02).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in out)


def test_the_union_of_rules_keeps_the_promise(spark):
    # good documents 0 .. 19,999: each of three rules fires on other 0.6 % of them, and on 300 bad ones of its own
    fires = "(id < 20000 and id % 500 in ({a}, {b}, {c})) or (id >= 20000 and id % 3 = {k})"
    on = {k: fires.format(a=3 * k, b=3 * k + 1, c=3 * k + 2, k=k) for k in range(3)}
    stats = spark.range(20_900).selectExpr(
        "id as doc_id", "'en' as lang", "100L as n_words", "500L as word_chars", f"if({on[0]}, 50L, 0L) as n_symbols", "0L as n_dup_lines",
        "0L as n_repeat_words", "1L as n_lines", "60L as n_distinct", f"if({on[1]}, 400L, 0L) as n_upper", "450L as n_letters", "0L as n_digits",
        f"if({on[2]}, 50L, 0L) as n_marks")
    labels = spark.range(20_900).selectExpr("id as doc_id", "if(id < 20000, 1, 0) as quality")
    cuts = q.thresholds(stats, labels, alpha=0.01, weight=0).collect()
    assert len(cuts) == 1 and len(cuts[0].cuts) == 1  # two rules would reject 1.2 % of the good documents, three 1.8 %


def test_copies_are_one_trial(spark):
    # one good text in 3,000 copies on which a rule fires, 500 good and 300 bad texts of which it does not fire on the good
    def rows(copies):
        return spark.range(copies + 900).selectExpr(
            "id as doc_id", "'en' as lang", f"if(id < {copies}, 1L, id) as __text_key", "100L as n_words", "500L as word_chars",
            f"if(id < {copies} or id >= {copies} + 600, 50L, 0L) as n_symbols", "0L as n_dup_lines", "0L as n_repeat_words", "1L as n_lines",
            "60L as n_distinct", "0L as n_upper", "450L as n_letters", "0L as n_digits", "0L as n_marks")

    def labels(copies):
        return spark.range(copies + 900).selectExpr("id as doc_id", f"if(id < {copies} + 600, 1, 0) as quality")

    one, many = (q.thresholds(rows(n), labels(n), alpha=0.05, weight=0).collect() for n in (1, 3000))
    assert [r.cuts for r in one] == [r.cuts for r in many] and one[0].cuts  # the copies change nothing
    # a text with both labels counts as bad
    mixed = spark.createDataFrame([(0, 1), (1, 0)], "doc_id bigint, quality int")
    assert q.thresholds(rows(2).filter("doc_id < 2"), mixed).count() == 0
