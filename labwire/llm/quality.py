"""Quality rules with risk-controlled cutoffs.

Each document gets integer counts and, from them, a fixed set of rule
statistics (``RULES``; a larger value is worse).  Every rule has a fixed grid
of ``BINS`` cutoffs, chosen before any label is seen.  A document is rejected
when a rule of its stratum (language) fires, so what is *certified* is the
union of a stratum's rules: of ``n`` good documents of the labelled holdout it
rejects ``k``, and the exact binomial (Clopper-Pearson) upper bound of that
rejection rate is at most ``alpha``.

The holdout is halved by a hash of the id.  One half proposes: of each rule
the cutoff with the largest ``bad - weight * good`` rejections among those
whose own bound holds there, the rules in the order of that gain, without
those that add none to the rules before them.  The other half, which took no
part in this, tests the unions of the first 1, 2, ... rules and stops at the
first that fails (a fixed sequence needs no further correction); the last
that held is used.  The error rate ``delta`` is divided by the number of
strata (Bonferroni).  So with probability ``1 - delta`` over the holdout, in no
stratum more than ``alpha`` of the good documents are rejected by its rules.

The counts of all labelled rows are used, in one half or the other (histograms
by stratum, rule and bin, and by stratum and rule); nothing is sampled.  Defined results: a null text has no words; a null
language is a stratum of its own, ''; documents of a stratum without labels
are judged by the base rule alone; a label given twice counts as its lowest
value; labels that are null or lack a document are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c

ALPHA = 0.01
DELTA = 0.05
#: Rejected good documents weigh this much against rejected bad ones.
WEIGHT = 25
BINS = 100
MIN_WORDS = 50

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_MARK = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct", "n_upper", "n_letters", "n_digits", "n_marks"]

_SHARE = "least(1.0D, {a} / greatest({b}, 1))"
#: Rule statistics in [0, 1]; a larger value is worse.
RULES = {
    "symbols_per_word": _SHARE.format(a="n_symbols", b="n_words"),
    "marks_per_word": _SHARE.format(a="n_marks", b="n_words"),
    "repeated_lines": _SHARE.format(a="n_dup_lines", b="n_lines"),
    "repeated_words": _SHARE.format(a="n_repeat_words", b="n_words"),
    "same_words": "1.0D - " + _SHARE.format(a="n_distinct", b="n_words"),
    "capitals": _SHARE.format(a="n_upper", b="n_letters"),
    "digits": _SHARE.format(a="n_digits", b="word_chars"),
    "no_letters": "1.0D - " + _SHARE.format(a="n_letters", b="greatest(word_chars, n_letters)"),
    "long_words": "least(1.0D, word_chars / greatest(n_words, 1) / 25)",
    "short_words": "1.0D - least(1.0D, word_chars / greatest(n_words, 1) / 25)",
}


def repeated_in_windows(words: c.Words) -> np.ndarray:
    """Marks words that lie in a 3-word window found twice or more in its text."""
    n = len(words.codes)
    out = np.zeros(n, bool)
    ok = c.inside(words, 3)
    if not ok.any():
        return out
    codes, v = words.codes, len(words.vocab)
    pair = pd.factorize(codes[:-2] * v + codes[1:-1])[0].astype(np.int64)  # exact: codes are dense
    at = np.flatnonzero(ok)
    triple = pd.factorize(pair[at] * v + codes[2:][at])[0].astype(np.int64)
    own = words.text_of[at] * (int(triple.max()) + 1) + triple
    at = at[pd.Series(own).duplicated(keep=False).to_numpy()]
    for j in range(3):
        out[at + j] = True
    return out


def text_counts(col) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text of an Arrow string column."""
    data, off = c.text_bytes(col)
    words = c.split_words(col, c.NOT_SPACE, lower=False)
    lines = c.split_words(col, c.NOT_NEWLINE, lower=False)
    n = len(off) - 1
    if len(lines.vocab):
        raw, loff = c.text_bytes(lines.vocab)
        wordy = c.per_text(c.NOT_SPACE[raw], loff) > 0
    else:
        wordy = np.zeros(0, bool)
    has = wordy[lines.codes]
    text, code = lines.text_of[has], lines.codes[has]
    first = ~pd.Series(text * max(1, len(lines.vocab)) + code).duplicated().to_numpy()
    n_lines = np.bincount(text, minlength=n)
    wdistinct = ~pd.Series(words.text_of * max(1, len(words.vocab)) + words.codes).duplicated().to_numpy()
    return {
        "n_words": words.counts,
        "word_chars": c.per_text(c.NOT_SPACE[data] & ((data & 0xC0) != 0x80), off),
        "n_symbols": c.per_text(_SYMBOL[data], off),
        "n_dup_lines": n_lines - np.bincount(text[first], minlength=n),
        "n_repeat_words": c.per_text(repeated_in_windows(words), words.bounds),
        "n_lines": n_lines,
        "n_distinct": c.per_text(wdistinct, words.bounds),
        "n_upper": c.per_text(_UPPER[data], off),
        "n_letters": c.per_text(_LETTER[data] & ((data & 0xC0) != 0x80), off),
        "n_digits": c.per_text(_DIGIT[data], off),
        "n_marks": c.per_text(_MARK[data], off),
    }


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (which has ``text``) with ``COUNTS`` (long)."""

    def run(batches):
        for whole in batches:
            for b in c.slices(whole, "__text"):
                got = text_counts(b.column("__text"))
                yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [pa.array(got[k].astype(np.int64)) for k in COUNTS], keep + COUNTS)

    kept = docs.select(*keep)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(c.task(run), f"{ddl}, " + ", ".join(f"{k} bigint" for k in COUNTS))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exactly summed in logarithms."""
    if p <= 0:
        return 1.0
    if p >= 1:
        return 1.0 if k >= n else 0.0
    i = np.arange(k + 1)
    lg = np.frompyfunc(math.lgamma, 1, 1)
    logs = (math.lgamma(n + 1) - lg(i + 1.0).astype(float) - lg(n - i + 1.0).astype(float) + i * math.log(p) + (n - i) * math.log1p(-p))
    return float(min(1.0, np.exp(logs).sum()))


def certified(k: int, n: int, alpha: float, delta: float) -> bool:
    """Whether the exact upper bound (confidence ``1 - delta``) of the rate behind
    ``k`` of ``n`` is at most ``alpha``: that is, P(X <= k | alpha) <= delta."""
    return n > 0 and k < n and k <= alpha * n and tail(k, n, alpha) <= delta


def choose(good: np.ndarray, bad: np.ndarray, n_good: int, alpha: float, delta: float, weight: float) -> int | None:
    """The cutoff bin of one (stratum, rule), or None.  ``good[b]`` and ``bad[b]``
    count labelled documents in bin ``b``; cutoff ``b`` rejects bins >= b."""
    kg, kb = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    best, gain = None, 0.0
    for b in range(len(good) - 1, 0, -1):  # loosest first; bin 0 always passes
        if not certified(int(kg[b]), n_good, alpha, delta):
            break
        g = float(kb[b] - weight * kg[b])
        if g > gain:
            best, gain = b, g
    return best


def thresholds(stats: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA,
               delta: float = DELTA, weight: float = WEIGHT, bins: int = BINS) -> DataFrame:
    """(stratum, cuts map<rule, bin>) from all labelled documents that pass the base rule.

    Equal texts (column ``__text_key``, else the id) are one trial of a stratum, good only if
    all their labels are, and lie in one half: the trials of a binomial bound are independent."""
    lab = (labels.filter("doc_id is not null and quality is not null")
           .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    s = F.coalesce(F.col(stratum), F.lit(""))
    key = F.col("__text_key") if "__text_key" in stats.columns else F.xxhash64(F.col("doc_id").cast("string"))
    trials = (
        stats.filter(~base_failed()).withColumn("stratum", s).join(lab, "doc_id")
        .select("stratum", "quality", key.alias("text"), *[_bin(e, bins).alias(f"b{i}") for i, e in enumerate(RULES.values())])
        .groupBy("stratum", "text", *[f"b{i}" for i in range(len(RULES))]).agg(F.min("quality").alias("quality"))
    )
    rows = c.staged(trials.select("stratum", "quality", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(2)).alias("half"),
                                  F.array(*[f"b{i}" for i in range(len(RULES))]).alias("bins")), "labelled")
    good, bad = F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")
    strata = max(1, rows.select("stratum").distinct().count())

    def pick(key, pdf):
        good, bad = np.zeros(bins), np.zeros(bins)
        good[pdf.bin], bad[pdf.bin] = pdf.good, pdf.bad
        b = choose(good, bad, int(good.sum()), alpha, delta / strata, weight)
        gain = 0.0 if b is None else float(bad[b:].sum() - weight * good[b:].sum())
        return pd.DataFrame({"stratum": [key[0]], "rule": [key[1]], "cut": pd.array([b], "Int32"), "loss": [-gain]})

    def staged_seq(df):
        return c.staged(df.select("stratum", "seq"), "proposed")  # a row for each stratum, of at most one entry for each rule

    def first(half, seq):
        """Labelled rows by the first rule of ``seq`` that fires (0: none)."""
        fires = F.transform("seq", lambda x: F.col("bins")[x["rule"]] >= x["cut"])
        return (rows.filter(F.col("half") == half).join(seq, "stratum")
                .groupBy("stratum", F.size("seq").alias("n"), F.array_position(fires, True).cast("int").alias("at")).agg(good, bad))

    hist = (rows.filter("half = 0").select("stratum", "quality", F.posexplode("bins").alias("rule", "bin"))
            .groupBy("stratum", "rule", "bin").agg(good, bad))  # at most strata x rules x bins rows
    picked = hist.groupBy("stratum", "rule").applyInPandas(pick, "stratum string, rule int, cut int, loss double").filter("cut is not null")
    seq = staged_seq(picked.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("loss", "rule", "cut"))).alias("seq")))
    adds = first(0, seq).filter((F.col("at") > 0) & (F.col("bad") > weight * F.col("good"))).groupBy("stratum").agg(F.collect_list("at").alias("adds"))
    seq = staged_seq(seq.join(adds, "stratum").withColumn("seq", F.filter("seq", lambda x, i: F.array_contains("adds", i + 1))))

    def test(key, pdf):
        k, total, held = np.zeros(int(pdf.n.iloc[0]) + 1), int(pdf.good.sum()), 0
        k[pdf["at"]] = pdf.good
        for i, lost in enumerate(np.cumsum(k[1:]), 1):
            if not certified(int(lost), total, alpha, delta / strata):
                break
            held = i
        return pd.DataFrame({"stratum": [key[0]], "held": [held]})

    held = first(1, seq).groupBy("stratum").applyInPandas(test, "stratum string, held int").filter("held > 0")
    name = F.array(*[F.lit(r) for r in RULES])
    return seq.join(held, "stratum").select("stratum", F.map_from_entries(
        F.transform(F.slice("seq", 1, F.col("held")), lambda x: F.struct(name[x["rule"]].alias("rule"), x["cut"].alias("cut")))).alias("cuts"))


def _bin(expr: str, bins: int):
    return F.least(F.floor(F.expr(expr) * bins).cast("int"), F.lit(bins - 1))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", bins: int = BINS, extra: list[str] = (), **risk) -> DataFrame:
    """One row per row of ``docs``: doc_id, columns ``extra``, the counts, base_failed, failed_rules, kept."""
    keep = list(dict.fromkeys(["doc_id", stratum, *extra]))
    stats = c.staged(measure(docs.withColumn("__text_key", F.xxhash64("text")), [*keep, "__text_key"]), "counts")
    cuts = thresholds(stats, labels, stratum, bins=bins, **risk)
    failed = F.filter(
        F.array(*[F.when(_bin(e, bins) >= F.col("cuts")[r], F.lit(r)) for r, e in RULES.items()]), lambda x: x.isNotNull())
    out = stats.withColumn("stratum", F.coalesce(F.col(stratum), F.lit(""))).join(cuts, "stratum", "left")
    out = out.withColumn("base_failed", base_failed()).withColumn("failed_rules", F.coalesce(failed, F.array().cast("array<string>")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cuts", "__text_key")


def op4(spark, sf_dir: str) -> DataFrame:
    out = judge(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")
