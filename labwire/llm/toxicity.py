"""Convolutional toxicity classifier over hashed word embeddings.

A word's embedding is the sum of four hashed rows: the whole word and its
first 4, 5 and 6 bytes, so an unseen ending of a known stem keeps a known
part.  Filters of widths 1, 2 and 3 run over the words of the whole text;
each filter's largest response (max pooling) feeds one logistic output.
Everything is numpy: the model is trained in a task from a bounded sample of
labelled rows and scored in the map tasks; the driver holds no texts.

Training sample (bounds are parameters): about ``sample_rows`` labelled rows,
picked by a hash of the id, of texts up to ``sample_chars`` characters, never
from the held-out fold.  Of toxic and clean rows each up to half are taken,
and more where the others are fewer.  Only the weights are learned from it.
The sample is written once to the shared folder; one task for each model
reads it and writes the model there.

Calibration: every labelled row outside the held-out fold, of any length, is
scored by a model that did not learn from it: rows of the sample by one of
``SPLITS`` further models, each trained without its share of the sample, all
others by the model itself.  Counts by language, bin of the logit and label
give the Platt scale and, per language, the threshold with the best F1; a
language with fewer than ``min_toxic`` toxic rows uses the threshold of all
languages.  (With a share of the sample that leaves only one label, all rows
are scored by the model itself.)  Language picks the threshold only; it, the
labels, source and id are no inputs of a score.

Defined results: a null or empty text is scored like one without words; a
null label or a label without a document is ignored; a label given twice
counts as its highest value, and for each document row of its id (the sample
takes the least text of an id with several); without any
toxic label every score is 0.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm.bitpack import filesystem

SAMPLE_ROWS = 20_000
SAMPLE_CHARS = 20_000
CUTOFF = 0.3
MIN_TOXIC = 20

PARTS = (None, 4, 5, 6)  #: bytes of each word that are hashed; None: all
ROWS = 1 << 15  #: hashed rows for each part
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 6
EPOCHS = 8
BATCH = 256
RATE = 0.05
#: A row's starting log-odds count as if seen so often at the base rate too.
SHRINK = 5.0
GRID = np.linspace(0.1, 0.9, 33)
#: Models that score the training sample for the calibration.
SPLITS = 3
#: Bins of the calibration: so many for each unit of the logit, which is cut at +-LOGIT.
FINE, LOGIT = 64, 30


def word_rows(vocab: pa.Array) -> np.ndarray:
    """Row numbers (words x parts) in the embedding table."""
    out = np.empty((len(vocab), len(PARTS)), np.int64)
    for i, upto in enumerate(PARTS):
        out[:, i] = (c.byte_hashes(vocab, upto) % np.uint64(ROWS)).astype(np.int64) + i * ROWS
    return out


def responses(emb: np.ndarray, conv: list[np.ndarray], codes: np.ndarray, words: c.Words) -> list[tuple]:
    """For each width: (starts of windows, their texts, responses windows x filters)."""
    out = []
    text_of = words.text_of
    for k, w in zip(WIDTHS, conv):
        at = np.flatnonzero(c.inside(words, k))
        if not len(at):
            out.append((at, at, np.zeros((0, FILTERS), np.float32)))
            continue
        r = (emb @ w[0])[codes[at]]
        for j in range(1, k):
            r += (emb @ w[j])[codes[at + j]]
        out.append((at, text_of[at], r))
    return out


def pooled(parts: list[tuple], n: int) -> np.ndarray:
    """Largest response per text and filter; 0 where a text has no window."""
    out = np.zeros((n, FILTERS * len(WIDTHS)), np.float32)
    for i, (at, text, r) in enumerate(parts):
        if len(at):
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            out[text[first], i * FILTERS:(i + 1) * FILTERS] = np.maximum.reduceat(r, first, axis=0)
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Table, filters and output weights; small and of fixed size."""

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        self.table = (g.standard_normal((len(PARTS) * ROWS, DIM)) * 0.02).astype(np.float32)
        self.conv = [(g.standard_normal((k, DIM, FILTERS)) * 0.1).astype(np.float32) for k in WIDTHS]
        self.out = (g.standard_normal(FILTERS * len(WIDTHS)) * 0.1).astype(np.float32)
        self.bias = 0.0
        self.scale = (1.0, 0.0)  # Platt: probability = sigmoid(a * logit + b)

    def logits(self, words: c.Words) -> np.ndarray:
        emb = self.table[word_rows(words.vocab)].sum(1) if len(words.vocab) else np.zeros((0, DIM), np.float32)
        act = np.tanh(pooled(responses(emb, self.conv, words.codes, words), len(words.counts)))
        return act @ self.out + self.bias

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Logits of many texts, a batch at a time."""
        parts = [self.logits(c.split_words(texts.slice(i, BATCH), c.ALNUM, lower=True)) for i in range(0, len(texts), BATCH)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def scores(self, col) -> np.ndarray:
        a, b = self.scale
        return sigmoid(a * self.raw(col) + b)

    def start(self, texts: pa.Array, y: np.ndarray) -> None:
        """Start from each row's shrunk log-odds, one dimension for each part."""
        base = y.mean()
        n, pos = np.zeros(len(PARTS) * ROWS), np.zeros(len(PARTS) * ROWS)
        for i in range(0, len(y), BATCH):
            words = c.split_words(texts.slice(i, BATCH), c.ALNUM, lower=True)
            rows, text = word_rows(words.vocab)[words.codes], words.text_of
            for j in range(len(PARTS)):
                once = np.unique(text * len(n) + rows[:, j])  # a text counts once
                n += np.bincount(once % len(n), minlength=len(n))
                pos += np.bincount(once % len(n), weights=y[i + once // len(n)], minlength=len(n))
        p = np.clip((pos + SHRINK * base) / (n + SHRINK), 1e-3, 1 - 1e-3)
        odds = np.log(p / (1 - p)) - np.log(base / (1 - base))
        for i in range(len(PARTS)):
            self.table[i * ROWS:(i + 1) * ROWS, i] = odds[i * ROWS:(i + 1) * ROWS]
            self.conv[0][0, :, i] = 0
            self.conv[0][0, i, i] = 0.5
            self.out[i] = 1.0
        self.bias = float(np.log(base / (1 - base)))

    def train(self, texts: pa.Array, y: np.ndarray, seed: int = 7) -> None:
        self.start(texts, y)
        g = np.random.default_rng(seed)
        square = {"table": np.full(self.table.shape[0], 1e-2, np.float32), "out": np.full(self.out.shape, 1e-2), "bias": 1e-2,
                  "conv": [np.full(w.shape, 1e-2, np.float32) for w in self.conv]}
        for _ in range(EPOCHS):
            order = g.permutation(len(y))
            for i in range(0, len(y), BATCH):
                docs = np.sort(order[i:i + BATCH])
                self._step(c.split_words(texts.take(pa.array(docs)), c.ALNUM, lower=True), y[docs], square)

    def _step(self, words: c.Words, y: np.ndarray, square: dict) -> None:
        if not len(words.codes):
            return
        own, codes = word_rows(words.vocab), words.codes
        emb = self.table[own].sum(1)
        parts = responses(emb, self.conv, codes, words)
        top = pooled(parts, len(y))
        act = np.tanh(top)
        delta = ((sigmoid(act @ self.out + self.bias) - y) / len(y)).astype(np.float32)
        d_top = delta[:, None] * self.out[None, :] * (1 - act * act)
        d_emb = np.zeros_like(emb)
        for i, (at, text, r) in enumerate(parts):
            d_conv = np.zeros_like(self.conv[i])
            for f in range(FILTERS):
                if not len(at):
                    continue
                best = np.flatnonzero(r[:, f] == top[text, i * FILTERS + f])
                t, first = np.unique(text[best], return_index=True)  # the first of equal windows
                start, d = at[best[first]], d_top[t, i * FILTERS + f]
                for j in range(WIDTHS[i]):
                    code = codes[start + j]
                    d_conv[j, :, f] += emb[code].T @ d
                    np.add.at(d_emb, code, d[:, None] * self.conv[i][j, :, f][None, :])
            square["conv"][i] += d_conv**2
            self.conv[i] -= RATE * d_conv / np.sqrt(square["conv"][i])
        d_out = act.T @ delta
        square["out"] += d_out**2
        self.out -= (RATE * d_out / np.sqrt(square["out"])).astype(np.float32)
        square["bias"] += float(delta.sum()) ** 2
        self.bias -= RATE * float(delta.sum()) / np.sqrt(square["bias"])
        hot = np.flatnonzero(np.abs(d_emb).sum(1))
        if len(hot):
            grad = np.repeat(d_emb[hot], len(PARTS), axis=0)
            r, inv = np.unique(own[hot].ravel(), return_inverse=True)
            total = np.zeros((len(r), DIM), np.float32)
            np.add.at(total, inv, grad)
            square["table"][r] += (total**2).mean(1)
            self.table[r] -= RATE * total / np.sqrt(square["table"][r])[:, None]

    def calibrate(self, logit: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        """Platt scaling with smoothed targets, by Newton steps; ``pos`` and ``neg`` rows have the logit."""
        n1, n0 = pos.sum(), neg.sum()
        n, t = pos + neg, pos * (n1 + 1) / (n1 + 2) + neg / (n0 + 2)
        x = np.stack([logit, np.ones_like(logit)], 1).astype(float)
        w = np.array([1.0, 0.0])
        for _ in range(50):
            p = sigmoid(x @ w)
            h = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            step = np.linalg.solve(h, x.T @ (n * p - t) + 1e-3 * (w - [1.0, 0.0]))
            w -= np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-8:
                break
        if w[0] > 0:
            self.scale = (float(w[0]), float(w[1]))


def best_threshold(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """The grid value with the best F1; of equal ones the middle."""
    f1 = []
    for t in GRID:
        hit = score >= t
        f1.append(2 * pos[hit].sum() / max(1, (pos + neg)[hit].sum() + pos.sum()))
    best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
    return float(GRID[best[len(best) // 2]])


def counts(docs: DataFrame, lab: DataFrame, models: list[Model] | Stored, model) -> DataFrame:
    """(lang, bin, logit, pos, neg) of all rows of ``docs`` with a label; column
    ``model`` says which of ``models`` scores a row.  At most languages x bins rows."""
    key = F.xxhash64(F.col("doc_id").cast("string"))
    bits, log2 = c.bitmap(lab.select(key.alias("key")), "key")
    shared = docs.sparkSession.sparkContext.broadcast(models)  # of fixed size; only their path if stored
    labelled = docs.sparkSession.sparkContext.broadcast(bits)  # of bounded size: most other rows are not scored

    def run(batches):
        loaded = {}
        for whole in batches:
            whole = whole.filter(pa.array(c.in_bitmap(labelled.value, log2, whole.column("key").to_numpy().view(np.uint64))))
            for b in c.slices(whole, "text"):
                which, out = b.column("model").to_numpy(), np.zeros(b.num_rows)
                for k in np.unique(which):
                    at = np.flatnonzero(which == k)
                    if k not in loaded:
                        loaded[k] = shared.value[k]
                    out[at] = loaded[k].raw(b.column("text").take(pa.array(at)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), pa.array(out)], ["doc_id", "lang", "logit"])

    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), model.cast("int").alias("model"), "text", key.alias("key")).filter("doc_id is not null")
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, logit double"
    cut = F.greatest(F.least("logit", F.lit(float(LOGIT))), F.lit(-float(LOGIT)))
    return (
        rows.mapInArrow(c.task(run), ddl).join(lab, "doc_id")
        .groupBy("lang", F.floor(cut * FINE).cast("int").alias("bin"))
        .agg(F.avg(cut).alias("logit"), F.count_if(F.col("toxic") == 1).alias("pos"), F.count_if(F.col("toxic") != 1).alias("neg"))
    )


def sample_shares(toxic: int, clean: int, rows: int) -> tuple[float, float]:
    """Shares of the toxic and of the clean rows that make a sample of ``rows``."""
    take = min(toxic, max(rows // 2, rows - clean))
    return min(1.0, take / max(1, toxic)), min(1.0, (rows - take) / max(1, clean))


def _hash(seed: int):
    """Of the id, alike whatever its type in documents and labels."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))


def _picked(share: float):
    return _hash(0) < F.lit(int(share * 2**64) - 2**63) if share < 1 else F.lit(True)


class Stored:
    """Models in the shared folder; each is loaded where it is used, so the driver need not hold them all."""

    def __init__(self, path: str):
        self.path = path

    def __getitem__(self, k: int) -> Model:
        fs, at = filesystem(self.path)
        got = pq.read_table(at, filesystem=fs, use_threads=False, partitioning=None, filters=[("id", "=", int(k))])
        return pickle.loads(got.column("model")[0].as_py())


def trained(spark, path: str, splits: int) -> Stored:
    """``splits`` models, the k-th without the rows of split k, and last one of all rows; a task each."""

    def run(batches):
        for b in batches:
            for k in b.column("id").to_pylist():
                fs, at = filesystem(path)
                rows = pq.read_table(at, filesystem=fs, use_threads=False, partitioning=None)
                if k < splits:
                    rows = rows.filter(pc.not_equal(rows.column("split"), k))
                rows = rows.sort_by("doc_id")
                texts, y = rows.column("text").combine_chunks(), rows.column("toxic").to_numpy().astype(float)
                del rows
                model = Model()
                model.train(texts, y)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pickle.dumps(model)], pa.binary())], ["id", "model"])

    out = c.stage_dir(spark, "models")
    spark.range(0, splits + 1, 1, splits + 1).mapInArrow(c.task(run), "id bigint, model binary").write.parquet(out)
    return Stored(out)


def fit(docs: DataFrame, labels: DataFrame, held_out, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS,
        min_toxic: int = MIN_TOXIC) -> tuple[Model | None, dict]:
    """(model, thresholds by language; '' for all others) from labelled rows outside ``held_out``."""
    lab = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    shares = sample_shares(*lab.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first(), sample_rows)
    split = F.pmod(_hash(11), F.lit(SPLITS))
    pick = lab.filter(F.when(F.col("toxic") == 1, _picked(shares[0])).otherwise(_picked(shares[1])))  # at most about sample_rows rows
    path = c.stage_dir(docs.sparkSession, "sample")
    (docs.select("doc_id", "text").filter(F.length("text") <= sample_chars)
     .join(F.broadcast(pick), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # of several texts of an id the least
     .select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"), split.cast("int").alias("split"), "text").write.parquet(path))
    sums = docs.sparkSession.read.parquet(path).groupBy("split").agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).collect()
    have = {r[0]: np.array(r[1:]) for r in sums}  # toxic and clean rows of each split
    total = sum(have.values(), np.zeros(2, int))
    if not total.all():
        return None, {"": CUTOFF}
    splits, which = 0, F.lit(0)
    if all((total - have.get(k, 0)).all() for k in range(SPLITS)):
        splits, which = SPLITS, F.when(_picked(max(shares)), split).otherwise(SPLITS)
    models = trained(docs.sparkSession, path, splits)
    c.drop_staged(docs.sparkSession, path)
    got = counts(docs.filter(~held_out), lab, models, which).toArrow()
    c.tidy(docs.sparkSession)
    model = models[splits]
    c.drop_staged(docs.sparkSession, models.path)
    logit, pos, neg = (got.column(k).to_numpy() for k in ("logit", "pos", "neg"))
    model.calibrate(logit, pos, neg)
    a, b = model.scale
    p, lang = sigmoid(a * logit + b), np.array(got.column("lang").to_pylist())
    cuts = {"": best_threshold(p, pos, neg)}
    for k in np.unique(lang):
        own = lang == k
        if k and pos[own].sum() >= min_toxic:
            cuts[str(k)] = best_threshold(p[own], pos[own], neg[own])
    return model, cuts


def score(docs: DataFrame, model: Model | None, cuts: dict, keep: list[str]) -> DataFrame:
    """``keep`` of each row, score, the language's threshold and ``flagged``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: the table and the filters

    def run(batches):
        model = shared.value
        for whole in batches:
            for b in c.slices(whole, "__text"):
                s = model.scores(b.column("__text")) if model else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [pa.array(s.astype(np.float64))], keep + ["score"])

    kept = docs.select(*keep)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    out = docs.select(*keep, F.col("text").alias("__text")).mapInArrow(c.task(run), f"{ddl}, score double")
    by_lang = F.lit(cuts[""])
    for k, v in cuts.items():
        if k:
            by_lang = F.when(F.col("lang") == k, F.lit(v)).otherwise(by_lang)
    return out.withColumn("threshold", by_lang).withColumn("flagged", F.col("score") >= F.col("threshold"))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, keep: list[str] | None = None) -> DataFrame:
    """Scores every row of ``docs``; learns from labelled rows outside the held-out fold."""
    held = c.crc_mod("doc_id", folds) == fold
    model, cuts = fit(docs, labels, held)
    return score(docs, model, cuts, keep or ["doc_id", "lang"]).withColumn("held_out", held)


def op3(spark, sf_dir: str) -> DataFrame:
    out = classify(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"), "threshold", "flagged")
