"""Hidden Markov language model: training by Baum-Welch, exact scoring by the
scaled forward recursion.

Tokens are lower-cased (A-Z) words and one end token a text.  A state emits a
class, the class a word: the end and each of the most frequent words are
classes of their own, every other word belongs to a class by the hash of its
last bytes, so a word never seen has a class too.  Inside a class ``g`` a known
word has ``(1 - u[g]) (c + 1) / M[g]`` with ``M[g]`` the sum of ``c + 1`` over the
class, and an unknown one ``u[g]``, the class's share of tokens that occur
once (Good-Turing).  So

    score = log10 P(classes) + sum of log10 P(word | class)

where P(classes) is the likelihood under the hidden Markov model.

*Counts.*  Word counts of the training texts are summed in each task, then
across tasks.  A bounded head of the most frequent words (``HEAD``) goes to
the tasks; rarer words, which by definition occur a few times, are joined.  So
no frequent word is ever a join key, and nothing broadcast grows with the
data.

*Training.*  Class sequences are written once.  Each round runs the forward
and backward recursions over all training texts (in segments of ``SEGMENT``
tokens that start anew), sums expected counts in each task, then across tasks
by (state, class) in Spark; only the sums, of fixed size, reach the driver.

*Scoring* is exact over whole texts: a text's first segment runs as a vector,
each later one as the product of its transfer matrices, and the parts are
multiplied in order; everything is scaled, so nothing underflows.

Words are known by 64-bit hashes.  Defined results: a null or empty text is
the end token; rows that repeat in full are scored each; without training
texts every word is unknown and the states are as they start.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c

STATES = 8
ROUNDS = 5
SEGMENT = 256
#: Words broadcast with their counts, words with a class of their own, classes by word ending.
HEAD, OWN, ENDINGS = 1 << 19, 1 << 10, 1 << 11
#: Segments worked on at once.
WIDE = 1024
PRIOR = 50.0
#: Hash that stands for the end token.
END = 0

_U = np.uint64


def ending_class(vocab: pa.Array) -> np.ndarray:
    """Class (0 .. ENDINGS - 1) of each word by its last three bytes."""
    data, off = c.text_bytes(vocab)
    h = np.zeros(len(off) - 1, _U)
    for i in (1, 2, 3):
        at = off[1:] - i
        h = h * _U(257) + np.where(at >= off[:-1], data[np.maximum(at, 0)].astype(_U) + _U(1), _U(0))
    return (c.mix(h) % _U(ENDINGS)).astype(np.int64)


def _word_codes(col) -> tuple[c.Words, np.ndarray, np.ndarray]:
    words = c.split_words(col, c.NOT_SPACE, lower=True)
    h = c.byte_hashes(words.vocab)
    return words, np.where(h == _U(END), _U(1), h), ending_class(words.vocab)


def count_words(docs: DataFrame) -> DataFrame:
    """(h, ending, n): the words of ``docs`` (column ``text``) and their counts; the end token has ending -1."""

    def run(batches):
        held, texts = [], 0

        def merged():
            h, e, n = (np.concatenate([x[i] for x in held]) for i in range(3))
            u, first, inv = np.unique(h, return_index=True, return_inverse=True)
            return u, e[first], np.bincount(inv, weights=n).astype(np.int64)

        def rows(h, e, n):
            for i in range(0, len(h), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[i:i + 50_000].view(np.int64)), pa.array(e[i:i + 50_000], pa.int32()), pa.array(n[i:i + 50_000])], ["h", "ending", "n"])

        for whole in batches:
            for b in c.slices(whole, "text"):
                words, h, e = _word_codes(b.column("text"))
                texts += b.num_rows
                if len(h):
                    held.append((h, e, np.bincount(words.codes, minlength=len(h))))
                if sum(len(x[0]) for x in held) > 1_500_000:
                    held = [merged()]
                    if len(held[0][0]) > 750_000:
                        yield from rows(*held[0])
                        held = []
        if held:
            yield from rows(*merged())
        if texts:
            yield from rows(np.array([END], _U), np.array([-1]), np.array([texts]))

    return docs.select("text").mapInArrow(c.task(run), "h bigint, ending int, n bigint").groupBy("h").agg(
        F.min("ending").alias("ending"), F.sum("n").alias("n"))


class Vocabulary:
    """What the tasks need of the counts: of fixed size."""

    def __init__(self, counts: DataFrame):
        level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
        words = counts.filter("ending >= 0").withColumn("level", level)
        total = counts.agg(F.sum("n"), F.count("*")).first()
        self.tokens, self.distinct = int(total[0] or 0), int(total[1])
        self.scale = self.tokens + self.distinct + 1
        end = counts.filter("ending < 0").agg(F.sum("n")).first()[0]
        self.end_count = int(end or 0)
        by_level = {r["level"]: r["n"] for r in words.groupBy("level").agg(F.count("*").alias("n")).collect()}  # a few hundred levels
        self.head_level, own_level = self._least(by_level, HEAD), self._least(by_level, OWN)
        head = words.filter(F.col("level") >= self.head_level).select("h", "ending", "n", "level").toArrow()  # at most HEAD rows
        h = head.column("h").to_numpy().view(_U)
        order = np.argsort(h)
        self.h, self.n = h[order], head.column("n").to_numpy()[order]
        ending = head.column("ending").to_numpy()[order].astype(np.int64)
        own = head.column("level").to_numpy()[order] >= own_level
        self.cls = np.where(own, np.cumsum(own), 0)  # 0: by ending
        self.first = 1 + int(own.sum())  # of the classes by ending
        self.classes = self.first + ENDINGS
        got = words.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("once")).collect()
        n, v, once = np.zeros(ENDINGS), np.zeros(ENDINGS), np.zeros(ENDINGS)
        for r in got:  # at most ENDINGS rows
            n[r["ending"]], v[r["ending"]], once[r["ending"]] = r["n"], r["v"], r["once"]
        np.subtract.at(n, ending[own], self.n[own])
        np.subtract.at(v, ending[own], 1)
        np.subtract.at(once, ending[own], self.n[own] == 1)
        self.mass = n + v
        self.unseen = np.clip((once + 0.5) / (n + 1), 1e-6, 0.9)
        seen = np.zeros(self.classes)
        seen[0], seen[self.cls[own]], seen[self.first:] = self.end_count, self.n[own], n
        self.share = (seen + 1) / (seen.sum() + self.classes)

    @staticmethod
    def _least(by_level: dict, most: int) -> int:
        """The lowest level from which on there are at most ``most`` words."""
        n, least = 0, max(by_level, default=0) + 1
        for level in sorted(by_level, reverse=True):
            n += by_level[level]
            if n > most:
                break
            least = level
        return least

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, own classes) of hashes; 0 where not in the head."""
        if not len(self.h):
            return np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        return np.where(hit, self.n[at], 0), np.where(hit, self.cls[at], 0)


TAIL = pa.struct([("h", pa.int64()), ("ending", pa.int32()), ("tf", pa.int64())])
PREPARED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_head bigint, base double, inner double, classes binary, "
            "tail array<struct<h:bigint,ending:int,tf:bigint>>")


def prepare(docs: DataFrame, vocabulary) -> DataFrame:
    """Per text: its class sequence, the sums over head words, and its other words."""

    def run(batches):
        v = vocabulary.value
        lg_mass = np.log10(np.maximum(v.mass, 1))
        lg_known = np.log10(1 - v.unseen)
        for whole in batches:
            for b in c.slices(whole, "text"):
                words, h, ending = _word_codes(b.column("text"))
                n, own = v.look_up(h)
                cls = np.where(own > 0, own, v.first + ending)
                lg = np.log10(n + 1.0)
                inner = np.where(own > 0, 0.0, lg_known[ending] + lg - lg_mass[ending])
                known = n > 0
                text, code = words.text_of, words.codes
                here = known[code]
                rows = b.num_rows
                n_head = np.bincount(text[here], minlength=rows)
                base = np.bincount(text[here], weights=lg[code[here]], minlength=rows)
                inner = np.bincount(text[here], weights=inner[code[here]], minlength=rows)
                # the rest, once a text and word
                rt, rc = text[~here], code[~here]
                key, tf = np.unique(rt * max(1, len(h)) + rc, return_counts=True)
                rt, rc = key // max(1, len(h)), key % max(1, len(h))
                tail = pa.StructArray.from_arrays(
                    [pa.array(h[rc].view(np.int64)), pa.array(ending[rc], pa.int32()), pa.array(tf.astype(np.int64))], fields=list(TAIL))
                seq = np.insert(cls[code], words.bounds[1:], 0).astype(np.uint16)  # class 0 ends each text
                off = np.zeros(rows + 1, np.int32)
                np.cumsum((words.counts + 1) * 2, out=off[1:])
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), b.column("held_out"), pa.array(words.counts + 1), pa.array(n_head + 1),
                    pa.array(base + math.log10(v.end_count + 1)), pa.array(inner),
                    pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(off), pa.py_buffer(seq)]),
                    c.lists(tail, np.bincount(rt, minlength=rows))], [f.split()[0] for f in PREPARED.split(", ")])

    return docs.mapInArrow(c.task(run), PREPARED)


class Hmm:
    """Start (K), transitions (K x K) and class emissions (classes x K)."""

    def __init__(self, share: np.ndarray, states: int = STATES, seed: int = 3):
        g = np.random.default_rng(seed)
        self.share = share
        self.start = np.full(states, 1 / states)
        self.move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        e = share[:, None] * np.exp(g.standard_normal((len(share), states)))
        self.emit = e / e.sum(0)

    def update(self, start, move, emit) -> None:
        self.start = (start + 1) / (start + 1).sum()
        self.move = (move + 1) / (move + 1).sum(1, keepdims=True)
        e = emit + PRIOR * self.share[:, None]
        self.emit = e / e.sum(0)


def segments(seq: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, texts) of runs of at most ``size`` tokens of each text."""
    n = np.diff(bounds)
    k = -(-n // size)
    text = np.repeat(np.arange(len(n)), k)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(k) - k, k)
    start = bounds[text] + nth * size
    return start, np.minimum(size, bounds[text + 1] - start), text


def expected(hmm: Hmm, seq: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple:
    """Expected counts (start, move, emit) and log likelihood over segments."""
    k = len(hmm.start)
    first, move, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros_like(hmm.emit), 0.0
    order = np.argsort(-length, kind="stable")
    for s in range(0, len(order), WIDE):
        rows = order[s:s + WIDE]
        st, ln = start[rows], length[rows]
        steps = int(ln[0])
        active = np.searchsorted(-ln, -np.arange(steps), side="left")  # segments longer than t
        alpha, scale, obs = [], [], []
        for t in range(steps):
            a = active[t]
            o = seq[st[:a] + t]
            e = hmm.emit[o]
            f = e * hmm.start if t == 0 else (alpha[-1][:a] @ hmm.move) * e
            z = f.sum(1)
            alpha.append(f / z[:, None])
            scale.append(z)
            obs.append(o)
            total += float(np.log(z).sum())
        beta = np.ones((0, k))
        for t in range(steps - 1, -1, -1):
            a = active[t]
            if t < steps - 1:
                n = active[t + 1]
                w = hmm.emit[obs[t + 1]] * beta / scale[t + 1][:, None]
                move += hmm.move * (alpha[t][:n].T @ w)
                beta = np.concatenate([w @ hmm.move.T, np.ones((a - n, k))])
            else:
                beta = np.ones((a, k))
            alpha[t] = alpha[t] * beta
        first += alpha[0].sum(0)
        gamma, flat = np.concatenate(alpha), np.concatenate(obs)
        for j in range(k):
            emit[:, j] += np.bincount(flat, weights=gamma[:, j], minlength=len(emit))
    return first, move, emit, total


def likelihood(hmm: Hmm, seq: np.ndarray, bounds: np.ndarray, size: int = SEGMENT) -> np.ndarray:
    """Natural log likelihood of each text, exact over all its tokens."""
    k = len(hmm.start)
    n_texts = len(bounds) - 1
    start, length, text = segments(seq, bounds, size)
    lead = np.r_[True, text[1:] != text[:-1]] if len(text) else np.zeros(0, bool)
    out = np.zeros(n_texts)
    state = np.zeros((n_texts, k))

    def forward(rows, begin, step, done):
        rows = rows[np.argsort(-length[rows], kind="stable")]
        for s in range(0, len(rows), WIDE):
            r = rows[s:s + WIDE]
            st, ln = start[r], length[r]
            steps = int(ln[0])
            active = np.searchsorted(-ln, -np.arange(steps), side="left")
            cur, log = begin(r), np.zeros(len(r))
            for t in range(steps):
                a = active[t]
                cur[:a] = step(cur[:a], hmm.emit[seq[st[:a] + t]], t)
                z = cur[:a].reshape(a, -1).sum(1)
                cur[:a] /= z.reshape((a,) + (1,) * (cur.ndim - 1))
                log[:a] += np.log(z)
            done(r, cur, log)

    def vector(r, cur, log):
        state[text[r]] = cur
        out[text[r]] += log

    forward(np.flatnonzero(lead), lambda r: np.tile(hmm.start, (len(r), 1)), lambda cur, e, t: (cur if t == 0 else cur @ hmm.move) * e, vector)
    later = np.flatnonzero(~lead)
    if len(later):
        product, logs = np.zeros((len(text), k, k)), np.zeros(len(text))

        def matrix(r, cur, log):
            product[r], logs[r] = cur, log

        forward(later, lambda r: np.tile(np.eye(k), (len(r), 1, 1)),
                lambda cur, e, t: (cur.reshape(-1, k) @ hmm.move).reshape(cur.shape) * e[:, None, :], matrix)
        nth = np.arange(len(text)) - np.maximum.accumulate(np.where(lead, np.arange(len(text)), 0))
        for j in range(1, int(nth.max()) + 1):  # texts' j-th segments, in order
            r = np.flatnonzero(nth == j)
            v = np.einsum("nk,nkl->nl", state[text[r]], product[r])
            z = v.sum(1)
            state[text[r]] = v / z[:, None]
            out[text[r]] += np.log(z) + logs[r]
    return out


def _sequences(col) -> tuple[np.ndarray, np.ndarray]:
    data, off = c.text_bytes(col)
    return np.frombuffer(data.tobytes(), np.uint16).astype(np.int64), off // 2


def train(prepared: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Hmm:
    """Baum-Welch over the rows of ``prepared`` (column ``classes``)."""
    spark = prepared.sparkSession
    hmm = Hmm(vocabulary.share, states)
    g = vocabulary.classes
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(hmm)  # of fixed size

        def run(batches):
            hmm = shared.value
            total = None
            for whole in batches:
                for b in c.slices(whole, "classes"):
                    seq, bounds = _sequences(b.column("classes"))
                    start, length, _ = segments(seq, bounds, SEGMENT)
                    got = expected(hmm, seq, start, length)
                    total = got if total is None else tuple(x + y for x, y in zip(total, got))
            if total is not None:
                flat = np.concatenate([total[0], total[1].ravel(), total[2].ravel()])
                at = np.flatnonzero(flat)
                for i in range(0, len(at), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(at[i:i + 10_000].astype(np.int32)), pa.array(flat[at[i:i + 10_000]])], ["at", "x"])

        sums = prepared.select("classes").mapInArrow(c.task(run), "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
        flat = np.zeros(states + states * states + g * states)  # as many rows at most reach the driver
        flat[sums.column("at").to_numpy()] = sums.column("x").to_numpy()
        hmm.update(flat[:states], flat[states:states + states**2].reshape(states, states), flat[states + states**2:].reshape(g, states))
        shared.unpersist()
    return hmm


def score(docs: DataFrame, held_out, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    counts = c.staged(count_words(rows.filter(~F.col("held_out"))), "words")
    vocabulary = Vocabulary(counts)
    shared = spark.sparkContext.broadcast(vocabulary)  # at most HEAD words
    prepared = c.staged(prepare(rows, shared).withColumn("rid", F.monotonically_increasing_id()), "classes")
    model = train(prepared.filter(~F.col("held_out")), vocabulary, states, rounds)
    hmm = spark.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for whole in batches:
            for b in c.slices(whole, "classes"):
                seq, bounds = _sequences(b.column("classes"))
                yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(likelihood(hmm.value, seq, bounds) / math.log(10))], ["rid", "states"])

    states_score = prepared.select("rid", "classes").mapInArrow(c.task(run), "rid bigint, states double")

    # the words outside the head: joined with their counts
    rare = counts.filter((F.col("ending") >= 0) & (F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int") < vocabulary.head_level)).select("h", "n")
    endings = spark.createDataFrame(
        [(i, math.log10(1 - u) - math.log10(max(m, 1)), math.log10(u)) for i, (u, m) in enumerate(zip(vocabulary.unseen.tolist(), vocabulary.mass.tolist()))],
        "ending int, known double, unknown double")
    tail = (
        prepared.select("rid", F.inline("tail")).join(rare, "h", "left").join(F.broadcast(endings), "ending")  # ENDINGS rows
        .groupBy("rid").agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("tf"))).alias("t_known"),
            F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("t_base"),
            F.sum(F.col("tf") * F.when(F.col("n").isNotNull(), F.col("known") + F.log10(F.col("n") + 1)).otherwise(F.col("unknown"))).alias("t_inner"))
    )
    zero = F.lit(0.0)
    known_end = 1 if vocabulary.end_count else 0  # the end token counts as known if any text was learned from
    return (
        prepared.select("rid", "doc_id", "held_out", "n_tokens", "n_head", "base", "inner")
        .join(states_score, "rid").join(tail, "rid", "left")
        .select("doc_id", "held_out", "n_tokens", (F.col("n_head") - 1 + known_end + F.coalesce("t_known", F.lit(0))).cast("bigint").alias("n_known"),
                F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
                (F.col("base") + F.coalesce("t_base", zero) - F.col("n_tokens") * math.log10(vocabulary.scale)).alias("base_score"),
                (F.col("states") + F.col("inner") + F.coalesce("t_inner", zero)).alias("score"))
    )


def op2(spark, sf_dir: str) -> DataFrame:
    return score(c.read(spark, sf_dir, "documents"), c.crc_mod("doc_id", 7) == 2)
