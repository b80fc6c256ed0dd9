"""Repair of conversation structure by a dynamic program over a Re-Pair grammar.

A conversation's rows, by turn, are a sequence of symbols: the initial of the
role (``s``, ``u``, ``a`` or another) and the row's first fault (blank,
duplicate of an earlier role and text, truncated, or none).  Edits make the
role initials ``(s?(ua)+)?`` at least cost: Keep 0, Rerole to user or assistant
3, Delete 4 (required for blank and duplicate rows), Insert an empty user or
assistant turn 3, and 3 more for a truncated row that stays.  The audit is the
edits' initials in order; of equal costs the ASCII-least audit counts.

1. *Symbols.*  Rows are reduced to (role, digest of the text, fault) and
   counted, so a row that repeats any number of times is one row.  A range sort
   over (conversation, turn, role, digest) makes pieces of at most ``PIECE``
   symbols; a conversation of any length is dealt over many tasks.
2. *Grammar.*  Re-Pair in rounds: all pieces count their adjacent symbol pairs,
   and the ``PER_ROUND`` most frequent pairs become rules; the next round counts
   pairs of what these rules leave.  One grammar serves all conversations.
3. *Matrices.*  The four states are: nothing yet, after ``s``, after a user,
   after an assistant.  Each symbol has a min-plus transfer matrix whose entries
   are (cost, audit rope); a rule's matrix is the product of its two sides,
   so it is worked out once, bottom-up, and shared.  A rope joins two ropes and
   is spelled out where costs tie.  (No audit between two states at equal cost
   begins another one, so the least rope stays least whatever follows.)
4. *Fold.*  A conversation is the product of a few rule matrices; equal
   compressed sequences are folded once a task.  Pieces of a long conversation
   are folded in order, with a state of four audits that share their beginnings.
5. *Repair.*  The audits are carried back to the rows, which are streamed in
   order; a task holds one audit, never a conversation's texts.

Defined results: a null role or text is one space; a null conversation id is a
conversation of its own; equal turns are ordered by role and the MD5 of the
text; a conversation without rows has zeros, an empty audit and no turns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c

USER, ASSISTANT = "user", "assistant"
#: Fixed costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Fixed: characters of blank texts, ends of whole ones.
SPACES, STOPS = " \t\n\v\f\r", ".!?"
FAULTS = ("none", "blank", "duplicate", "truncated")
INITIALS = "sua"  # and any other
TERMINALS = 4 * len(FAULTS)
#: Symbols in one piece of a conversation.
PIECE = 1 << 16
ROUNDS, PER_ROUND, LEAST_USES = 6, 24, 8
#: Folded sequences remembered by a task.
REMEMBERED = 100_000

START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}  # an inserted or reroled turn
KEEP = {("s", START): AFTER_S, ("u", START): AFTER_U, ("u", AFTER_S): AFTER_U, ("u", AFTER_A): AFTER_U, ("a", AFTER_U): AFTER_A}


# -- ropes and matrices -------------------------------------------------------

def spell(rope) -> str:
    """The text of a rope: a string, or a pair of ropes."""
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += [r[1], r[0]]
    return "".join(out)


def _better(a, b):
    """The cheaper of two (cost, rope), of equal costs the least audit; None is no way."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if spell(a[1]) <= spell(b[1]) else b


def product(a, b):
    """Min-plus product of two transfer matrices."""
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for q in range(4):
            for m in range(4):
                if a[p][m] is not None and b[m][q] is not None:
                    x, y = a[p][m], b[m][q]
                    out[p][q] = _better(out[p][q], (x[0] + y[0], (x[1], y[1]) if x[1] and y[1] else x[1] or y[1]))
    return out


def inserting():
    """Any number of inserted turns (two at most are ever cheapest)."""
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        q, way = p, (0, "")
        for _ in range(3):
            out[p][q] = _better(out[p][q], way)
            q, way = NEXT[q], (way[0] + INSERT, way[1] + "I")
    return out


def editing(code: int):
    """One row of the given symbol: kept, reroled or deleted."""
    initial, fault = (INITIALS + "?")[code // 4], FAULTS[code % 4]
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        out[p][p] = (DELETE, "D")
        if fault in ("none", "truncated"):
            more = TRUNCATED if fault == "truncated" else 0
            out[p][NEXT[p]] = _better(out[p][NEXT[p]], (REROLE + more, "R"))
            q = KEEP.get((initial, p))
            if q is not None:
                out[p][q] = _better(out[p][q], (more, "K"))
    return out


def matrices(rules: list[tuple[int, int]]) -> list:
    """The transfer matrix of every symbol: terminals (inserts, then the row), then rules bottom-up."""
    free = inserting()
    out = [product(free, editing(code)) for code in range(TERMINALS)]
    for a, b in rules:
        out.append(product(out[a], out[b]))
    return out


class Path:
    """An audit up to some row: the rope added last, after another path."""

    __slots__ = ("before", "rope", "length")

    def __init__(self, before, rope, length):
        self.before, self.rope, self.length = before, rope, length


def _less(x: Path, y: Path) -> bool:
    """Whether x's audit is less; only what follows their common beginning is spelled out."""
    a, b = [], []
    while x is not y:
        if x.length >= y.length:
            a.append(spell(x.rope))
            x = x.before
        else:
            b.append(spell(y.rope))
            y = y.before
    return "".join(reversed(a)) < "".join(reversed(b))


def _length(rope, known: dict) -> int:
    got = known.get(id(rope))
    if got is None:
        got = known[id(rope)] = len(spell(rope))
    return got


class Fold:
    """Least costs and audits from the start to each state, one symbol matrix at a time."""

    def __init__(self, table, lengths):
        self.table, self.lengths = table, lengths
        self.state = [(0, Path(None, "", 0)), None, None, None]

    def step(self, matrix) -> None:
        out = [None] * 4
        for q in range(4):
            best = None
            for p in range(4):
                way = matrix[p][q]
                if self.state[p] is None or way is None:
                    continue
                cost, path = self.state[p]
                new = (cost + way[0], Path(path, way[1], path.length + _length(way[1], self.lengths)) if way[1] else path)
                if best is None or new[0] < best[0] or (new[0] == best[0] and _less(new[1], best[1])):
                    best = new
            out[q] = best
        self.state = out

    def run(self, symbols) -> "Fold":
        for s in symbols:
            self.step(self.table[s])
        return self

    def result(self) -> tuple[int, str]:
        self.step(self.table[-1])
        ends = [x for x in (self.state[START], self.state[AFTER_A]) if x is not None]
        cost = min(x[0] for x in ends)
        return cost, min(self._text(x[1]) for x in ends if x[0] == cost)

    @staticmethod
    def _text(path: Path) -> str:
        out = []
        while path is not None:
            out.append(spell(path.rope))
            path = path.before
        return "".join(reversed(out))


# -- the grammar --------------------------------------------------------------

def _pairs(s: np.ndarray, own: np.ndarray, a: int, b: int) -> np.ndarray:
    """Where the pair starts, left to right without overlaps, inside one owner."""
    at = np.flatnonzero((s[:-1] == a) & (s[1:] == b) & (own[:-1] == own[1:]))
    if a == b and len(at):
        new = np.flatnonzero(np.r_[True, np.diff(at) > 1])
        at = at[(np.arange(len(at)) - np.repeat(new, np.diff(np.r_[new, len(at)]))) % 2 == 0]
    return at


def compress(codes: np.ndarray, own: np.ndarray, rules: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, their owners) after the rules, in their order."""
    s = codes.astype(np.int32)
    for k, (a, b) in enumerate(rules):
        at = _pairs(s, own, a, b)
        if len(at):
            s[at] = TERMINALS + k
            stay = np.ones(len(s), bool)
            stay[at + 1] = False
            s, own = s[stay], own[stay]
    return s, own


def _codes(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, off = c.text_bytes(b.column("codes"))
    return data, off, np.repeat(np.arange(b.num_rows), np.diff(off))


def learn(pieces: DataFrame) -> list[tuple[int, int]]:
    """Rules of pairs, in the order in which they apply; at most ROUNDS * PER_ROUND."""
    rules: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        known = list(rules)
        base = TERMINALS + len(known)

        def count(batches):
            total = np.zeros(base * base, np.int64)
            for b in batches:
                codes, _, own = _codes(b)
                s, own = compress(codes, own, known)
                if len(s) < 2:
                    continue
                same = s[:-1] == s[1:]
                inside = own[:-1] == own[1:]
                total += np.bincount(s[:-1][inside & ~same].astype(np.int64) * base + s[1:][inside & ~same], minlength=base * base)
                for a in np.unique(s[:-1][inside & same]).tolist():
                    total[a * base + a] += len(_pairs(s, own, a, a))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array((at // base).astype(np.int32)), pa.array((at % base).astype(np.int32)), pa.array(total[at])], ["a", "b", "n"])

        counted = pieces.select("codes").mapInArrow(c.task(count), "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = counted.filter(F.col("n") >= LEAST_USES).orderBy(F.desc("n"), "a", "b").limit(PER_ROUND).collect()
        if not top:
            break
        rules += [(r["a"], r["b"]) for r in top]
    return rules


# -- from rows to audits ------------------------------------------------------

def _rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls: one space), digest, fault of the text alone, copies."""
    n = F.col("copies") if "copies" in turns.columns else F.lit(1)
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    return turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), n.cast("bigint").alias("copies"),
    ).withColumn("digest", F.md5("text")).withColumn(
        "fault", F.when(ended == "", 1).when(F.right(ended, F.lit(1)).isin(*STOPS), 0).otherwise(3))


def symbols(rows: DataFrame) -> DataFrame:
    """One row per different row: conv_id, turn, role, digest, copies, the symbols of its
    first copy (``first``) and of the others (``rest``)."""
    key = ["conv_id", "turn", "role", "digest"]
    uniq = c.staged(rows.groupBy(*key, "fault").agg(F.sum("copies").alias("copies")), "repair-rows")
    earliest = uniq.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("x")).select(
        F.col("conv_id").alias("k1"), F.col("role").alias("k2"), F.col("digest").alias("k3"), F.col("x.turn").alias("k4"), F.lit(True).alias("new"))
    out = uniq.join(earliest, F.col("conv_id").eqNullSafe(F.col("k1")) & (F.col("role") == F.col("k2")) & (F.col("digest") == F.col("k3"))
                    & F.col("turn").eqNullSafe(F.col("k4")), "left")
    initial = F.substring("role", 1, 1)
    kind = 4 * F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    repeat = F.when(F.col("fault") == 1, 1).otherwise(2)
    return out.select(*key, "copies", (kind + F.when(F.col("new"), F.col("fault")).otherwise(repeat)).cast("int").alias("first"), (kind + repeat).cast("int").alias("rest"))


PIECES = "conv_id bigint, piece bigint, codes binary, lo bigint, hi bigint, n_turns bigint"


def cut(rows: DataFrame) -> DataFrame:
    """Pieces of conversations in order: their symbols (one byte each), least, most and number of turns."""
    names = [x.split()[0] for x in PIECES.split(", ")]
    order = ["conv_id", "turn", "role", "digest"]

    def run(batches):
        from pyspark import TaskContext

        piece = TaskContext.get().partitionId() << 40
        for whole in batches:
            n = np.cumsum(np.r_[0, whole.column("copies").to_numpy()])
            i = 0
            while i < whole.num_rows:
                j = max(i + 1, int(np.searchsorted(n, n[i] + PIECE, "right")) - 1)
                b = whole.slice(i, j - i)
                left = int(n[j] - n[i])
                if left > PIECE:  # one row, with more copies than a piece holds
                    first, rest, turn = (b.column(k)[0].as_py() for k in ("first", "rest", "turn"))
                    head = bytes([first])
                    while left:
                        size = min(left, PIECE)
                        codes = (head + bytes([rest]) * size)[:size]
                        yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array([piece]), pa.array([codes], pa.binary()), pa.array([turn], pa.int64()),
                                                          pa.array([turn], pa.int64()), pa.array([int(turn is not None)])], names)
                        piece, left, head = piece + 1, left - size, b""
                else:
                    yield pieces_of(b, piece)
                    piece += b.num_rows
                i = j

    def pieces_of(b, piece):
        copies = b.column("copies").to_numpy()
        codes = np.repeat(b.column("rest").to_numpy(), copies).astype(np.uint8)
        at = np.cumsum(copies) - copies
        codes[at] = b.column("first").to_numpy()
        conv, null = pc.fill_null(b.column("conv_id"), 0).to_numpy(), pc.is_null(b.column("conv_id")).to_numpy(zero_copy_only=False)
        turn, none = pc.fill_null(b.column("turn"), 0).to_numpy(), pc.is_null(b.column("turn")).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (null[1:] != null[:-1])])
        last = np.r_[new[1:], len(conv)] - 1
        change = ~none  # nulls come first
        change[1:] &= (turn[1:] != turn[:-1]) | none[:-1] | np.isin(np.arange(1, len(conv)), new)
        big = np.iinfo(np.int64)
        lo = np.minimum.reduceat(np.where(none, big.max, turn), new)
        hi = np.maximum.reduceat(np.where(none, big.min, turn), new)
        empty = none[last]
        off = np.r_[at[new], len(codes)].astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(off), pa.py_buffer(codes)])
        return pa.RecordBatch.from_arrays([b.column("conv_id").take(pa.array(new)), pa.array(piece + np.arange(len(new))), blobs, pa.array(lo, mask=empty),
                                           pa.array(hi, mask=empty), pa.array(np.add.reduceat(change.astype(np.int64), new))], names)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(c.task(run), PIECES)


PLANS = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def fold(pieces: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """One row per conversation that has rows (PLANS)."""
    names = [x.split()[0] for x in PLANS.split(", ")]
    kinds = [pa.string() if k == "audit" else pa.int64() for k in names]
    table = [*matrices(rules), inserting()]  # ropes stay alive with the closure
    legal = np.zeros((4, 4), bool)
    for x, y in ("su", "ua", "au"):
        legal[INITIALS.index(x), INITIALS.index(y)] = True

    def run(batches):
        lengths: dict = {}
        seen: dict[bytes, tuple[int, str]] = {}
        done: list[tuple] = []
        held = None  # the conversation that may go on: [conv, counts, lo, hi, n_turns, last code, symbols or Fold]

        def finish():
            conv, counts, lo, hi, n_turns, _, work = held
            if isinstance(work, Fold):
                cost, audit = work.result()
            else:
                key = work.tobytes()
                if key not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[key] = Fold(table, lengths).run(work.tolist()).result()
                cost, audit = seen[key]
            done.append((conv, 0 if lo is None else hi - lo + 1 - n_turns, *counts, cost, audit))

        for b in batches:
            codes, off, own = _codes(b)
            s, whose = compress(codes, own, rules)
            ends = np.searchsorted(whose, np.arange(b.num_rows + 1))
            faults = [c.per_text(codes % 4 == k, off) for k in (1, 2, 3)]
            bad = np.zeros(len(codes), bool)  # by the second row of each pair
            bad[1:] = ~legal[codes[:-1] // 4, codes[1:] // 4] & (own[:-1] == own[1:])
            counts = np.stack([*faults, c.per_text(bad, off)], 1).tolist()
            for i, (conv, lo, hi, n) in enumerate(zip(*(b.column(k).to_pylist() for k in ("conv_id", "lo", "hi", "n_turns")))):
                part = s[ends[i]:ends[i + 1]]
                first, last = int(codes[off[i]]), int(codes[off[i + 1] - 1])
                if held is not None and held[0] == conv:
                    if not isinstance(held[6], Fold):
                        held[6] = Fold(table, lengths).run(held[6].tolist())
                    held[6].run(part.tolist())
                    held[1] = [x + y for x, y in zip(held[1], counts[i])]
                    held[1][3] += not legal[held[5] // 4, first // 4]
                    if lo is not None:
                        held[4] += n - (held[3] == lo)
                        held[2], held[3] = lo if held[2] is None else held[2], hi
                    held[5] = last
                    continue
                if held is not None:
                    finish()
                held = [conv, counts[i], lo, hi, n, last, part]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names)
                done.clear()
        if held is not None:
            finish()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(c.task(run), PLANS)


def plan(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation (of ``ids``, else of ``turns``): gaps, faults, illegal
    neighbours, least cost and audit."""
    rows = _rows(turns)
    pieces = c.staged(cut(symbols(rows)), "repair-pieces")
    plans = fold(pieces, learn(pieces))
    every = (ids if ids is not None else rows).select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    out = every.join(plans, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(x, F.lit(0)).cast("bigint").alias(x) for x in PLANS.replace(",", "").split()[2:-2:2]],
                      F.coalesce("audit", F.lit("")).alias("audit"))


REPAIRED = "conv_id bigint, position bigint, edit string, role string, text string"


def repaired(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The turns after the audits: conv_id, position, edit (K, R or I), role, text.  Rows
    of a conversation come together and in order."""
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    none = F.lit(None)
    heads = plans.select("conv_id", F.lit(0).alias("tag"), none.cast("bigint").alias("turn"), none.cast("string").alias("role"),
                         none.cast("string").alias("digest"), none.cast("string").alias("text"), F.lit(0).cast("bigint").alias("copies"), "audit")
    rows = _rows(turns).select("conv_id", F.lit(1).alias("tag"), "turn", "role", "digest", "text", "copies", none.cast("string").alias("audit"))
    stream = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "tag", "turn", "role", "digest")

    def run(batches):
        conv, audit, at, position, state = None, "", 0, 0, START
        out: list[tuple] = []
        size = 0

        def put(edit, role, text, after):
            nonlocal position, state, size
            out.append((conv, position, edit, role, text))
            position, state, size = position + 1, after, size + len(text)

        def insert():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                put("I", ASSISTANT if state == AFTER_U else USER, "", NEXT[state])

        def flush():
            nonlocal size
            size = 0
            got = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)
            out.clear()
            return got

        for b in batches:
            for this, tag, role, text, copies, ops in zip(*(b.column(k).to_pylist() for k in ("conv_id", "tag", "role", "text", "copies", "audit"))):
                if tag == 0:
                    insert()
                    conv, audit, at, position, state = this, ops, 0, 0, START
                    continue
                for _ in range(copies):
                    insert()
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        put("K", role, text, KEEP[role[:1], state])
                    elif edit == "R":
                        put("R", ASSISTANT if state == AFTER_U else USER, text, NEXT[state])
                if size > c.SLICE_BYTES:
                    yield flush()
            if out:
                yield flush()
        insert()
        if out:
            yield flush()

    cols = [x for x in stream.columns if x not in ("turn", "digest")]
    return stream.select(*cols).mapInArrow(c.task(run), REPAIRED)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the ``role:text`` lines of :func:`repaired`'s rows, as they come."""
    def run(batches):
        now, sha = None, None
        for b in batches:
            done = []
            for conv, position, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "position", "role", "text"))):
                if position == 0:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    sha.update(f"\n{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], ["of", "repaired_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([sha.hexdigest()])], ["of", "repaired_sha256"])

    return turns.mapInArrow(c.task(run), "of bigint, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The rows after the stated damage, with ``copies``."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind, text = F.col("kind"), F.coalesce("text", blank)
    return turns.withColumn("kind", (F.crc32(key.cast("binary")) % 20).cast("int")).filter("kind <> 0").select(
        "conv_id", "turn", F.when(kind == 4, USER).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"))


def op11(spark, sf_dir: str) -> DataFrame:
    turns = c.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(turns)
    plans = c.staged(plan(rows, turns), "repair-plans")
    found = digests(repaired(rows, plans))
    return plans.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        *plans.columns, F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _oracle() -> str:
    """The same result by a recursive query over rows, without grammar or matrices."""
    step = []  # (state, inserts before, edit, initial needed, next state, cost, audit, inserted lines)
    for state in range(4):
        now, lines = state, ""
        for k in range(3):
            for edit, initial, after, cost in [("D", "", now, DELETE), ("R", "", NEXT[now], REROLE)] + [
                    ("K", i, q, 0) for (i, p), q in KEEP.items() if p == now]:
                role = {"R": ASSISTANT if now == AFTER_U else USER}.get(edit, "")
                step.append(f"({state},'{edit}','{initial}',{after},{cost + INSERT * k},'{'I' * k}{edit}','{lines}','{role}')")
            lines += f"{ASSISTANT if now == AFTER_U else USER}:|"
            now = NEXT[now]
    spaces = " || ".join(f"chr({ord(x)})" for x in SPACES)
    crc = ("4294967295 - list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split({s}, '')]), lambda r, b: "
           "list_reduce(list_prepend(xor(r, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda d, e: xor(d >> 1, 3988292384::BIGINT * (d & 1))))")
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    ({crc.format(s="coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}) % 20 AS kind FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN '{USER}' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '{STOPS}', '') ELSE text END AS text
  FROM k, LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))) AS x),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS same, rtrim(text, {spaces}) AS ended
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d)),
f AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS ini, left(coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY i), ''), 1) || left(role, 1) AS pair,
    CASE WHEN ended = '' THEN 1 WHEN same > 1 THEN 2 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM o),
s(p, edit, need, q, cost, aud, pre, new_role) AS (VALUES {", ".join(step)}),
t(conv_id, i, p, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'aud': '', 'txt': ''}} FROM conversations
  UNION ALL
  SELECT t.conv_id, t.i + 1, s.q, min({{
    'cost': t.best.cost + s.cost + CASE WHEN s.edit <> 'D' AND f.fault = 3 THEN {TRUNCATED} ELSE 0 END,
    'aud': t.best.aud || s.aud,
    'txt': t.best.txt || replace(s.pre, '|', chr(10)) || CASE s.edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10) ELSE s.new_role || ':' || f.text || chr(10) END}})
  FROM t JOIN f ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = t.i + 1
    JOIN s ON s.p = t.p AND (s.edit = 'D' OR f.fault IN (0, 3)) AND (s.edit <> 'K' OR s.need = f.ini)
  GROUP BY t.conv_id, t.i, s.q),
n AS (SELECT conv_id, max(i) AS n FROM t GROUP BY conv_id),
e AS (
  SELECT t.conv_id, min({{'cost': t.best.cost + CASE t.p WHEN 1 THEN {2 * INSERT} WHEN 2 THEN {INSERT} ELSE 0 END,
    'aud': t.best.aud || CASE t.p WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'txt': t.best.txt || CASE t.p WHEN 1 THEN '{USER}:' || chr(10) || '{ASSISTANT}:' || chr(10) WHEN 2 THEN '{ASSISTANT}:' || chr(10) ELSE '' END}}) AS best
  FROM t JOIN n ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.i = n.n GROUP BY t.conv_id),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, e.best.cost AS cost, e.best.aud AS audit,
  sha256(CASE WHEN e.best.txt = '' THEN '' ELSE left(e.best.txt, length(e.best.txt) - 1) END) AS repaired_sha256
FROM e LEFT JOIN c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE = _oracle()
