import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from labwire.llm import repair as r

SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies string, audit string"
WORDS = ["yes.", "no", "", " ", "so?", "ok!", "well", "\t\n", "end. ", "a.b"]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unit", "User"]


def conversations(seed=0, n=60):
    g = random.Random(seed)
    rows = []
    for conv in range(n):
        for t in range(g.choice([1, 2, 4, 8, 13])):
            turn = None if g.random() < 0.05 else t + (g.random() < 0.1) * 3
            rows.append((conv, turn, ["user", "assistant"][t % 2] if g.random() < 0.6 else g.choice(ROLES), None if g.random() < 0.05 else g.choice(WORDS)))
    rows += [(None, 0, "user", "hi."), (None, 1, "assistant", "hi"), (900, None, None, None), (901, 5, "system", "x."), rows[0], rows[0], rows[7]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "c", "a") for x in rows], SCHEMA).repartition(4)


def brute(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired turns)} by a plain DP over rows."""
    out = {}
    for conv in {x[0] for x in rows}:
        own = [(t, " " if role is None else role, " " if text is None else text) for cv, t, role, text in rows if cv == conv]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in own:
            ended = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        initials = [role[:1] for _, role, _ in own]
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        # ways: role initials so far -> (cost, audit, turns); only the last initial and "is empty" matter
        ways = {"": (0, "", ())}

        def offer(into, key, way):
            if key not in into or way[:2] < into[key][:2]:
                into[key] = way

        def inserted(ways):
            for _ in range(3):
                new = dict(ways)
                for last, (cost, audit, done) in ways.items():
                    role = "assistant" if last == "u" else "user"
                    offer(new, role[0], (cost + 3, audit + "I", done + ((role, ""),)))
                ways = new
            return ways

        for (_, role, text), fault in zip(own, faults):
            new = {}
            for last, (cost, audit, done) in inserted(ways).items():
                offer(new, last, (cost + 4, audit + "D", done))
                if fault in ("blank", "duplicate"):
                    continue
                more = 3 if fault else 0
                if role and (last, role[0]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    offer(new, role[0], (cost + more, audit + "K", done + ((role, text),)))
                other = "assistant" if last == "u" else "user"
                offer(new, other[0], (cost + 3 + more, audit + "R", done + ((other, text),)))
            ways = new
        cost, audit, done = min(v for k, v in inserted(ways).items() if k in ("", "a"))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit, done)
    return out


def check(spark, rows):
    turns = frame(spark, rows).select("conv_id", "turn", "role", "text")
    plans = r.plan(turns)
    got = {x.conv_id: tuple(x)[1:] for x in plans.collect()}
    turned = {}
    for x in r.repaired(turns, plans).collect():
        turned.setdefault(x.conv_id, []).append((x.position, x.role, x.text))
    want = brute(rows)
    assert got.keys() == want.keys()
    for conv, w in want.items():
        assert got[conv] == w[:-1], conv
        assert [(y, z) for _, y, z in sorted(turned.get(conv, []))] == list(w[-1])
        assert re.fullmatch("(s?(ua)+)?", "".join(y[:1] for y, _ in w[-1]))


@pytest.mark.parametrize("piece", [r.PIECE, 3])
def test_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(r, "PIECE", piece)
    monkeypatch.setattr(r, "LEAST_USES", 2)
    check(spark, conversations())


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(r, "PIECE", 50)
    rows = conversations(3, 8) + [(5000, t, ROLES[(t * 7) % 5], f"{t % 11}{'.' if t % 3 else ''}") for t in range(1500)] + [(5001, 1, "user", "same.")] * 300
    check(spark, rows)


def test_against_sql(spark, tmp_dir):
    rows = conversations(4, 150)
    frame(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_dir}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_dir}/conversations.parquet/*.parquet'")
    names = [d[0] for d in con.execute(r.ORACLE).description]
    want = con.fetchall()
    out = r.op11(spark, tmp_dir)
    assert out.columns == names
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)


def test_empty(spark):
    turns = frame(spark, []).select("conv_id", "turn", "role", "text")
    plans = r.plan(turns)
    assert plans.count() == 0 and r.repaired(turns, plans).count() == 0


def test_grammar_expands_to_the_input_and_shares_rules(spark):
    g = np.random.default_rng(0)
    codes = np.concatenate([np.tile([4, 8], 50), g.integers(0, 16, 200), np.full(77, 9)]).astype(np.uint8)
    own = np.repeat([0, 1, 2], [100, 200, 77])
    pieces = spark.createDataFrame([(bytearray(codes[own == k].tobytes()),) for k in range(3)], "codes binary")
    rules = r.learn(pieces)
    s, whose = r.compress(codes, own, rules)
    table = [[k] for k in range(r.TERMINALS)]
    for a, b in rules:
        table.append(table[a] + table[b])
    assert [x for k in s.tolist() for x in table[k]] == codes.tolist()
    assert (whose == 0).sum() <= 16 and len(s) < len(codes)
    # a rule's matrix is the product of its rows' matrices
    ms = r.matrices(rules)
    for k, (a, b) in enumerate(rules):
        plain = ms[table[r.TERMINALS + k][0]]
        for t in table[r.TERMINALS + k][1:]:
            plain = r.product(plain, ms[t])
        for x, y in zip(sum(plain, []), sum(ms[r.TERMINALS + k], [])):
            assert (x is None and y is None) or (x[0] == y[0] and r.spell(x[1]) == r.spell(y[1]))
