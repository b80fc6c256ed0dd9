import hashlib

from labwire.llm import chat
from tests.llm import data  # noqa: F401

TEXTS = ["hi", "", None, chat.PROBE, "\\l \\b [x] <s> \\", "a\nb", "漢字 😀", "<<\\\\[[", "x" * 50_000]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, position string"


def _turns():
    roles = ["user", "assistant", "system", None, "to\nol<s>"]
    out = [(c, t, roles[(c + t) % 5], TEXTS[(c * 3 + t) % len(TEXTS)]) for c in range(7) for t in range(c + 1)]
    out += [(None, 0, "user", "q"), (None, 1, "assistant", "r"), (50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, None, "user", "z")]
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def test_round_trip(spark):
    rows = _turns()
    out = {r.conv_id: r for r in chat.read_back(chat.prefix_targets(_frame(spark, rows))).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(out) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for *_, role, x in turns if role == "assistant")
        r = out[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for *_, a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_examples_end_in_their_reply(spark):
    output = chat.prefix_targets(_frame(spark, _turns())).cache()
    targets = output.filter("is_target")
    full = chat.render(output, targets).collect()
    assert len(full) == targets.count() == sum(r[2] == "assistant" for r in _turns())
    texts = {x or "" for x in TEXTS} | {"r", "a", "b"}
    for r in full:
        reply = r.example[r.loss_start:r.loss_end]
        for ch, code in chat.CODES[::-1]:
            reply = reply.replace(code, ch)
        assert reply in texts and r.example.endswith(chat.CLOSE) and r.loss_end == len(r.example) - len(chat.CLOSE)
        assert r.example.count(chat.OPEN) == r.position + 1  # control strings mark turns only


def _plain(role, text):
    def hide(x):
        for ch, code in chat.CODES:
            x = x.replace(ch, code)
        return x

    return chat.OPEN + hide(role or "").replace("\n", "\\n") + "\n" + hide(text or "") + chat.CLOSE


def test_examples_are_the_preceding_turns_and_the_reply(spark):
    rows = _turns()
    convs = {}
    for conv, t, role, text in rows:
        convs.setdefault(conv, []).append((t is not None, t or 0, role or "", text or ""))
    want = {}
    for conv, turns in convs.items():
        turns.sort()
        for i, (*_, role, text) in enumerate(turns):
            if role == "assistant":
                want[conv, i] = ("".join(_plain(r, x) for *_, r, x in turns[:i + 1]), len(_plain(role, text)))
    for chunk in (40, 60_000, chat.CHUNK_CHARS):  # several chunks with one turn and with many, and one chunk
        output = chat.prefix_targets(_frame(spark, rows), chunk).cache()
        full = {(r.conv_id, r.position): r for r in chat.render(output, output.filter("is_target")).collect()}
        assert {k: r.example for k, r in full.items()} == {k: x for k, (x, _) in want.items()}
        for k, r in full.items():
            assert r.loss_start == len(r.example) - want[k][1] + len(chat.OPEN + "assistant\n") and r.loss_end == len(r.example) - len(chat.CLOSE)
        assert output.filter("loss_start is not null").count() == len(want)  # one span an example
        back = {r.conv_id: r for r in chat.read_back(output).collect()}
        assert set(back) == set(convs)
        for conv, r in back.items():
            assert r.n_turns == len(convs[conv]) and r.formatted_chars == sum(len(_plain(a, b)) for *_, a, b in convs[conv])
            assert r.example_chars == sum(len(x) for (of, _), (x, _) in want.items() if of == conv)
            assert r.n_examples == sum(of == conv for of, _ in want)


def test_long_conversation_in_chunks(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"turn {t} " + "x" * (t % 7)) for t in range(300)]
    output = chat.prefix_targets(_frame(spark, rows), 200).cache()
    got = {r.position: r.example for r in chat.render(output, output.filter("is_target")).collect()}
    plain = [_plain(r, x) for *_, r, x in rows]
    assert got == {i: "".join(plain[:i + 1]) for i in range(1, 300, 2)}
    assert max(len(r.text) for r in output.collect()) < 200 + max(map(len, plain))


def test_empty(spark):
    assert chat.read_back(chat.prefix_targets(_frame(spark, []))).count() == 0
