import random
import struct
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import fs as pafs

from labwire.llm import bitpack, encode, packing
from tests.llm import data

PATH = encode.default_path()
PIECES = list("ab É é\u0085  　\n\t\r\x0b\x0c\x1c'sdllre1٣²!?<|endoftext|>ß中") + ["<|endoftext|>", "'s", " 're", "  ", " a", " \n"]


@pytest.fixture(scope="module")
def enc():
    return encode.Encoder(PATH)


def ids_of(enc, text, end):
    return enc.tok.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("cache", [50, encode.CACHE])
def test_chunked_encoding_equals_the_library(enc, cache, monkeypatch):
    monkeypatch.setattr(encode, "CACHE", cache)
    e, r = encode.Encoder(PATH), random.Random(2)
    for _ in range(4):
        texts = ["".join(r.choice(PIECES) for _ in range(r.randrange(40))) for _ in range(1500)] + ["", None] + data.texts()
        ids, bounds = e.encode(pa.array(texts))
        for t, a, z in zip(texts, bounds[:-1], bounds[1:]):
            assert ids[a:z].tolist() == ids_of(enc, t, 0)[:-1], t


def test_packing_whole_and_unpadded(spark, enc):
    rows = data.rows()
    out = packing.pack(data.documents(spark), PATH, max_open=4).collect()
    fills, docs = {}, {}
    for r in out:
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    for f in fills.values():
        f.sort()
        assert [o for o, _ in f] == [sum(n for _, n in f[:i]) for i in range(len(f))]
        n = sum(n for _, n in f)
        assert n <= 1024 and n & (n - 1) == 0  # a power of two: no padding
    for i, t, *_ in rows:
        want = ids_of(enc, t, 0)
        mine = [r for r in docs[i] if r.doc_tokens == len(want)]
        for r in mine:
            assert bytes(r.ids) == np.array(want[r.start:r.start + r.length], "<u4").tobytes() or i is None or i == 3
    assert sum(r.length for r in out) == sum(len(ids_of(enc, t, 0)) for _, t, *_ in rows)
    assert packing.pack(data.empty(spark), PATH).count() == 0


def test_sum_of_squares_choice():
    r = random.Random(5)
    levels = packing.Levels(16, 10**6, lambda pieces: None)
    for _ in range(400):
        size = r.randrange(1, 16)
        n = levels.n.copy()

        def squares(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + size < 16:
                m[h + size] += 1
            return int((m**2).sum())

        options = [h for h in range(0, 16 - size + 1) if h == 0 or n[h]]
        h = levels.best_level(size)
        best = min(map(squares, options))
        assert h in options and squares(h) == best and h == max(x for x in options if squares(x) == best)
        levels.add((None, 0, size), size)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    r = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1000):
        ids = r.integers(0, 2**bits, n, dtype=np.uint64).astype(np.uint32)
        raw = bitpack.pack_bits(ids, bits)
        assert len(raw) == -(-n * bits // 8)
        assert np.array_equal(bitpack.unpack_bits(raw, n, bits), ids)
    assert [bitpack.id_bits(v) for v in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_random_access(tmp_path):
    r = np.random.default_rng(1)
    counts = r.integers(1, 40, 50)
    ids = r.integers(0, 5000, counts.sum()).astype(np.uint32)
    path = str(tmp_path / "x.bits")
    open(path, "wb").write(bitpack.encode_file([None] + list(range(49)), counts, ids, 13, block=64))
    f = bitpack.Reader(pafs.LocalFileSystem(), path)
    for _ in range(100):
        a, z = sorted(r.integers(0, len(ids) + 1, 2))
        assert np.array_equal(f.ids(int(a), int(z)), ids[a:z])
    assert f.doc_ids[0].as_py() is None and struct.unpack("<I", open(path, "rb").read()[8:12])[0] == 13


def test_files_in_order(spark, enc, monkeypatch):
    rows = [r for r in data.rows() if r[0] is not None and r != data.rows()[3]] + [data.rows()[3]]
    folder = tempfile.mkdtemp()
    out = {r.doc_id: r for r in bitpack.read_back(bitpack.write(data.documents(spark, rows), folder, PATH, file_ids=500), folder, 300).collect()}
    at = 0
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        want = ids_of(enc, t, 2)
        assert (out[i].start, out[i].n_tokens, out[i].ids_crc32) == (at, len(want), crc(want))
        at += len(want)
    folder = tempfile.mkdtemp()
    first = bitpack.read_back(bitpack.write(data.documents(spark), folder, PATH), folder)
    assert first.count() == len(data.rows()) and first.filter("doc_id is null").agg({"start": "min"}).first()[0] == 0
    folder = tempfile.mkdtemp()
    assert bitpack.read_back(bitpack.write(data.empty(spark), folder, PATH), folder).count() == 0


def test_rows_of_one_id_are_dealt_over_tasks(spark, enc):
    rows = [(7, f"text {i * 37 % 500:03d}", "en", "s") for i in range(500)] + [(7, None, "en", "s")]
    rows += [(None, f"none {i:03d}", "en", "s") for i in range(300)] + [(i, f"other {i}", "en", "s") for i in range(20)]
    folder = tempfile.mkdtemp()
    manifest = bitpack.write(data.documents(spark, rows), folder, PATH)
    docs = [r.n for r in manifest.groupBy("part").sum("n_docs").withColumnRenamed("sum(n_docs)", "n").collect()]
    assert sum(docs) == len(rows) and len(docs) == 3 and max(docs) < 400  # neither id is in one task alone
    got = sorted(bitpack.read_back(manifest, folder).collect(), key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [(r.doc_id, r.ids_crc32) for r in got] == [(i, crc(ids_of(enc, t, 2))) for i, t, *_ in want]


def test_special_tokens_are_those_of_a_plain_encode():
    from tokenizers import Tokenizer

    plain, e = Tokenizer.from_file(PATH), encode.Encoder(PATH)
    texts = ["<|endoftext|>", "a<|endoftext|> b", "a  <|endoftext|>b c", " <|endoftext|><|endoftext|>\n<|endoftext|> x", "a <|endoftext| > b", "é<|endoftext|>é"]
    ids, bounds = e.encode(pa.array(texts))
    for t, a, z in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:z].tolist() == plain.encode(t, add_special_tokens=False).ids, t
    assert (ids == plain.token_to_id("<|endoftext|>")).sum() == 7
