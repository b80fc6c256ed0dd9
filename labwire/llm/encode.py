"""Token ids of whole texts by the ``tokenizers`` library, vectorised.

For a byte-level BPE without a normaliser a token never crosses the place
where a non-space character meets a following ASCII space: the pattern that
precedes the merges puts white space before a word, never after one, and looks
no further back.  So a slice of texts is cut there, each distinct chunk is
encoded once, and the ids of the texts are gathered from those of the chunks.
Chunks that begin with white space and end with an ordinary character are
encoded joined together; since tokens are lossless, their byte lengths give
each chunk's share.  A bounded cache keeps chunks that return in later slices.

A special token's string inside a text becomes its id, as in a plain encode (it
holds no space, so no cut falls inside it, and its length adds up like others).
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from labwire.llm import common as c

#: Chunks a worker keeps between slices.
CACHE = 250_000
#: Joined chunks are encoded in texts of about this many bytes.
TEXT = 1 << 15
#: Text bytes encoded at once.
SLICE = 2 << 20

_ALL = np.arange(256)
_SPACE = ~c.NOT_SPACE
_GRAPH = (_ALL >= 0x21) & (_ALL <= 0x7E)
_LATIN = _ALL == 0xC3  # U+00C0 to U+00FF: none is white space


def _cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the chunks of all texts."""
    n = len(data)
    solid = _GRAPH[data]
    solid[1:] |= _LATIN[data[:-1]] & (data[1:] >= 0x80)
    cut = np.zeros(n, bool)
    cut[1:] = _SPACE[data[1:]] & solid[:-1]
    cut[off[:-1][off[:-1] < n]] = True
    return np.flatnonzero(cut)


def gather(values: np.ndarray, off: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[off[k]:off[k+1]]`` for ``k`` in ``codes``, joined; and their bounds."""
    counts = off[codes + 1] - off[codes]
    bounds = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(counts, out=bounds[1:])
    return values[np.repeat(off[codes] - bounds[:-1], counts) + np.arange(bounds[-1])], bounds


class Encoder:
    """Encodes Arrow string columns; one for each Python worker (see :func:`encoder`)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        n = self.tok.get_vocab_size()
        self.vocab_size = n
        # one character of a byte-level token stands for one byte
        self.length = np.array([len(self.tok.id_to_token(i) or "") for i in range(n)], np.int64)
        self._reset()

    def _reset(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids, self.off, self.used = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, bool)

    def _joined(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, off = c.text_bytes(chunks)
        at, texts, raw = 0, [], data.tobytes()
        ends = [0]
        while at < len(chunks):
            to = min(len(chunks), max(at + 1, int(np.searchsorted(off, off[at] + TEXT))))
            texts.append(raw[off[at]:off[to]].decode())
            ends.append(to)
            at = to
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(g.ids, np.uint32) for g in got])
        bounds = np.zeros(len(chunks) + 1, np.int64)
        cum = np.cumsum(self.length[ids])
        bounds[1:] = np.searchsorted(cum, off[1:]) + 1
        if cum[-1] != off[-1] or not np.array_equal(cum[bounds[1:] - 1], off[1:]):
            raise ValueError("token lengths do not add up to the chunks; is this a byte-level BPE?")
        return ids, bounds

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of distinct chunks."""
        hit = pc.index_in(chunks, value_set=self.known).to_numpy(zero_copy_only=False) if len(self.known) else np.full(len(chunks), np.nan)
        hit = np.where(np.isnan(hit.astype(float)), -1, hit).astype(np.int64)
        self.used[hit[hit >= 0]] = True
        new = np.flatnonzero(hit < 0)
        if len(new):
            fresh = chunks.take(pa.array(new))
            data, off = c.text_bytes(fresh)
            last, before = data[off[1:] - 1], data[np.maximum(off[1:] - 2, 0)]
            plain = _SPACE[data[off[:-1]]] & (_GRAPH[last] | (_LATIN[before] & (last >= 0x80) & (np.diff(off) > 1)))
            parts, order = [], []
            rows = np.flatnonzero(plain)
            if len(rows):
                parts.append(self._joined(fresh.take(pa.array(rows))))
                order.append(rows)
            rows = np.flatnonzero(~plain)
            if len(rows):
                got = self.tok.encode_batch_fast([v.decode() for v in fresh.take(pa.array(rows)).to_pylist()], add_special_tokens=False)
                counts = np.array([len(g.ids) for g in got])
                parts.append((np.array([i for g in got for i in g.ids], np.uint32), np.concatenate([[0], np.cumsum(counts)])))
                order.append(rows)
            keep = self.used if len(self.known) + len(new) > CACHE else np.ones(len(self.known), bool)
            if len(self.known) + len(new) > CACHE:  # keep what came back since the last time
                if keep.sum() + len(new) > CACHE:
                    keep = np.zeros(len(self.known), bool)
            # everything this slice needs goes on; the rest only while it fits
            need = keep.copy()
            need[hit[hit >= 0]] = True
            old = np.flatnonzero(need)
            where = np.full(len(self.known), -1, np.int64)
            where[old] = np.arange(len(old))
            ids, off = gather(self.ids, self.off, old)
            new_ids = np.concatenate([ids] + [p[0] for p in parts])
            new_off = [off]
            for p in parts:
                new_off.append(new_off[-1][-1] + p[1][1:])
            perm = np.concatenate(order)
            hit[hit >= 0] = where[hit[hit >= 0]]
            hit[new[perm]] = len(old) + np.arange(len(perm))
            self.known = pa.concat_arrays([self.known.take(pa.array(old)), fresh.take(pa.array(perm))])
            self.ids, self.off = new_ids, np.concatenate(new_off)
            self.used = np.concatenate([np.zeros(len(old), bool) if len(old) < len(where) else self.used[old], np.zeros(len(perm), bool)])
        return gather(self.ids, self.off, hit)

    def encode(self, col) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint32, bounds of each text) of an Arrow string column."""
        data, off = c.text_bytes(col)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:  # not UTF-8: each text with its bad bytes replaced
            texts = [data[a:z].tobytes().decode(errors="replace") for a, z in zip(off[:-1], off[1:])]
            return self.encode(pa.array(texts, pa.string()))
        starts = _cuts(data, off)
        bounds = np.append(starts, len(data)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        ids, b = self._chunks(coded.dictionary)
        out, ends = gather(ids, b, coded.indices.to_numpy().astype(np.int64))
        return out, ends[np.searchsorted(starts, off)]

    def encode_with_end(self, col, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Like :meth:`encode`, with the id ``end`` after each text."""
        ids, bounds = self.encode(col)
        n = len(bounds) - 1
        return np.insert(ids, bounds[1:], np.uint32(end)), bounds + np.arange(n + 1)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.json")
