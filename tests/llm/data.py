"""Small tables with the awkward cases: nulls, empty, short and long texts, repeats, clashing columns."""

import random
import re

SPACE = re.compile("[ \t-\r]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, n_words string, score string, shard string"


def texts(seed=1, n=40):
    r = random.Random(seed)
    vocab = ["a", "the", "né", "Wort", "x1", "fin.", "ist", "der", "q|", "漢字", "el", "dos"] + [f"w{i}" for i in range(200)]
    base = [" ".join(r.choice(vocab) for _ in range(r.choice([3, 8, 30, 80, 200]))) for _ in range(n)]
    near = []
    for t in base[:12]:
        w = t.split()
        w[r.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    return base + near + base[:5]


def rows(seed=1):
    out = [(i, t, ["en", "de", None][i % 3], f"s{i % 4}" if i % 7 else None) for i, t in enumerate(texts(seed))]
    n = len(out)
    out += [(n, None, "en", "s0"), (n + 1, "", "en", None), (n + 2, " \n\t ", None, "s1"), (n + 3, "one two", "de", "s1"),
            (n + 4, "one  two", "de", "s2"), (n + 5, "word " * 30_000, "en", "s0"), (None, out[0][1], "en", "s0"), (None, None, None, None)]
    out.append(out[3])  # a row that repeats in full
    return out


def documents(spark, given=None):
    full = [(i, t, lang, src, len(t or ""), "k", "x", "0.5", "9") for i, t, lang, src in (rows() if given is None else given)]
    return spark.createDataFrame(full, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return [w for w in SPACE.split(t or "") if w]
