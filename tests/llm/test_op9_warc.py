import hashlib
import io
import tempfile
import zipfile

import pytest
from pyarrow import fs as pafs

from labwire.llm import warczip as w

PAGES = "page_id bigint, url string, html string, digest string, size string"


def _pages():
    long = "<p>é</p>" * 30
    out = [(i, f"http://h/{i}", long + str(i % 4)) for i in range(20)]
    return out + [(30, None, None), (31, "u", ""), (32, "u\r\nX-Page-ID: 7", "short"), (33, "u", "short"), (34, "u", "x" * 99), (35, "u", "x" * 99), (36, "u", "x" * 100), (37, "u", "x" * 100),
                  (None, "u", "x" * 100), (40, "u", "y" * 200), (40, "u", "y" * 200), (41, "u", "y" * 200), (42, "u", "z\r\n\r\n" * 50_000), (None, None, None)]


@pytest.mark.parametrize("zip64", [False, True])
def test_round_trip(spark, zip64):
    rows = _pages()
    folder = tempfile.mkdtemp()
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3)
    out = w.read_records(w.write(pages, folder, package_bytes=2000, zip64=zip64), folder).collect()
    first = {}
    for i, _, h in rows:
        n = len((h or "").encode())
        if n >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        refers = first[h] if h in first and first[h] != i else None
        want.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", str(refers), (raw if refers is None else b"")))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to), bytes(r.payload)) for r in out]
    assert sorted(got) == sorted(want)


def test_empty(spark):
    folder = tempfile.mkdtemp()
    assert w.read_records(w.write(spark.createDataFrame([], PAGES), folder), folder).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_directories(tmp_path, zip64):
    members = [("a", b"one"), ("dir/é", b""), ("b", b"PK\5\6" * 10)]
    raw = w.zip_stored(members, zip64)
    assert [(i.filename, zipfile.ZipFile(io.BytesIO(raw)).read(i)) for i in zipfile.ZipFile(io.BytesIO(raw)).infolist()] == members
    path = str(tmp_path / "x.zip")
    open(path, "wb").write(raw)
    p = w.Package(pafs.LocalFileSystem(), path)
    assert {k: p.read(*p.span(k)) for k in p.members} == dict(members)


def test_foreign_packages(tmp_path):
    path = str(tmp_path / "x.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("stored", b"abc")
        z.writestr(zipfile.ZipInfo("packed"), b"abc" * 99, zipfile.ZIP_DEFLATED)
        with z.open("wide", "w", force_zip64=True) as f:
            f.write(b"wide")
        z.comment = b"a comment with PK\5\6 inside" + b"." * 30
    p = w.Package(pafs.LocalFileSystem(), path)
    assert p.read(*p.span("stored")) == b"abc" and p.read(*p.span("wide")) == b"wide"
    with pytest.raises(ValueError, match="compressed"):
        p.span("packed")
    open(path, "wb").write(b"not a zip")
    with pytest.raises(ValueError, match="no end record"):
        w.Package(pafs.LocalFileSystem(), path)
