"""WARC records in ZIP packages, read by range.

A package is a ZIP file with stored (uncompressed) members: an archive of
WARC 1.1 records, each a gzip member of its own, and an index with one line per record (offset and length in
the archive, page id).  The reader parses the end record, the ZIP64 locator
and end record where fields overflow, the central directory with its ZIP64
extras, and each member's local header; then records are read by byte range
through the file system.  Nothing is extracted.

Records with equal payloads of at least ``MIN_REVISIT`` bytes: the one with
the smallest page id is the response, the others are revisits without a
payload block (digest and length in their headers).  Payload digests are
aggregated before the join; a payload shared by many pages is one skewed key,
which adaptive execution splits.

Packages hold about ``PACKAGE_BYTES``; they are written under a name of their
own and renamed when complete, so a task that runs again leaves one file.

Defined results: a null html is an empty payload; a null url is left out;
several rows with the smallest page id are all responses; a null page id
never serves as response for others, and revisits like any other row.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm.bitpack import filesystem

MIN_REVISIT = 100
PACKAGE_BYTES = 32 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes of neighbouring records that are read at once.
READ_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

LOCAL = struct.Struct("<4sHHHHHIIIHH")
CENTRAL = struct.Struct("<4sHHHHHHIIIHHHHHII")
END = struct.Struct("<4sHHHHIIH")
END64 = struct.Struct("<4sQHHIIQQQQ")
LOCATOR = struct.Struct("<4sIQI")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ``zip64`` writes the wide fields even where not needed."""
    out, central = [], []
    at = 0
    for name, data in members:
        raw = name.encode()
        crc, n = zlib.crc32(data), len(data)
        wide = zip64 or n >= FULL32 or at >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, n, n) if wide else b""
        small = FULL32 if wide else n
        out += [LOCAL.pack(b"PK\3\4", 45 if wide else 20, 0x800, 0, 0, 0x21, crc, small, small, len(raw), len(extra)), raw, extra, data]
        more = struct.pack("<HHQQQ", 1, 24, n, n, at) if wide else b""
        central.append(CENTRAL.pack(b"PK\1\2", 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, small, small, len(raw), len(more), 0, 0, 0, 0,
                                    FULL32 if wide else at) + raw + more)
        at += LOCAL.size + len(raw) + len(extra) + n
    directory = b"".join(central)
    wide = zip64 or at + len(directory) >= FULL32 or len(members) >= FULL16
    tail = b""
    if wide:
        tail = END64.pack(b"PK\6\6", END64.size - 12, 45, 45, 0, 0, len(members), len(members), len(directory), at)
        tail += LOCATOR.pack(b"PK\6\7", 0, at + len(directory), 1)
    end = END.pack(b"PK\5\6", 0, 0, *([FULL16] * 2 if wide else [len(members)] * 2), *([FULL32] * 2 if wide else [len(directory), at]), 0)
    return b"".join(out) + directory + tail + end


class Package:
    """Members of a ZIP file by byte range."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.path, self.file = path, fs.open_input_file(path)
        self.size = self.file.size()
        self.members = self._directory()

    def read(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def _end(self) -> tuple[int, int, int]:
        """(entries, directory bytes, directory offset)."""
        n = min(self.size, END.size + FULL16)
        base, tail = self.size - n, self.read(self.size - n, n)
        at = tail.rfind(b"PK\5\6")
        while at >= 0:  # the comment must end where the file does
            if at + END.size <= n and at + END.size + END.unpack_from(tail, at)[7] == n:
                break
            at = tail.rfind(b"PK\5\6", 0, at)
        if at < 0:
            raise ValueError(f"{self.path}: no end record, not a ZIP file")
        _, _, _, _, entries, length, offset, _ = END.unpack_from(tail, at)
        if entries == FULL16 or length == FULL32 or offset == FULL32:
            where = base + at - LOCATOR.size
            if where >= 0:
                sign, _, end64, _ = LOCATOR.unpack(self.read(where, LOCATOR.size))
                if sign == b"PK\6\7":
                    got = END64.unpack(self.read(end64, END64.size))
                    if got[0] != b"PK\6\6":
                        raise ValueError(f"{self.path}: broken ZIP64 end record")
                    _, _, _, _, _, _, _, entries, length, offset = got
        return entries, length, offset

    def _directory(self) -> dict[str, tuple[int, int, int]]:
        """name -> (method, bytes, offset of the local header)."""
        entries, length, offset = self._end()
        raw, at, out = self.read(offset, length), 0, {}
        for _ in range(entries):
            got = CENTRAL.unpack_from(raw, at)
            if got[0] != b"PK\1\2":
                raise ValueError(f"{self.path}: broken central directory")
            method, packed, full, begin = got[4], got[8], got[9], got[16]
            n, m, k = got[10], got[11], got[12]
            name = raw[at + CENTRAL.size:at + CENTRAL.size + n].decode()
            extra = raw[at + CENTRAL.size + n:at + CENTRAL.size + n + m]
            e = 0
            while e + 4 <= len(extra):
                kind, size = struct.unpack_from("<HH", extra, e)
                if kind == 1:  # only the overflowing fields are present, in this order
                    p = e + 4
                    if full == FULL32:
                        full, p = struct.unpack_from("<Q", extra, p)[0], p + 8
                    if packed == FULL32:
                        packed, p = struct.unpack_from("<Q", extra, p)[0], p + 8
                    if begin == FULL32:
                        begin = struct.unpack_from("<Q", extra, p)[0]
                e += 4 + size
            out[name] = (method, packed, begin)
            at += CENTRAL.size + n + m + k
        return out

    def span(self, name: str) -> tuple[int, int]:
        """(offset, bytes) of a stored member's data in the file."""
        method, size, begin = self.members[name]
        if method != 0:
            raise ValueError(f"{self.path}: {name} is compressed; only stored members can be read by range")
        head = LOCAL.unpack(self.read(begin, LOCAL.size))
        if head[0] != b"PK\3\4":
            raise ValueError(f"{self.path}: broken local header of {name}")
        return begin + LOCAL.size + head[9] + head[10], size

    def close(self):
        self.file.close()


def record(page_id, url, payload: bytes, digest: str, refers_to, size: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict, bytes]:
    """(headers by lower-case name, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("WARC record of another length than it says")
    return fields, rest[:n]


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, size, refers_to (null for responses)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn(
        "size", F.octet_length("html").cast("bigint"))
    first = (rows.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1 and first is not null").select("digest", "first"))
    return rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Writes the packages below ``folder``; returns their manifest (path, records)."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        records, index, at, file = [], [], 0, 0

        def flush():
            nonlocal records, index, at, file
            path, own = f"{root}/part-{part:06d}-{file:04d}.wacz", f"{root}/.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(own) as out:
                out.write(zip_stored([(ARCHIVE, b"".join(records)), (INDEX, "".join(index).encode())], zip64))
            fs.move(own, path)
            row = pa.RecordBatch.from_pylist([{"path": path, "records": len(index)}])
            records, index, at, file = [], [], 0, file + 1
            return row

        for b in batches:
            for r in b.to_pylist():
                payload = b"" if r["refers_to"] is not None else r["html"].encode()
                raw = gzip.compress(record(r["page_id"], r["url"], payload, r["digest"], r["refers_to"], r["size"]), 6, mtime=0)
                records.append(raw)
                index.append(json.dumps({"offset": at, "length": len(raw), "page_id": r["page_id"]}) + "\n")
                at += len(raw)
                if at >= package_bytes:
                    yield flush()
        if index:
            yield flush()

    return c.staged(with_references(pages).select("page_id", "url", "html", "digest", "size", "refers_to")
                    .mapInArrow(c.task(run), "path string, records bigint"), "packages")


def records_of(package: Package):
    """(headers, payload) of each record, by its index line."""
    at, size = package.span(INDEX)
    lines = [json.loads(x) for x in package.read(at, size).splitlines()]
    at, _ = package.span(ARCHIVE)
    i = 0
    while i < len(lines):
        j, first = i + 1, lines[i]["offset"]
        while j < len(lines) and lines[j]["offset"] + lines[j]["length"] - first <= READ_BYTES and lines[j]["offset"] == lines[j - 1]["offset"] + lines[j - 1]["length"]:
            j += 1
        last = lines[j - 1]
        raw = package.read(at + first, last["offset"] + last["length"] - first)
        for x in lines[i:j]:
            yield parse(gzip.decompress(raw[x["offset"] - first:x["offset"] - first + x["length"]]))
        i = j


READ = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_records(manifest: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """One row per record; a response's payload is checked against its digest."""
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        fs, _ = filesystem(folder)
        for b in batches:
            for path in b.column("path").to_pylist():
                package, rows, held = Package(fs, path), [], 0
                for head, body in records_of(package):
                    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and (hashlib.sha256(body).hexdigest() != digest or len(body) != int(head["x-payload-length"])):
                        raise ValueError(f"{path}: a payload differs from its digest")
                    page, refers = head.get("x-page-id"), head.get("warc-refers-to")
                    rows.append((None if page is None else int(page), head.get("warc-target-uri"), body if payload else None, int(head["x-payload-length"]),
                                 digest, kind, None if refers is None else int(refers[len("<urn:page:"):-1])))
                    held += len(body)
                    if held > READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(col, k) for col, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(col, k) for col, k in zip(zip(*rows), kinds)], names)
                package.close()

    return manifest.select("path").mapInArrow(c.task(run), READ)


def op9(spark, sf_dir: str) -> DataFrame:
    pages = c.read(spark, sf_dir, "pages")
    folder = c.stage_dir(spark, "warc")
    manifest = write(pages, folder)
    manifest = manifest.repartition(max(1, pages.rdd.getNumPartitions()))
    return read_records(manifest, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
