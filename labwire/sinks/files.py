"""Small file-system helpers over Hadoop's FileSystem (HDFS, S3, local)."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def complete(spark: SparkSession, path: str) -> bool:
    """A finished Spark write leaves a ``_SUCCESS`` marker."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written under another name and renamed, so a crash leaves the old or the new text."""
    fs, p = _fs(spark, path)
    _, own = _fs(spark, path + ".new")
    out = fs.create(own, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(own, p):
        raise OSError(f"could not rename {own} to {p}")


def create_new(spark: SparkSession, path: str) -> None:
    """An empty file that must not exist yet."""
    fs, p = _fs(spark, path)
    fs.create(p, False).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def any_match(spark: SparkSession, pattern: str) -> bool:
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint: new for each fresh
    checkpoint, also at the same path.  Without one, a name from the path."""
    text = read_text(spark, checkpoint.rstrip("/") + "/metadata")
    if text:
        return json.loads(text)["id"]
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        fs, p = _fs(spark, path + ".new")  # a crash between delete and rename
        if not fs.exists(p):
            return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
