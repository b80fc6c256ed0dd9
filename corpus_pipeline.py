"""The corpus pipeline: quality rules, toxicity, near duplicates, benchmark
decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and gives it to the next stage.  All but
the last return the columns of documents.  Statistics and decisions of a
stage come from its own input; labels and benchmark are read from ``sf_dir``.

Defined results: a null or empty text fails the quality stage's base rule
(fewer than 50 words).  Decisions are joined back by (id, hash of id and
text), so rows that repeat in full share their decision; of a group of near
duplicates the row with the least id stays, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwire.llm import common as c
from labwire.llm import decontaminate, encode, jaccard, packing, quality, toxicity


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__key", F.xxhash64("doc_id", "text"))


def quality_rules(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rule or a risk-controlled rule."""
    judged = quality.judge(_keyed(docs), c.read(spark, sf_dir, "labels"), extra=["__key"])
    return _keep(docs, judged.filter("kept"))


def toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score reaches the threshold of their language."""
    c.tidy(spark)
    scored = toxicity.classify(_keyed(docs), c.read(spark, sf_dir, "labels"), keep=["doc_id", "lang", "__key"])
    return _keep(docs, scored.filter(~F.col("flagged")))


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents, the one with the least id stays."""
    c.tidy(spark)
    linked = jaccard.link(docs)
    first = linked.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("x"))
    chosen = first.select(F.col("x.doc_id").alias("doc_id"), F.col("x.key").alias("__key"))
    return _keep(docs, chosen).dropDuplicates(["doc_id", "text"])


def decontaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more of the words lie in benchmark windows."""
    c.tidy(spark)
    found = decontaminate.contaminated(_keyed(docs), c.read(spark, sf_dir, "benchmark"), extra=["__key"])
    return _keep(docs, found.filter(~F.col("contaminated")))


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 tokens, one row per piece."""
    out = packing.pack(docs, encode.default_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _keep(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, key) is in ``chosen``, with their own columns."""
    ids = chosen.select(F.col("doc_id").alias("__id"), "__key").distinct()
    left = _keyed(docs)
    return left.join(ids, (left["__key"] == ids["__key"]) & left.doc_id.eqNullSafe(ids["__id"]), "left_semi").select(*docs.columns)


STAGES = [
    ("quality", quality_rules),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: The models, exact binomial tests and the tokenizer are not expressible in SQL;
#: tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  Once a stage's result is written, the tables it staged and
    the result before it are deleted; the last result stays, as the returned rows read it."""
    docs, before = c.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = c.stage_dir(spark, name)
        with c.scratch(spark, f"{name}-tables"):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        if before:
            c.drop_staged(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return docs
