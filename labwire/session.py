"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import logging
import os
import tempfile

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings the plans rely on; a cluster's own values win (only unset keys are set).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # MAX(id) of a parquet table is answered from file footers
    "spark.sql.parquet.aggregatePushdown": "true",
    # only the buckets a batch touches are rewritten by the table upsert
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Set at session start (not changeable later): remove checkpoint files of
# frames that are no longer referenced.
STARTUP_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


# JVM option for every process that runs tasks (executors; the driver in
# local mode).  Some parse-stage methods are above HotSpot's 8000-byte JIT
# limit; without this flag they stay interpreted (10-30% slower at steady
# state, measured at sf0.1).
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "labwire",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no ports beyond Spark's own)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    for k, v in {**RECOMMENDED_CONF, **STARTUP_CONF}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_recommended_conf(spark: SparkSession) -> None:
    for k, v in RECOMMENDED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system).  When it is unset,
    as in local tests, a fresh local folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="labwire-ckpt-")
        log.warning("spark.checkpoint.dir unset; using local folder %s (local mode only)", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "tables", name)
    return path
