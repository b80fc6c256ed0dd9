"""G1 for streams: route counters, as a table and as a listener.

``write_counts`` stores the counts of a micro-batch under its query and batch id, so
a batch that runs again overwrites its own counts; ``read_counts`` sums them.
``RouteCounter`` keeps totals of the running process in memory.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from labwire.operators.routing import ROUTES, route_counts
from labwire.sinks import files


def write_counts(routed: DataFrame, path: str, batch_id: int, query: str = "default") -> None:
    """The counts by route of one micro-batch (at most one row a route)."""
    route_counts(routed).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/query={query}/batch={batch_id}")


def read_counts(spark: SparkSession, path: str, query: str | None = None) -> DataFrame:
    """Counts by route over all finished batches (of one query, if given): route, n."""
    done = files.matches(spark, f"{path.rstrip('/')}/query={query or '*'}/batch=*/_SUCCESS")
    if not done:
        return spark.createDataFrame([], "route string, n bigint")
    rows = spark.read.schema("route string, n bigint").parquet(*[p.rsplit("/", 1)[0] for p in done])
    return rows.groupBy("route").agg(F.sum("n").alias("n"))


class RouteCounter(StreamingQueryListener):
    """Sums the per-route counts that :func:`observe_routes` reports for every
    micro-batch (register with ``spark.streams.addListener``)."""

    def __init__(self, name: str = "routes"):
        self.name = name
        self.totals: Counter = Counter()
        self.batches = 0

    def onQueryStarted(self, event):  # noqa: N802 - Spark's listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        self.batches += 1
        for r in ROUTES:
            self.totals[r] += row[r] or 0

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
