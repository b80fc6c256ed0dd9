"""K1/K3/K6 against a relational database over JDBC (PostgreSQL syntax).

Per micro-batch: the deduplicated rows are written by the executors into a
staging table (``batchsize`` rows per round trip, a bounded number of
connections), then one set-based ``INSERT ... SELECT ... ON CONFLICT`` moves
them into the target.  Staging and merge are retried together; both are
idempotent, so a retried or replayed batch converges to the same table.  The
staging table carries the query's id: two jobs on one target do not meet.  Connection settings
have no defaults: every value must be passed in by the caller.

(No JDBC driver or database is available in the build container, so this
module is exercised only through its SQL generation in the tests.)
"""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from labwire.operators.schema import JDBC_COLUMN_TYPES, STORED_COLUMNS

log = logging.getLogger(__name__)

# Fixed values of the original sink: batch size, attempts, pause between attempts.
BATCH_SIZE = 1000
MAX_ATTEMPTS = 5
RETRY_PAUSE_S = 0.1
# Connections that the staging write opens at most.
MAX_CONNECTIONS = 16

# Columns cast on the way into the target (text -> date / time).
CASTS = {"order_date": "::date", "order_time": "::time"}


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str
    table: str = "crt.lab_order"
    key: str = "message_ref_id"
    driver: str | None = None

    def props(self) -> dict[str, str]:
        p = {"user": self.user, "password": self.password}
        if self.driver:
            p["driver"] = self.driver
        return p


def merge_sql(target: str, staging: str, columns: Sequence[str] = STORED_COLUMNS,
              key: str = "message_ref_id", casts: Mapping[str, str] = CASTS) -> str:
    """``INSERT ... SELECT ... ON CONFLICT (key) DO UPDATE`` of all non-key columns.

    The generated id is never named, so the database assigns it to new keys
    and keeps it for existing ones.
    """
    cols = ", ".join(columns)
    select = ", ".join(f"{c}{casts.get(c, '')}" for c in columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return (
        f"INSERT INTO {target} ({cols}) SELECT {select} FROM {staging} "
        f"ON CONFLICT ({key}) DO UPDATE SET {updates}"
    )


def _execute(spark, t: JdbcTarget, sql: str) -> None:
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in t.props().items():
        props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(t.url, props)
    try:
        stmt = conn.createStatement()
        stmt.executeUpdate(sql)
        stmt.close()
    finally:
        conn.close()


def staging_name(table: str, query: str, batch_id: int) -> str:
    """Staging table of one query's batch; short, as databases limit names."""
    tag = "".join(c for c in query if c.isalnum())[:12]
    return f"{table}_stage_{tag}_{batch_id}"


def upsert_batch(rows: DataFrame, batch_id: int, t: JdbcTarget, query: str = "default",
                 attempts: int = MAX_ATTEMPTS, pause_s: float = RETRY_PAUSE_S) -> None:
    """Stage ``rows`` (already one row per key) and merge them into the target."""
    spark = rows.sparkSession
    staging = staging_name(t.table, query, batch_id)
    sql = merge_sql(t.table, staging, key=t.key)
    for attempt in range(1, attempts + 1):
        try:
            (
                rows.select(*STORED_COLUMNS)
                .write.mode("overwrite")
                .option("batchsize", BATCH_SIZE)
                .option("numPartitions", MAX_CONNECTIONS)
                .option("createTableColumnTypes", JDBC_COLUMN_TYPES)
                .jdbc(t.url, staging, properties=t.props())
            )
            _execute(spark, t, sql)
            break
        except Exception:  # noqa: BLE001 - rethrown after the last attempt
            if attempt == attempts:
                raise
            time.sleep(pause_s)
    try:
        _execute(spark, t, f"DROP TABLE IF EXISTS {staging}")
    except Exception as e:  # noqa: BLE001 - the batch is merged; a leftover table is only untidy
        log.warning("could not drop %s: %s", staging, e)
