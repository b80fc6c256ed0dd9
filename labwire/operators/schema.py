"""The stored table's schema (K6) and additive schema evolution (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# K6: columns of the stored table; ``order_time`` is HH:mm:ss text.
LAB_ORDER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("mfl_code", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("test_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_time", T.StringType()),
        T.StructField("message_ref_id", T.StringType()),
        T.StructField("sending_application", T.StringType()),
        T.StructField("lab_code", T.StringType()),
    ]
)
LAB_ORDER_COLUMNS = [f.name for f in LAB_ORDER_SCHEMA.fields]
STORED_COLUMNS = [c for c in LAB_ORDER_COLUMNS if c != "id"]

# JDBC column types for creating the table from Spark (K6); mfl_code and
# test_id are unbounded text, the dialect's default for strings.
JDBC_COLUMN_TYPES = (
    "order_id VARCHAR(50), "
    "message_ref_id VARCHAR(100), sending_application VARCHAR(25), lab_code VARCHAR(10)"
)


def add_column(df: DataFrame, name: str, dtype: T.DataType) -> DataFrame:
    """K7: add a nullable column; existing rows read null."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """K7: rows written before and after a column was added, as one table."""
    return old.unionByName(new, allowMissingColumns=True)


def read_evolved(spark, *paths: str) -> DataFrame:
    """K7 for files: parquet written under both schemas, merged on read."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)
