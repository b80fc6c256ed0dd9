"""Deterministic HL7 lab-order messages derived from the ``orders`` and
``customer`` tables (the reference ships no sample messages).

The rules are the ones in FIXTURES.md §2-§3; they are plain column
expressions over ``orders ⋈ customer``, so the message feed grows with the
tables and is built by Spark in parallel.  Key ``k`` = ``o_orderkey``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwire.sources.records import RAW_COLUMNS

TOPIC = "lab-orders"


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _first(*branches: tuple[Column, Column], default: Column) -> Column:
    out = None
    for cond, val in branches:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default)


def message_text(k: Column, custkey: Column, nationkey: Column, orderdate: Column) -> Column:
    """The raw text of message ``k`` (FIXTURES §3)."""
    ymd = F.date_format(orderdate, "yyyyMMdd")
    hm = F.concat(_lpad(k % 24, 2), _lpad(k % 60, 2))
    loinc = F.concat((F.lit(10000) + k % 50).cast("string"), F.lit("-"), (k % 10).cast("string"))
    base = k - F.when(k % 5 == 4, 1).otherwise(0)
    sep = F.when(k % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\r"))

    mtype = _first(
        (k % 73 == 9, F.lit("ORU^R01^ORU_R01")),
        (k % 137 == 43, F.lit("OML^O21^OML_021")),
        (k % 17 == 1, F.lit("OML^O21")),
        default=F.lit("OML^O21^OML_O21"),
    )
    ver = F.when(k % 79 == 10, F.lit("2.4")).otherwise(F.lit("2.5"))
    mid = F.when(k % 41 == 0, F.lit("")).otherwise(
        F.concat(F.lit("MSG"), _lpad(base, 8), F.when(base % 131 == 41, F.lit("Y" * 100)).otherwise(F.lit(""))))
    app = _first(
        (k % 107 == 23, F.lit("A\ue001B\u0001FC\\T\\D")),
        (k % 113 == 31, F.lit("APPLICATION-NAME-OVER-25-CHARS")),
        (k % 19 == 4, F.lit("A\\T\\B")),
        default=F.concat(F.lit("APP"), (k % 4).cast("string")),
    )
    mfl = _first(
        (k % 43 == 1, F.lit("")),
        (k % 7 == 3, F.concat(F.lit("1"), _lpad(custkey, 7))),
        default=(F.lit(1000) + custkey % 9000).cast("string"),
    )
    lab = _first(
        (k % 11 == 5, F.lit("")),
        (k % 47 == 2, F.lit('""')),
        (k % 109 == 29, F.lit("LAB-TOO-LONG-1")),
        default=F.concat(F.lit("L"), _lpad(nationkey, 2)),
    )
    dob = _first((k % 139 == 47, F.lit("19900230")), (k % 149 == 53, F.lit("1990")), default=F.lit("19900102"))
    sex = _first((k % 151 == 59, F.lit("")), (k % 3 == 0, F.lit("M")), (k % 3 == 1, F.lit("F")), default=F.lit("U"))
    obr4 = _first(
        (k % 89 == 12, F.lit("")),
        (k % 13 == 7, F.concat(F.lit("^CBC^^"), loinc)),
        default=F.concat(loinc, F.lit("^CBC^LN")),
    )
    obr7 = _first(
        (k % 59 == 4, ymd),
        (k % 61 == 5, F.concat(F.lit("20230231"), hm, F.lit("00"))),
        (k % 67 == 6, F.concat(ymd, F.lit("240000"))),
        default=F.concat(ymd, hm, F.lit("37+0200")),
    )
    msh = F.concat(
        F.lit("MSH|^~\\&|"), app, F.lit("^1.2^ISO|FAC^"), mfl, F.lit("^L|LAB|"), lab,
        F.lit("^9^L|"), ymd, F.lit("080000||"), mtype, F.lit("|"), mid, F.lit("|P|"), ver,
        F.lit("||||AL"),
    )
    pid = F.concat(
        F.lit("PID|1||P"), custkey.cast("string"),
        F.lit("^^^MRN~X^^^ALT||Banda&van^Mary||"), dob, F.lit("|"), sex,
    )
    oid = F.concat(F.lit("ORD-"), k.cast("string"), F.when(k % 127 == 37, F.lit("-" + "X" * 50)).otherwise(F.lit("")))
    orc = F.when(k % 53 != 3, F.when(k % 101 == 17, F.lit("ORC")).otherwise(F.concat(F.lit("ORC|NW|"), oid, F.lit("^SCP"))))
    bare = F.when(k % 103 == 19, F.lit("ORC"))
    obr = F.concat(F.lit("OBR|1|x||"), obr4, F.lit("|||"), obr7)
    nte1 = F.when(k % 3 == 0, F.lit("NTE|1||fasting"))
    nte2 = F.when(k % 9 == 0, F.lit("NTE|2||repeat"))
    second = k % 97 == 13
    orc2 = F.when(second, F.lit("ORC|NW|SECOND"))
    obr2 = F.when(second, F.lit("OBR|2|x||99999-9^Z^LN|||199901010000"))
    # concat_ws skips the null (absent) segments
    body = F.concat(F.call_function("concat_ws", sep, msh, pid, orc, bare, obr, nte1, nte2, orc2, obr2), sep)
    return _first(
        (k % 83 == 11, F.lit("")),
        (k % 71 == 8, F.concat(F.lit("not an hl7 message "), k.cast("string"))),
        default=body,
    )


@functools.cache
def _record_columns() -> tuple[Column, ...]:
    """The record projection (built once per process: columns are immutable
    expression trees and can be reused by every plan)."""
    k = F.col("k")
    base = k - F.when(k % 5 == 4, 1).otherwise(0)
    return (
        F.lit(None).cast("binary").alias("key"),
        F.encode(message_text(k, F.col("custkey"), F.col("nationkey"), F.col("orderdate")), "UTF-8").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (base % 3).cast("int").alias("partition"),
        k.alias("offset"),
        F.col("orderdate").cast("timestamp").alias("timestamp"),
    )


def lab_order_records(orders: DataFrame, customer: DataFrame, width: int | None = None) -> DataFrame:
    """Kafka-shaped raw records (D1) for every order with a customer.

    ``partition = base % 3`` and ``offset = k`` keep repeats of one message id
    in one partition, with offsets increasing in arrival order.  ``width`` deals
    the rows evenly over so many partitions, before their texts are built (four
    narrow columns move): splits of a file may hold no row group, or many.
    """
    o = orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("custkey"),
        F.col("o_orderdate").alias("orderdate"),
    )
    c = customer.select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"))
    j = o.join(c, "custkey")
    if width:
        j = j.repartition(width)
    return j.select(*_record_columns()).select(*RAW_COLUMNS)


def read_tables(spark, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def records_from_dir(spark, sf_dir: str, width: int | None = None, offsets: tuple[int, int] | None = None) -> DataFrame:
    """Raw records built from ``{sf_dir}/orders.parquet`` ⋈ ``customer.parquet``.

    ``width`` deals them over so many partitions, so the message feed and everything
    downstream run in parallel; ``offsets`` keeps those of ``[first, last)``.
    """
    orders, customer = read_tables(spark, sf_dir, "orders", "customer")
    if offsets:
        orders = orders.filter((F.col("o_orderkey") >= offsets[0]) & (F.col("o_orderkey") < offsets[1]))
    return lab_order_records(orders, customer, width)
