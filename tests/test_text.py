from pyspark.sql import functions as F

from labwire.functions.text import decode_payload, is_empty_payload, preview, sanitize
from tests.helpers import lit_col, records


def test_sanitize_edge_rows(spark):
    cases = {
        "A|1\r\nNTE|x\r\nB|2\n": "A|1\rB|2\r",
        "A\rNTE|1\rNTE|2\rNTE|3\rB": "A\r\rB",
        "a\r\r\rb": "a\rb",  # two collapse passes (each one is non-recursive)
        "MSH|x\nNTE|note\nOBR|1": "MSH|x\rOBR|1",
        "no notes here": "no notes here",
    }
    df = lit_col(spark, list(cases))
    got = [r[0] for r in df.orderBy("i").select(sanitize("v")).collect()]
    assert got == list(cases.values())


def test_single_collapse_pass_is_not_recursive(spark):
    df = lit_col(spark, ["a\r\r\rb"])
    assert df.select(F.replace("v", F.lit("\r\r"), F.lit("\r"))).first()[0] == "a\r\rb"


def test_decode_replaces_malformed_bytes(spark):
    df = records(spark, [bytes([0x41, 0xFF, 0x42]), None, b"", "MSH"])
    rows = df.orderBy("offset").select(decode_payload("value").alias("t"), is_empty_payload("value").alias("e")).collect()
    assert rows[0]["t"] == "A�B" and not rows[0]["e"]
    assert rows[1]["e"] and rows[2]["e"] and not rows[3]["e"]


def test_preview_is_first_100_chars(spark):
    df = lit_col(spark, ["x" * 250, "short"])
    got = [r[0] for r in df.orderBy("i").select(preview("v")).collect()]
    assert got == ["x" * 100, "short"]


def test_guarded_steps_clean_as_the_chain_does(spark):
    from labwire.functions.text import sanitized

    texts = [None, "", "a", "\n", "\r\r\r\r\r", "\r\n\n\r", "MSH|x\r\nNTE|1||a\r\nNTE|2\nPID|1\n", "x NTE|1\r", "NTE|", "a\rNTE|b\u2028NTE|c\r\rd", "\rNTE|1\r\rNTE|2\r\r"]
    df = lit_col(spark, texts)
    rows = sanitized(df, "v", "clean").select("v", "clean", sanitize("v").alias("want")).collect()
    assert len(rows) == len(texts) and [r.clean for r in rows] == [r.want for r in rows]
