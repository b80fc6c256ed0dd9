import datetime as dt

from pyspark.sql import functions as F

from labwire.operators.orders import extract_orders, project
from labwire.operators.parse import GATE_POSITIONS, accepts, gate_columns, raw_fields
from labwire.operators.routing import mfl_ok, with_route
from tests.helpers import lit_col, message, msh, one, parsed, records

PID = "PID|1||P7^^^MRN~X^^^ALT||Banda&van^Mary||19900102|F"


def extracted(spark, texts):
    return extract_orders(parsed(spark, texts))


def test_fields_of_a_plain_message(spark):
    m = message(msh(), PID, "ORC|NW|ORD-1^SCP", "OBR|1|x||10000-0^CBC^LN|||202401021230")
    r = extracted(spark, [m]).collect()[0]
    assert (r.message_ref_id, r.sending_application, r.mfl_code, r.lab_code) == ("MSG1", "APP0", "1234", "L01")
    assert (r.order_id, r.loinc, r.order_date, r.order_time) == ("ORD-1", "10000-0", dt.date(2024, 1, 2), "12:30:00")
    assert r.structure == "OML_O21" and r.version == "2.5" and r.is_er7


def test_unescape_left_to_right(spark):
    apps = ["A\\T\\B", "\\E\\F\\E\\", "\\F\\E\\", "x\\S\\y\\R\\z", "plain"]
    texts = [message(msh(app=a), PID, "ORC|NW|1", "OBR|1|x||c^^^|||") for a in apps]
    got = one(extracted(spark, texts), "sending_application")
    assert got == ["A&B", "\\F\\", "|E\\", "x^y~z", "plain"]


def test_alternate_loinc_and_missing_values(spark):
    texts = [
        message(msh(), PID, "ORC|NW|1", "OBR|1|x||^CBC^^12345-6|||"),
        message(msh(mid="", lab=""), PID, "OBR|1|x|||||2024"),
    ]
    rows = extracted(spark, texts).orderBy("offset").collect()
    assert rows[0].loinc == "12345-6"
    assert rows[1].message_ref_id is None and rows[1].lab_code is None and rows[1].order_id is None
    assert rows[1].loinc is None and rows[1].order_date is None and rows[1].order_time is None


def test_first_order_scope(spark):
    texts = [
        # no ORC: order id null, OBR still taken
        message(msh(), PID, "OBR|1|x||A^^|||202401010000"),
        # the only ORC comes after the first OBR: it is the first ORC
        message(msh(), PID, "OBR|1|x||A^^|||202401010000", "ORC|NW|SECOND", "OBR|2|x||B^^|||"),
        # OBR of the first order only (before the second ORC)
        message(msh(), PID, "ORC|NW|ONE", "ORC|NW|TWO", "OBR|2|x||B^^|||202401010000"),
    ]
    rows = extracted(spark, texts).orderBy("offset").collect()
    assert (rows[0].order_id, rows[0].loinc) == (None, "A")
    assert (rows[1].order_id, rows[1].loinc) == ("SECOND", "A")
    assert (rows[2].order_id, rows[2].loinc) == ("ONE", None)


def test_custom_delimiters(spark):
    m = "MSH#$*!%#A!T!B$x#FAC$1234#LAB#L01#20240101080000##OML$O21$OML_O21#MSG9#P#2.5####AL\r" \
        "ORC#NW#O-9\rOBR#1#x##C-1$T$LN###202401010800\r"
    r = extracted(spark, [m]).collect()[0]
    assert (r.sending_application, r.mfl_code, r.order_id, r.loinc) == ("A%B", "1234", "O-9", "C-1")
    assert r.structure == "OML_O21" and r.is_er7


def test_gate(spark):
    texts = [
        message(msh(), PID),                                   # accepted
        message(msh(mtype="OML^O21"), PID),                    # structure derived from 9.1_9.2
        message(msh(mtype="ORU^R01^ORU_R01"), PID),            # other type
        message(msh(ver="2.4"), PID),                          # other version
        "not an hl7 message",
        message(msh(), "PID^1"),                               # segment without the field separator
        "MSH|^~\\&|a|b|c\r",                                   # too few separators
        message(msh(), "  " + PID),                            # indented segment is fine
    ]
    g = raw_fields(parsed(spark, texts), GATE_POSITIONS, ["offset", "is_er7"]).select("offset", "is_er7", *gate_columns())
    oml = one(g.select("offset", accepts("OML_O21").alias("a")), "a")
    assert oml == [True, True, False, False, False, False, False, True]
    oru = one(g.select("offset", accepts("ORU_R01").alias("a")), "a")
    assert oru == [False, False, True, False, False, False, False, False]


def test_header_projection(spark):
    texts = [
        message(msh(mtype="OML^O21^OML_O21"), PID),
        message(msh(mtype="OML^O21^OML_021"), PID),
        message(msh(mtype="ORU^R01^ORU_R01"), PID),
        message(msh(mtype="OML^O21"), PID),
        message(msh(ts="202401010800"), PID),
    ]
    h = project(parsed(spark, texts), "header")
    rows = [r.h for r in h.orderBy("offset").collect()]
    assert [r.message_type if r else None for r in rows] == ["ACK", "OML_021", "ORU_R01", None, None]
    assert rows[0].asDict() == {
        "message_type": "ACK", "version": "2.5", "timestamp": "2024-01-01 08:00:00",
        "sender_id": "1234", "receiver_id": "L01", "message_id": "MSG1", "ack_type": "AL",
    }
    fixed = project(parsed(spark, texts[:1]), "header", fix_oml=True).first().h
    assert fixed.message_type == "OML_021"


def test_patient_projection(spark):
    base = "PID|1||P7^^^MRN~X^^^ALT||Banda&van^Mary||{dob}|{sex}"
    texts = [message(msh(), base.format(dob="19900102", sex=s)) for s in ("M", "F", "U", "")]
    texts += [message(msh(), base.format(dob="19900231", sex="M")), message(msh(), base.format(dob="199001", sex="M"))]
    p = project(parsed(spark, texts), "patient")
    rows = [r.p for r in p.orderBy("offset").collect()]
    assert [r.gender if r else None for r in rows] == ["MALE", "FEMALE", "OTHER", None, "MALE", None]
    assert rows[0].asDict() == {"id": "P7", "first_name": "Mary", "last_name": "Banda", "gender": "MALE", "dob": "1990-01-02"}
    assert rows[4].dob == "1990-02-28"


def test_mfl_rule(spark):
    vals = [None, "", "123", "1234", "12345", "ABCD", "    ", '""', "12\U0001F600", "123\U0001F600", "1é34"]
    got = [r[0] for r in lit_col(spark, vals).orderBy("i").select(mfl_ok(F.col("v"))).collect()]
    # a supplementary character counts twice, as in a JVM string
    assert got == [False, False, False, True, False, True, True, False, True, False, True]


def test_routes_first_match_wins(spark):
    texts = [
        b"",
        "junk",
        message(msh(mid=""), PID),
        message(msh(mfl="12345"), PID),
        message(msh(lab=""), PID),
        message(msh(lab='""'), PID),
        message(msh(), PID),
    ]
    r = with_route(extracted(spark, texts))
    assert one(r, "route") == ["empty", "unparseable", "no_message_id", "bad_mfl", "dlq", "valid", "valid"]


def test_segments_long_skips_short_segments(spark):
    from labwire.operators.parse import clean_messages, segments_long

    texts = ["MSH|^~\\&|a\r\rPID|1\rAB\rOBR|1\r\r\rORC|x\rZZ", "MSH|^~\\&|a\rNT\r\r", "junk\rPID|1"]
    got = [tuple(r) for r in segments_long(clean_messages(records(spark, texts))).orderBy("offset", "seg_idx").collect()]
    assert got == [
        (0, 0, 1, "MSH", 3), (0, 0, 2, "PID", 2), (0, 0, 3, "OBR", 2), (0, 0, 4, "ORC", 2),
        (0, 1, 1, "MSH", 3),
    ]


def test_segments_long_with_fields(spark):
    from labwire.operators.parse import clean_messages, segments_long

    texts = [message(msh(app="A\\T\\B"), "ORC|NW|X^Y")]
    rows = segments_long(clean_messages(records(spark, texts)), with_fields=True).orderBy("seg_idx").collect()
    assert rows[0].fields[:3] == ["MSH", "^~\\&", "A&B^1.2^ISO"]
    assert rows[1].fields == ["ORC", "NW", "X^Y"]


def test_bare_segments_bound_the_first_order(spark):
    texts = [
        message(msh(), "ORC", "ORC|NW|X2", "OBR|1|x||T2^N^LN"),
        message(msh(), "ORC|NW|O1", "ORC", "OBR|1|x||T2^N^LN"),
        message(msh(), "ORC|NW|O1", "OBR", "OBR|2|x||T2^N^LN"),
        msh() + "\rOBR|1|x||T1^N^LN\rORC",  # a bare segment ends the text
    ]
    got = [(r.order_id, r.loinc) for r in extract_orders(parsed(spark, texts)).orderBy("offset").collect()]
    assert got == [(None, None), ("O1", None), ("O1", None), (None, "T1")]


def test_only_escape_sequences_change(spark):
    texts = [message(msh(app=a)) for a in ("A\ue000B", "A\u0001FB\\T\\C", "\\F\\S\\E\\", "x\\R\\S\\S\\y")]
    got = [r.sending_application for r in extract_orders(parsed(spark, texts)).orderBy("offset").collect()]
    assert got == ["A\ue000B", "A\u0001FB&C", "|S\\", "x~S^y"]


def test_segments_by_first_opening_equal_the_exact_search(spark):
    from labwire.functions.hl7 import before_opening, opened_at, segment_start

    texts = ["", "MSH|", "MSH|x\rORC|a", "MSH|x\rORCX|a\rORC|b", "MSH|x\rORCX|a", "MSH|x\rORC\rORC|b", "MSH|x\rORCX\rORC",
             "MSH|x\rORC", "MSH|x\rOR", "MSH|ORC|\rOBR|1\rORCA\rORCB|\rORC|c\rORC|d", "MSH|\U0001f600é\rORCé|\rORC|z", None]
    df = spark.createDataFrame([(t,) for t in texts], "msg string").withColumn("fs", F.substring("msg", 4, 1))
    df = df.withColumn("b", before_opening("msg", "ORC")).withColumn("exact", segment_start("msg", "ORC", F.col("fs")))
    df = df.withColumn("fast", opened_at("msg", F.col("b"), "ORC", F.col("fs"), F.col("exact")))
    assert [(r.msg, r.fast) for r in df.collect()] == [(r.msg, r.exact) for r in df.collect()]
    # from the second character of the first segment on
    df = df.withColumn("rest", F.substring("msg", 3, 1000)).withColumn("b2", before_opening("rest", "ORC"))
    df = df.withColumn("fast", opened_at("rest", F.col("b2"), "ORC", F.col("fs"), segment_start("msg", "ORC", F.col("fs"), 3), 2))
    assert [r.fast for r in df.collect()] == [r.exact for r in df.collect()]
    got = {r["offset"]: r for r in parsed(spark, [message(msh(), "ORCX|NO", "ORC|NW|yes^1", "OBR|1|x||A", "ORCY", "OBR|2")]).collect()}[0]
    assert got["orc"][2] == "yes^1" and got["obr"][4] == "A"


def test_parts_are_cut_as_split_part_cuts_them(spark):
    from labwire.functions.hl7 import _part

    rows = [(s, d) for s in (None, "", "a", "^", "^^", "a^b", "a^b^c", "^b", "a^", "a^^c^d", "\u00e9^\u4e2d^x", "aXXb") for d in ("^", "\u0000", "X", None)]
    df = spark.createDataFrame(rows, "s string, d string")
    for n in (2, 3, 4):
        out = df.select(_part(F.col("s"), F.col("d"), n).alias("a"), F.split_part("s", "d", F.lit(n)).alias("b")).collect()
        assert [r.a for r in out] == [r.b for r in out]


def test_parse_splits_no_text_by_a_delimiter_regex(spark):
    from labwire.plans.pipeline import route_records

    plan = route_records(records(spark, ["MSH|^~\\&|x"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "split_part" not in plan and "StringSplitSQL" not in plan and "split(" in plan


def test_encoding_of_short_and_odd_headers(spark):
    from labwire.functions.hl7 import NO_DELIMITER, encoding_of

    texts = ["", "M", "MSH", "MSH\rPID|1", "MSH|", "MSH|^", "MSH|^~\\&|A", "MSHS^~S", "A|B|C|D", "MSH|\rPID|^~"]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    fs = F.substring("m", 4, 1)
    msh2 = F.split_part(F.substring_index("m", "\r", 1), fs, F.lit(2))
    want = df.select(fs.alias("fs"), *[F.when(F.substring(msh2, i, 1) == "", NO_DELIMITER).otherwise(F.substring(msh2, i, 1)).alias(n) for i, n in enumerate(("cs", "rs", "esc", "ss"), 1)])
    got = df.select(*[c.alias(n) for n, c in encoding_of("m").items()])
    assert got.collect() == want.collect()


PLAIN = "MSH|^~\\&|A\\T\\B^1|F^M1~x|L|L01&s^9|20240101||OML^O21^OML_O21|M1|P|2.5\r\nPID|1\r\nNTE|1||n\r\nORC|NW|O1^S\r\nNTE|2\r\nOBR|1|x||c^d^e^f|||202401021530\r\n"
OTHER = [
    PLAIN.replace("\r\nPID", "\r\n\r\nPID"),  # an empty line
    PLAIN.replace("PID|1", "PIDX|1"),  # not ER7
    PLAIN.replace("\r\nPID|1", "\r\n PID|1"),  # an indented segment
    PLAIN.replace("|", "#"),  # other delimiters
    PLAIN.replace("ORC|", "OBR|9\r\nORC|"),  # an OBR, then the first ORC
    PLAIN.replace("||n", "||n\u2028NTE|x"),  # a line end of a regex
    PLAIN.replace("|M1|P|2.5", "|M1"),  # a short header
    "", "MSH|^~\\&|", "no message", "MSH|MSH|^~\\&|\r",
]
SAME = [
    PLAIN, PLAIN.replace("\r\n", "\n"), PLAIN.replace("\r\n", "\r").strip(), PLAIN.replace("ORC|NW|O1^S\r\n", ""),
    PLAIN.replace("OBR|", "ORC|XX|O2\r\nOBR|"), PLAIN.replace("ORC|NW|O1^S", "ORC"), PLAIN.replace("OBR|1|x||c^d^e^f|||202401021530", "OBR|1"),
    PLAIN.replace("PID|1", "PID|" + "é" * 9 + "\r\nAB" + "\r\nZZZ|1" * 5000),
]


def test_a_plain_message_is_matched_in_one_pass_and_read_as_before(spark):
    """A plain message meets none of the cleanup's steps, and any message gives what
    the staged parse gives."""
    from labwire.functions.hl7 import plain_fields, plain_values
    from labwire.operators import parse

    raw = records(spark, [*SAME, *OTHER, None])
    texts = spark.createDataFrame([(i, m) for i, m in enumerate(SAME + OTHER)], "i long, m string")
    matched = {r.i for r in texts.select("i", plain_fields(plain_values("m")).alias("f")).filter("f is not null").collect()}
    assert matched == set(range(len(SAME)))
    cleaned = parse.clean_messages(raw, flat=True).filter("flat is not null").select("msg", "flat").collect()
    assert len(cleaned) == len(SAME) and all(r.msg is None for r in cleaned)
    assert cleaned[0].flat == ["OML", "O21", "OML_O21", "2.5", "A\\T\\B", "M1", "L01", "M1", "O1", "c", "f", "202401021530"]
    segments = parse.segments_of(parse.FLAT_POSITIONS)
    staged = extract_orders(parse.parse_messages(raw, segments=segments)).orderBy("offset").collect()
    assert extract_orders(parse.parse_messages(raw, segments=segments, flat=True)).orderBy("offset").collect() == staged
    assert staged[0].sending_application == "A&B" and staged[0].order_time == "15:30:00"
