
from labwire.operators.parse import parse_messages
from labwire.sources.records import RAW_SCHEMA


def records(spark, texts):
    """Raw records from message texts (bytes/str/None), offsets 0..n-1."""
    rows = []
    for i, t in enumerate(texts):
        v = t.encode() if isinstance(t, str) else t
        rows.append((None, v, "lab-orders", 0, i, None))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def parsed(spark, texts):
    return parse_messages(records(spark, texts))


def one(df, col):
    return [r[col] for r in df.orderBy("offset").collect()]


def msh(app="APP0", mfl="1234", lab="L01", ts="20240101080000", mtype="OML^O21^OML_O21",
        mid="MSG1", ver="2.5", fs="|", enc="^~\\&"):
    f = [f"{app}^1.2^ISO", f"FAC^{mfl}^L", "LAB", f"{lab}^9^L", ts, "", mtype, mid, "P", ver, "", "", "", "AL"]
    return "MSH" + fs + enc + fs + fs.join(f)


def message(*segments, sep="\r"):
    return sep.join(segments) + sep


def lit_col(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
