"""Every registered query against its DuckDB oracle (the driver's check), at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.compare import digest, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(cols) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert digest(cols, rows) == digest(o_cols, o_rows)


def test_every_query_has_an_oracle():
    """Of the queries on messages; those of training data without SQL are held against brute force in tests/llm."""
    from labwire.plans.queries import QUERIES
    from labwire.streaming.queries import STREAM_QUERIES

    assert set(E.oracle_sql()) >= set(QUERIES) | set(STREAM_QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1046
    assert df.columns == ["order_id", "message_ref_id", "mfl_code", "order_date", "order_time",
                          "sending_application", "test_id", "lab_code"]
