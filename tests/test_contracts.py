import datetime as dt

import pytest

from labwire.operators import contracts

SCHEMA = ("message_ref_id string, mfl_code string, order_id string, test_id string, order_date date, "
          "order_time string, sending_application string, lab_code string")


def table(spark):
    d = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [
            ("m1", "1001", "o1", "t1", d, "10:00:00", "app", "L01"),
            ("m2", None, "o2", None, d, "10:00:00", "app", "L99"),
            ("m3", "1002", "x" * 51, "t", None, None, "a" * 26, None),
            ("m4", "2000", "o4", "t", d, "10:00:00", "app", "L01-TOO-LONG"),
        ],
        SCHEMA,
    )


def test_violations_long_form(spark):
    got = sorted(tuple(r) for r in contracts.violations(table(spark)).collect())
    assert got == [
        ("m2", "not_null", "mfl_code"), ("m2", "not_null", "test_id"),
        ("m3", "max_length", "order_id"), ("m3", "max_length", "sending_application"),
        ("m3", "not_null", "order_date"), ("m3", "not_null", "order_time"),
        ("m4", "max_length", "lab_code"),
    ]


def test_enforce_modes(spark):
    with pytest.raises(contracts.ContractViolation):
        contracts.enforce(table(spark), "fail")
    good, bad = contracts.enforce(table(spark), "quarantine")
    assert [r.message_ref_id for r in good.collect()] == ["m1"]
    assert sorted(r.message_ref_id for r in bad.collect()) == ["m2", "m3", "m4"]


def test_reference_keys(spark):
    fac = spark.createDataFrame([("1001",), ("1002",)], "mfl_code string")
    labs = spark.createDataFrame([("L01",)], "lab_code string")
    t = table(spark)
    assert sorted(r.message_ref_id for r in contracts.facility_violations(t, fac).collect()) == ["m2", "m4"]
    assert sorted(r.message_ref_id for r in contracts.facility_known(t, fac).collect()) == ["m1", "m3"]
    assert sorted(r.message_ref_id for r in contracts.lab_violations(t, labs).collect()) == ["m2", "m4"]
    ren = spark.createDataFrame([("1001", "9001")], "old_code string, new_code string")
    got = {r.message_ref_id: r.mfl_code for r in contracts.rename_facilities(t, ren).collect()}
    assert got == {"m1": "9001", "m2": None, "m3": "1002", "m4": "2000"}
    dels = spark.createDataFrame([("1001",), ("7777",)], "mfl_code string")
    assert [r.mfl_code for r in contracts.blocked_deletes(dels, t).collect()] == ["1001"]


def test_duplicate_keys(spark):
    t = table(spark).unionByName(table(spark).limit(1))
    assert [(r.message_ref_id, r.n) for r in contracts.duplicate_keys(t).collect()] == [("m1", 2)]


def test_check_lists_every_broken_rule(spark):
    fac = spark.createDataFrame([("1001",), ("1002",), ("1001",), (None,)], "mfl_code string")
    labs = spark.createDataFrame([("L01",)], "lab_code string")
    got = {r.message_ref_id: [f"{x.rule}:{x.column_name}" for x in r.violations]
           for r in contracts.check(table(spark), fac, labs).collect()}
    assert got == {
        "m1": [],
        "m2": ["not_null:mfl_code", "not_null:test_id", "reference:lab_code"],
        "m3": ["not_null:order_date", "not_null:order_time", "max_length:order_id", "max_length:sending_application"],
        "m4": ["max_length:lab_code", "reference:mfl_code", "reference:lab_code"],
    }
    assert contracts.check(table(spark).limit(0), fac, labs).count() == 0


def test_a_code_that_is_renamed_twice_is_refused(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "message_ref_id string, mfl_code string")
    once = spark.createDataFrame([("1", "9"), ("1", "9"), ("7", "8")], "old_code string, new_code string")
    got = sorted(map(tuple, contracts.rename_facilities(rows, once).select("message_ref_id", "mfl_code").collect()), key=str)
    assert got == [("a", "9"), ("b", "2"), ("c", None)]  # a repeated row of the map adds none
    twice = spark.createDataFrame([("1", "9"), ("1", "8")], "old_code string, new_code string")
    with pytest.raises(ValueError, match="mapped to 2"):
        contracts.check_renames(twice)
    with pytest.raises(Exception, match="mapped twice"):
        contracts.rename_facilities(rows, twice).collect()
