"""One test per rule kind: NULL, boundary and empty-table rows."""

import datetime as dt

from pyspark.sql import functions as F

from covenant import Rule, check
from covenant.functions.rules import fail_condition
from covenant.operators.checks import FAILED_RULES, PASSED


def flags(spark, rows, schema, rule, as_of="2024-01-01"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(fail_condition(rule, as_of, dict(df.dtypes).get(rule.column))).collect()]


def test_not_null(spark):
    assert flags(spark, [("a",), (None,)], "c string", Rule("r", "c", "not_null")) == [False, True]


def test_accepted_values_null_passes_and_case_sensitive(spark):
    r = Rule("r", "c", "accepted_values", params={"values": ["A", "B"]})
    assert flags(spark, [("A",), ("a",), (None,), ("C",)], "c string", r) == [False, True, False, True]


def test_accepted_values_empty_list_fails_every_non_null(spark):
    r = Rule("r", "c", "accepted_values", params={"values": []})
    assert flags(spark, [("A",), (None,)], "c string", r) == [True, False]


def test_range_inclusive_and_open_bounds(spark):
    rows = [(0.0,), (10.0,), (-0.01,), (10.01,), (None,)]
    assert flags(spark, rows, "x double", Rule("r", "x", "range", params={"min": 0, "max": 10})) == [False, False, True, True, False]
    assert flags(spark, rows, "x double", Rule("r", "x", "range", params={"min": 0})) == [False, False, True, False, False]
    assert flags(spark, rows, "x double", Rule("r", "x", "range", params={"max": 10})) == [False, False, False, True, False]
    assert flags(spark, rows, "x double", Rule("r", "x", "range")) == [False] * 5


def test_regex_is_find_not_full_match(spark):
    r = Rule("r", "c", "regex", params={"pattern": r"\d{4}"})
    assert flags(spark, [("x1234y",), ("12a4",), (None,)], "c string", r) == [False, True, False]
    anchored = Rule("r", "c", "regex", params={"pattern": r"^\d{4}$"})
    assert flags(spark, [("1234",), ("12345",)], "c string", anchored) == [False, True]


def test_regex_default_pattern_accepts_everything(spark):
    assert flags(spark, [("",), ("x",)], "c string", Rule("r", "c", "regex")) == [False, False]


def test_not_future_date_null_is_not_failure(spark):
    rows = [(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),), (None,)]
    assert flags(spark, rows, "d date", Rule("r", "d", "not_future_date")) == [False, False, True, False]


def test_not_future_date_on_timestamps_compares_dates(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 0),), (dt.datetime(2024, 1, 2, 0, 1),)]
    assert flags(spark, rows, "t timestamp", Rule("r", "t", "not_future_date")) == [False, True]


def test_not_future_date_on_strings(spark):
    rows = [("2023-05-01",), ("2030-01-01",), ("garbage",)]
    assert flags(spark, rows, "s string", Rule("r", "s", "not_future_date")) == [False, True, False]


def test_date_format(spark):
    r = Rule("r", "s", "date_format", params={"format": "yyyyMMdd"})
    rows = [("20240131",), ("20251332",), ("XXXXXXXX",), ("00000000",), ("20231301",), (None,)]
    assert flags(spark, rows, "s string", r) == [False, True, True, True, True, False]


def test_date_format_default_iso(spark):
    r = Rule("r", "s", "date_format")
    assert flags(spark, [("2024-02-29",), ("2023-02-29",)], "s string", r) == [False, True]


def test_exact_length_compares_value(spark):
    r = Rule("r", "n", "exact_length", params={"length": 80})
    assert flags(spark, [(80,), (79,), (None,)], "n int", r) == [False, True, False]


def test_unknown_rule_type_never_fails(spark):
    assert flags(spark, [("a",), (None,)], "c string", Rule("r", "c", "checksum")) == [False, False]


def test_check_on_empty_table(spark):
    df = spark.createDataFrame([], "k string, v int")
    out = check(df, [Rule("nn", "k", "not_null"), Rule("u", "k", "unique", order_by=("v",))])
    assert out.count() == 0
    assert set(out.columns) >= {PASSED, FAILED_RULES}


def test_null_flag_never_loses_rows(spark):
    """clean + quarantine = input, even when a predicate is NULL."""
    df = spark.createDataFrame([(1, None), (2, dt.date(2030, 1, 1)), (3, dt.date(2000, 1, 1))], "id int, d date")
    a = check(df, [Rule("nf", "d", "not_future_date")], as_of="2024-01-01")
    clean = a.where(F.col(PASSED)).count()
    bad = a.where(~F.col(PASSED)).count()
    assert (clean, bad) == (2, 1)


def test_failed_rules_keep_rule_order(spark):
    df = spark.createDataFrame([(None, 99)], "k string, v int")
    rules = [Rule("b_rule", "v", "range", params={"max": 10}), Rule("a_rule", "k", "not_null")]
    row = check(df, rules).collect()[0]
    assert row[FAILED_RULES] == ["b_rule", "a_rule"] and row[PASSED] is False


def test_accepted_values_strings_on_numeric_column(spark):
    r = Rule("r", "n", "accepted_values", params={"values": ["1", "2"]})
    assert flags(spark, [(1,), (5,), (None,)], "n int", r) == [False, True, False]
    mixed = Rule("r", "n", "accepted_values", params={"values": ["1", "x"]})
    assert flags(spark, [(1,), (5,)], "n int", mixed) == [False, True]
    dec = Rule("r", "x", "accepted_values", params={"values": ["1", "1.5"]})
    assert flags(spark, [(1.0,), (1.5,), (2.0,)], "x double", dec) == [False, False, True]


def test_range_on_string_column_never_raises(spark):
    r = Rule("r", "s", "range", params={"min": 0, "max": 3})
    assert flags(spark, [("1",), ("x",), ("7",), (None,)], "s string", r) == [False, False, True, False]


def test_exact_length_on_string_column_never_raises(spark):
    r = Rule("r", "s", "exact_length", params={"length": 80})
    assert flags(spark, [("80",), ("79",), ("abc",), (None,)], "s string", r) == [False, True, False, False]
