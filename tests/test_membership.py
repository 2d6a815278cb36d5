"""accepted_values against a reference table."""

import pytest
from pyspark.sql import functions as F

from covenant import Rule, check, measure_rules
from covenant.functions.rules import bound, fail_condition
from covenant.operators import membership
from covenant.operators.checks import FAILED_RULES, PASSED
from covenant.session import scratch_path

IDS = Rule("id_known", "id", "accepted_values", "error", {"values_from": "ids", "values_column": "v"})


def failing(df, rules, **kw):
    return sorted(r.n for r in check(df, rules, **kw).where(~F.col(PASSED)).collect())


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_values_of_a_table_null_hot_and_repeated(spark, monkeypatch, limit):
    monkeypatch.setattr(membership, "BROADCAST_VALUES", limit)
    rows = [(i, [1, None, 2, 7][i % 4], ["a", "b", None, "zz"][i % 4], {"m": i}) for i in range(80)]
    df = spark.createDataFrame(rows, "n int, id long, k string, m map<string,int>").repartition(3)
    ids = spark.createDataFrame([("1",), ("1",), ("2",), ("x",), (None,)], "v string")
    texts = spark.createDataFrame([("a",), ("b",)], "k string")
    rules = [IDS, Rule("k_known", "k", "accepted_values", params={"values_from": "texts"}), Rule("nn", "id", "not_null")]
    out = check(df, rules, references={"ids": ids, "texts": texts})
    assert out.columns == [*df.columns, FAILED_RULES, PASSED] and out.count() == 80
    got = {tuple(r[FAILED_RULES]) for r in out.where("n % 4 = 3").collect()}, {tuple(r[FAILED_RULES]) for r in out.where("n % 4 = 1").collect()}
    assert got == ({("id_known", "k_known")}, {("nn",)}) and out.where(PASSED).count() == 40
    res = {r.rule_name: (r.fail_count, r.sample_failures) for r in measure_rules(df, rules, dataset="d", run_id="r", references={"ids": ids, "texts": texts}).collect()}
    assert res == {"id_known": (20, ["7"]), "k_known": (20, ["zz"]), "nn": (20, ["None"])}


def test_a_million_values_are_joined_not_listed(spark, capsys):
    path = scratch_path(spark, "values")
    spark.range(1_000_000).selectExpr("id * 2 AS v").write.parquet(path)
    df = spark.range(1000).selectExpr("CAST(id AS int) AS n", "id")
    rule = Rule("id_known", "id", "accepted_values", "error", {"values_from": path, "values_column": "v"})
    out = check(df, [rule])
    out.explain()
    plan = capsys.readouterr().out
    assert " IN (" not in plan and "INSET" not in plan and "Join" in plan
    assert out.where(~F.col(PASSED)).count() == 500


def test_empty_reference_fails_every_value_and_unknown_names_raise(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "n int, id long")
    assert failing(df, [IDS], references={"ids": spark.createDataFrame([], "v long")}) == [1]
    with pytest.raises(Exception):
        check(df, [IDS])


def test_bounds_keep_their_digits(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big), (2, big - 1), (3, big + 1)], "n int, v long")
    assert failing(df, [Rule("r", "v", "range", params={"min": str(big), "max": str(big)})]) == [2, 3]
    assert bound("9007199254740993") == big and bound("1.5") == 1.5 and bound(3) == 3 and bound("-2") == -2
    with pytest.raises(ValueError):
        fail_condition(Rule("r", "v", "range", params={"min": "low"}))
