"""measure / samples / severity totals / gate."""

import pytest
from pyspark.sql import functions as F

from covenant import Rule, check, enforce, measure, severity_totals
from covenant.operators.metrics import DataQualityException, summary_lines


RULES = [
    Rule("id_nn", "id", "not_null", "critical"),
    Rule("v_rng", "v", "range", "warning", {"min": 0, "max": 10}),
    Rule("k_uq", "k", "unique", "error", order_by=("n",)),
]


def frame(spark):
    rows = [(1, 5, "a", 1), (None, 11, "a", 2), (3, -1, "b", 3), (4, 12, "a", 4), (5, 3, "c", 5), (6, None, "c", 6)]
    return spark.createDataFrame(rows, "id int, v int, k string, n int")


def results(spark, **kw):
    return {r.rule_name: r for r in measure(check(frame(spark), RULES), RULES, dataset="t", run_id="r", run_ts="2024-01-01 00:00:00", **kw).collect()}


def test_counts_and_pct(spark):
    r = results(spark)
    assert (r["id_nn"].fail_count, r["v_rng"].fail_count, r["k_uq"].fail_count) == (1, 3, 3)
    assert r["v_rng"].total_count == 6 and r["v_rng"].pass_count == 3 and r["v_rng"].fail_pct == 50.0
    assert r["id_nn"].fail_pct == round(1 / 6 * 100, 2)


def test_samples_distinct_sorted_capped(spark):
    r = results(spark)
    assert r["id_nn"].sample_failures == ["None"]
    assert r["v_rng"].sample_failures == ["-1", "11", "12"]
    assert r["k_uq"].sample_failures == ["a", "c"]


def test_samples_capped_at_five(spark):
    df = spark.range(100).select(F.col("id").cast("int").alias("x"))
    rule = Rule("r", "x", "range", params={"max": 10})
    row = measure(check(df, [rule]), [rule], dataset="t", run_id="r").collect()[0]
    assert row.fail_count == 89 and row.sample_failures == ["11", "12", "13", "14", "15"]


def test_empty_table_pct_zero(spark):
    df = spark.createDataFrame([], "id int, v int, k string, n int")
    rows = measure(check(df, RULES), RULES, dataset="t", run_id="r").collect()
    assert len(rows) == 3 and all(r.total_count == 0 and r.fail_pct == 0.0 and r.sample_failures == [] for r in rows)


def test_group_cols_measure_many_runs_in_one_aggregation(spark):
    df = frame(spark).withColumn("day", F.when(F.col("n") <= 3, "d1").otherwise("d2"))
    res = measure(check(df, RULES), RULES, dataset="t", run_id="", group_cols=["day"], samples=False)
    got = {(r.day, r.rule_name): r.fail_count for r in res.collect()}
    assert got[("d1", "v_rng")] == 2 and got[("d2", "v_rng")] == 1 and len(got) == 6


def test_severity_totals_include_zero(spark):
    res = measure(check(frame(spark), RULES[:1]), RULES[:1], dataset="t", run_id="r")
    got = [(r.severity, r.fail_total) for r in severity_totals(res).collect()]
    assert got == [("CRITICAL", 1), ("ERROR", 0), ("WARNING", 0)]


def test_gate_warn_and_fail(spark):
    res = measure(check(frame(spark), RULES), RULES, dataset="t", run_id="r")
    msgs = enforce(res, "warn")
    assert len(msgs) == 1 and msgs[0].startswith("id_nn")
    with pytest.raises(DataQualityException):
        enforce(res, "fail")
    assert {r.rule_name: r.status for r in summary_lines(res).collect()}["v_rng"] == "FAIL"


def test_no_rules_pass_all(spark):
    a = check(frame(spark), [])
    assert a.where("_dq_passed").count() == 6
    assert a.schema["_dq_failed_rules"].dataType.simpleString() == "array<string>"


def _exchanges(df, capsys):
    df.explain()
    return capsys.readouterr().out.count("Exchange")


def test_metric_plan_does_not_grow_with_rules(spark, capsys):
    df = spark.range(1000).select(F.col("id").cast("int").alias("x"))
    few = [Rule(f"r{i}", "x", "range", params={"max": i}) for i in range(2)]
    many = [Rule(f"r{i}", "x", "range", params={"max": i}) for i in range(40)]
    a = _exchanges(measure(check(df, few), few, dataset="t", run_id="r", samples=False), capsys)
    b = _exchanges(measure(check(df, many), many, dataset="t", run_id="r", samples=False), capsys)
    assert a == b == 1


def test_results_same_for_1_and_8_partitions(spark):
    from covenant.plans import catalog

    o = catalog.orders_feed(spark, "/root/testdata/sf0.001")

    def run(n):
        a = check(o.repartition(n), catalog.ORDER_RULES, as_of=catalog.AS_OF)
        r = measure(a, catalog.ORDER_RULES, dataset="orders", run_id="r", run_ts="2024-01-01 00:00:00")
        return sorted((x.rule_name, x.fail_count, tuple(x.sample_failures)) for x in r.collect())

    assert run(1) == run(8)
