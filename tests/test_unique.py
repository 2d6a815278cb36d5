"""unique: first row per key passes; NULL keys ignored; hot keys and partitioning do not matter."""

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from covenant import Rule, check, measure
from covenant.operators.checks import PASSED
from covenant.operators.metrics import measure_rules


def failing_ids(df, rule):
    return sorted(r.id for r in check(df, [rule]).where(~F.col(PASSED)).select("id").collect())


def test_unique_basic_and_nulls(spark):
    rows = [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, None), (6, None), (7, "c"), (8, "c")]
    df = spark.createDataFrame(rows, "id int, k string")
    assert failing_ids(df, Rule("u", "k", "unique", order_by=("id",))) == [2, 3, 8]


def test_unique_tie_break_order(spark):
    df = spark.createDataFrame([(5, "a"), (1, "a"), (3, "a")], "id int, k string")
    assert failing_ids(df, Rule("u", "k", "unique", order_by=("id",))) == [3, 5]


def test_unique_multi_column_tie_break(spark):
    df = spark.createDataFrame([(1, "a", "z"), (2, "a", "y"), (3, "a", "y")], "id int, k string, t string")
    assert failing_ids(df, Rule("u", "k", "unique", order_by=("t", "id"))) == [1, 3]


def test_unique_hot_key_and_many_nulls(spark):
    # A third of the rows share one key, another third have a NULL key.
    n = 3000
    df = spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
    )
    got = failing_ids(df, Rule("u", "k", "unique", order_by=("id",)))
    assert got == [i for i in range(3, n, 3)]


def test_unique_same_for_1_and_8_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rule = Rule("u", "o_custkey", "unique", order_by=("o_orderkey",))
    one = failing_ids(df.repartition(1).withColumnRenamed("o_orderkey", "id").withColumn("o_orderkey", F.col("id")), rule)
    eight = failing_ids(df.repartition(8).withColumnRenamed("o_orderkey", "id").withColumn("o_orderkey", F.col("id")), rule)
    assert one == eight and len(one) > 0


def test_unique_null_key_salt_is_a_join_key(spark, capsys):
    """The NULL-key salt must stay an equi-join key (not folded into a post-join filter)."""
    df = spark.createDataFrame([(1, "a")], "id int, k string")
    check(df, [Rule("u", "k", "unique", order_by=("id",))]).explain("formatted")
    plan = capsys.readouterr().out
    right_keys = [line for line in plan.splitlines() if line.startswith("Right keys")]
    assert right_keys and any("_dq_u0_f" in k for k in right_keys)


@pytest.mark.parametrize("order_by", [(), ("id",), ("t",)])
def test_unique_identical_rows_and_null_tie_breaks(spark, order_by):
    rows = [(1, "a", None, {"x": 1})] * 3 + [(2, "b", None, None), (3, "b", None, None), (4, None, None, None), (4, None, None, None), (5, "c", "t", None)]
    df = spark.createDataFrame(rows, "id int, k string, t string, m map<string,int>").repartition(3)
    rule = Rule("u", "k", "unique", order_by=order_by)
    got = check(df, [rule, Rule("u2", "id", "unique"), Rule("n", "t", "not_null")])
    assert got.count() == 8 and sorted(got.columns) == ["_dq_failed_rules", "_dq_passed", "id", "k", "m", "t"]
    fails = {n: got.where(F.array_contains("_dq_failed_rules", n)).count() for n in ("u", "u2", "n")}
    assert fails == {"u": 3, "u2": 3, "n": 7}
    assert got.where("k = 'a' AND m['x'] = 1").count() == 3
    for samples in (True, False):
        m = {r.rule_name: (r.total_count, r.fail_count, r.sample_failures) for r in measure_rules(df, [rule], dataset="d", run_id="r", samples=samples).collect()}
        assert m == {"u": (8, 3, ["a", "b"] if samples else [])}


def test_measure_rules_equals_measure(spark):
    df = spark.createDataFrame([(i, ["a", "b", None, "c"][i % 4], i * 10) for i in range(40)], "id int, k string, v int")
    rules = [Rule("nn", "k", "not_null"), Rule("r", "v", "range", params={"max": 100}), Rule("u", "k", "unique", order_by=("id",)), Rule("none", "id", "not_null")]
    cols = ["rule_name", "total_count", "pass_count", "fail_count", "fail_pct", "sample_failures"]
    want = measure(check(df, rules), rules, dataset="d", run_id="r").select(*cols)
    got = measure_rules(df, rules, dataset="d", run_id="r").select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    empty = measure_rules(df.limit(0), rules, dataset="d", run_id="r")
    assert [(r.total_count, r.fail_count, r.fail_pct) for r in empty.collect()] == [(0, 0, 0.0)] * 4


def test_unique_shuffles_the_rows_once_per_rule(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = check(df, [Rule("u", "o_custkey", "unique", order_by=("o_orderkey",))]).select("o_orderpriority", PASSED)
        out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    rows = [x for x in final.splitlines() if "Exchange hashpartitioning(_dq_u0_salt" in x and "Reused" not in x]
    assert len(rows) == 1 and "Generate" not in final  # without ties the branch that settles them is gone


def test_accepted_booleans(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, k boolean")
    for values, failed in (([True], [2]), (["true"], [2]), ([False, "x"], [1]), ([True, False], []), ([], [1, 2])):
        assert failing_ids(df, Rule("b", "k", "accepted_values", params={"values": values})) == failed


@pytest.mark.parametrize("order_by", [(), ("id",), ("t",), ("id", "t"), ("id", "v")])
def test_unique_staged_equals_lazy_and_every_row_is_kept(spark, order_by):
    import random

    r = random.Random(len(order_by))
    rows = [(r.randint(1, 30), r.choice(["a", "b", None, "c"]), r.choice([None, "x", "y"]), r.choice([None, 1, 2])) for _ in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, t string, v int").repartition(5)
    rules = [Rule("u", "k", "unique", order_by=order_by), Rule("u2", "id", "unique", order_by=("v",))]
    shown = lambda d: sorted(map(str, d.select("id", "k", "t", "v", "_dq_failed_rules").collect()))
    lazy, staged = shown(check(df, rules)), shown(check(df, rules, staged=True))
    assert lazy == staged and len(lazy) == len(rows)
    got = check(df, rules)
    assert got.where("NOT array_contains(_dq_failed_rules, 'u') AND k IS NOT NULL").count() == 3
    assert got.where("NOT array_contains(_dq_failed_rules, 'u2')").count() == len({x[0] for x in rows})
    assert sorted(map(str, got.select("id", "k", "t", "v").collect())) == sorted(map(str, df.collect()))


def test_staged_unique_keys_shuffle_no_rows(spark, capsys):
    df = spark.range(5000).selectExpr("id", "CAST(id AS string) AS k", "repeat('x', 50) AS payload").repartition(4)
    out = check(df, [Rule("u", "k", "unique", order_by=("id",))], staged=True)
    out.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 0 and "BroadcastHashJoin" in plan and "Union" not in plan
    assert out.where(PASSED).count() == 5000


def test_many_copies_of_one_row_are_written_by_many_tasks(spark, monkeypatch):
    from covenant.operators import checks

    monkeypatch.setattr(checks, "COPIES", 100)
    df = spark.range(1000).selectExpr("'a' AS k", "1 AS v")
    out = check(df, [Rule("u", "k", "unique")])
    assert out.count() == 1000 and out.where(PASSED).count() == 1


def test_frames_that_change_between_queries_are_not_staged(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string").withColumn("ts", F.current_timestamp())
    for frame in (df, df.withColumn("r", F.rand())):
        out = check(frame, [Rule("u", "k", "unique")], staged=True)
        assert sorted(r.id for r in out.where(~F.col(PASSED)).collect()) in ([2], [1]) and out.count() == 3


def test_a_wide_tie_break_is_sorted_once_and_only_smallest_first_columns_go_on(spark):
    """Each row twice, under a union: the first row of a key is found with one sort of the rows, and they are joined with narrow first rows."""
    df = spark.range(2000).selectExpr("id", "id % 100 AS k", "CAST(id % 7 AS string) AS t", "id * 0.5D AS v")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = check(df.unionAll(df), [Rule("u", "k", "unique")]).where(~F.col(PASSED)).select("id")
        ids = sorted(r.id for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert ids == sorted([*range(2000), *range(100, 2000)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "min(id" in plan  # a semi join is pushed below the union, and its output sorted again
    from covenant.operators import checks

    order = df.columns
    row = "struct(" + ", ".join(f"{c} AS o{j}" for j, c in enumerate(order)) + ")"
    assert dict(checks._firsts(df, ["k"], ["_k"], order, row).dtypes)["first"] == "struct<h1:bigint,h2:bigint>"


@pytest.mark.parametrize("order_by", [("t", "b", "a"), ("d", "t"), ("s", "a")])
def test_wide_tie_breaks_are_compared_null_safe(spark, order_by):
    """NULLs in other places, -0.0 and 0.0, NaN and nested NULLs: one row of a key passes, one of the smallest tie-break."""
    zeros = [0.0, -0.0, float("nan"), None]
    rows = [(k, a, b, t, d, c, [a, b]) for k in (1, 2) for a in (None, 1) for b in (None, 1) for t in ("x", None) for d in zeros for c in ("q", "Q")]
    rows += [(3, 1, None, "x", 0.0, "q", [1, None]), (3, None, 1, "x", 0.0, "Q", [None, 1]), (4, 5, 5, "y", 1.0, "z", [5])]
    df = spark.createDataFrame(rows, "k int, a int, b int, t string, d double, c string, s array<int>").repartition(3)
    df = df.withColumn("c", F.expr("c COLLATE UTF8_LCASE"))
    value = F.struct(*order_by)
    got = check(df, [Rule("u", "k", "unique", order_by=order_by)], staged="t" == order_by[0])
    got = got.select("k", PASSED, value.eqNullSafe(F.min(value).over(Window.partitionBy("k"))).alias("least")).collect()
    assert len(got) == len(rows) and sorted((r.k, r.least) for r in got if r[1]) == [(k, True) for k in (1, 2, 3, 4)]
