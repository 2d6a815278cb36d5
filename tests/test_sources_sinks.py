"""Sources and sinks: fixed-width round trip, delimited landing, contracts, rerun-safe partitions."""

import pytest

import json

from pyspark.sql import functions as F

from covenant.operators.sinks import column_comments, fixed_width_line, with_comments, write_quarantine, write_results
from covenant.session import scratch_path
from covenant.sources import contracts as ct
from covenant.sources import shipped
from covenant.sources.files import parse_fixed_width, read_delimited, read_results_history

LAYOUT = [{"column": "n", "length": 12, "kind": "number"}, {"column": "s", "length": 6, "kind": "text"}]
FIELDS = [{"name": "n", "start": 1, "length": 12, "cast": "long"}, {"name": "s", "start": 13, "length": 6, "trim": True}]


def test_fixed_width_round_trip_signed(spark):
    df = spark.createDataFrame([(123, "ab"), (-99428, "abcdefgh"), (0, None)], "n long, s string")
    lines = df.select(fixed_width_line(LAYOUT).alias("value"))
    assert [r.value for r in lines.collect()] == ["000000000123ab    ", "-00000099428abcdef", "000000000000      "]
    back = parse_fixed_width(lines, FIELDS).collect()
    assert [(r.n, r.s, r._line_length) for r in back] == [(123, "ab", 18), (-99428, "abcdef", 18), (0, "", 18)]


def test_fixed_width_short_line_gives_partial_or_null(spark):
    lines = spark.createDataFrame([("-0000009",), ("",)], "value string")
    back = parse_fixed_width(lines, FIELDS).collect()
    assert [(r.n, r.s, r._line_length) for r in back] == [(-9, "", 8), (None, "", 0)]


def test_delimited_landing_all_strings_short_and_long_rows(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("a|1|x",), ("b|2",), ("c|3|y|extra",)], "value string").write.text(path)
    cols = [{"name": "k"}, {"name": "n"}, {"name": "t"}]
    got = read_delimited(spark, path, cols, {"delimiter": "|", "header": "false"}).orderBy("k").collect()
    assert [(r.k, r.n, r.t) for r in got] == [("a", "1", "x"), ("b", "2", None), ("c", "3", "y")]
    assert all(r._source_file for r in got)


def test_comments_survive_parquet(spark):
    path = scratch_path(spark, "commented")
    df = with_comments(spark.createDataFrame([(1,)], "k int"), {"k": "the key"})
    df.write.parquet(path)
    assert column_comments(spark.read.parquet(path)) == [("k", "the key")]


def test_results_history_missing_is_empty(spark):
    df = read_results_history(spark, scratch_path(spark, "nothing-here"))
    assert df.count() == 0 and "fail_pct" in df.columns


def test_rerun_same_run_id_replaces_partition(spark):
    path = scratch_path(spark, "results")
    res = spark.createDataFrame([("r1", "d", "a", 1), ("r1", "d", "b", 2)], "run_id string, dataset_name string, rule_name string, fail_count int")
    write_results(res, path)
    write_results(res, path)
    write_results(res.withColumn("run_id", F.lit("r2")), path)
    assert spark.read.parquet(path).groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 2), ("r2", 2)]


def test_quarantine_skipped_when_empty(spark):
    a = spark.createDataFrame([(1, True)], "k int, _dq_passed boolean")
    assert write_quarantine(a, scratch_path(spark, "q"), "r1") is False


def test_contracts_read_flatten(spark):
    path = scratch_path(spark, "contracts")
    ct.write_contracts(spark, {n: shipped.load(n) for n in shipped.names()}, path)
    docs = ct.read_contracts(spark, path, ct.WRITTEN_GLOB, recursive=True)
    rules = ct.rules_table(docs)
    orders = ct.collect_rules(rules, "orders")
    assert [r.rule_name for r in orders][:2] == ["orderkey_not_null", "status_known"]
    assert orders[-1].severity == "CRITICAL" and orders[-1].order_by == ("o_orderkey",)
    assert ct.lint(docs).count() == 0
    fw = ct.columns_table(docs).where("dataset_name = 'customer'").count()
    assert fw == 5


def test_contract_lint_finds_problems(spark):
    bad = {
        "apiVersion": "v3.0.0",
        "kind": "Other",
        "dataset": {"name": "x"},
        "quality": [
            {"rule_name": "a", "column": "c", "rule_type": "regexx", "severity": "error"},
            {"rule_name": "a", "column": "c", "rule_type": "not_null"},
        ],
    }
    missing = {"apiVersion": "v3.0.0", "kind": "DataContract", "dataset": {"name": "y"}}
    path = scratch_path(spark, "bad_contracts")
    ct.write_contracts(spark, {"bad": bad, "missing": missing, "broken": "{not json"}, path)
    problems = sorted(r.problem for r in ct.lint(ct.read_contracts(spark, path, ct.WRITTEN_GLOB, recursive=True)).collect())
    assert "this is a 'Other', not a DataContract" in problems
    assert "rule kind 'regexx' is not supported" in problems
    assert "rule lacks its 'severity'" in problems
    assert "duplicate rule_name 'a'" in problems
    assert "required part 'quality' is absent" in problems
    assert "not readable as a contract (bad JSON or a value of the wrong type)" in problems
    assert "rule 'a' is about unknown column 'c'" in problems


def contract(name="x", **changes):
    rule = {"rule_name": "r", "column": "c", "rule_type": "range", "severity": "error", "params": {"min": 1}}
    doc = {
        "apiVersion": "v3.0.0", "kind": "DataContract", "dataset": {"name": name, "columns": [{"name": "c", "type": "string"}]},
        "source": {"path": "x", "format": "csv"}, "silver": {"table_name": f"silver_{name}"}, "quality": [rule],
    }
    return doc | changes


@pytest.mark.parametrize(
    "docs,said",
    [
        ({"a": contract(), "b": contract()}, "has 2 contracts"),
        ({"a": contract(), "b": "{not json"}, "not readable"),
        ({"a": contract(quality=None)}, "'quality' is absent"),
        ({"a": contract(quality=[{"rule_name": "r", "column": "c", "rule_type": "range", "severity": "error", "params": {"min": "zero"}}])}, "not readable"),
        ({"a": contract(quality=[{"rule_name": "r", "column": "c", "rule_type": "checksum", "severity": "error"}])}, "'checksum' is not supported"),
        ({"a": contract(quality=[{"rule_name": "r", "column": "c", "rule_type": "range", "severity": "error"}])}, "no bound"),
        ({"a": contract(quality=[{"rule_name": "r", "column": "d", "rule_type": "not_null", "severity": "error"}])}, "unknown column 'd'"),
    ],
)
def test_refine_runs_nothing_with_bad_contracts(spark, docs, said):
    from covenant.plans.refine import refine_all
    from covenant.session import path_exists

    cpath, base = scratch_path(spark, "contracts"), scratch_path(spark, "lake")
    ct.write_contracts(spark, docs, cpath)
    with pytest.raises(ct.ContractError, match=said):
        refine_all(spark, cpath, scratch_path(spark, "landing"), base, glob=ct.WRITTEN_GLOB, recursive=True)
    assert not path_exists(spark, base)


def test_fixed_width_null_and_too_wide(spark):
    layout = [{"column": "n", "length": 4, "kind": "number"}, {"column": "t", "length": 3}, {"column": "r", "length": 3, "kind": "raw"}]
    df = spark.createDataFrame([(7, "ab", "xyz"), (-12, "abcd", "xyzw"), (12345, None, None), (None, "a", "b")], "n long, t string, r string")
    got = [r[0] for r in df.select(fixed_width_line(layout)).collect()]
    assert got == ["0007ab xyz", "-012abcxyz", "****      ", "    a  b  "]


def test_typed_source_keeps_declared_types(spark):
    from covenant.plans.bronze import read_bronze, run_bronze

    doc = shipped.load("orders")
    land, target = scratch_path(spark, "orders_parquet"), scratch_path(spark, "bronze_orders")
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").write.parquet(land)
    run_bronze(spark, doc, target, scratch_path(spark, "ck"), path=land)
    back = read_bronze(spark, doc, target, land)
    assert dict(back.dtypes)["o_totalprice"] == "double" and dict(back.dtypes)["o_orderkey"] == "bigint"
    assert back.count() == 1500 and back.where("o_totalprice IS NULL OR o_orderdate IS NULL").count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from covenant import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session)


def test_save_table_comment_and_properties(spark):
    from covenant.operators.sinks import save_table

    df = with_comments(spark.createDataFrame([(1, "a")], "k int, v string"), {"k": "key column"})
    save_table(df, "covenant_demo_table", scratch_path(spark, "tbl"), comment="demo table", properties={"quality": "gold"})
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES covenant_demo_table").collect()}
    assert props.get("quality") == "gold"
    assert spark.catalog.getTable("covenant_demo_table").description == "demo table"
    assert column_comments(spark.table("covenant_demo_table")) == [("k", "key column")]
    spark.sql("DROP TABLE covenant_demo_table")


def test_observe_expectations_batch(spark):
    from pyspark.sql import Observation

    from covenant import Rule
    from covenant.operators.routing import observe_expectations, quarantine
    from covenant import check

    df = spark.createDataFrame([("a", 1), (None, 2), ("zz", 3)], "c string, n int")
    rules = [Rule("c_nn", "c", "not_null", "critical"), Rule("c_len", "c", "regex", "critical", {"pattern": "^.$"}), Rule("n_max", "n", "range", "warning", {"max": 2})]
    obs = Observation("exp")
    kept = observe_expectations(df, rules, obs).count()
    assert kept == 3 and obs.get == {"c_nn": 1, "c_len": 1}
    a = check(df, rules)
    assert quarantine(a, rules, severities=["WARNING"]).count() == 1
    assert quarantine(a).count() == 2
