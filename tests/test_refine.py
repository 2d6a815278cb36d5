"""Several datasets refined at a time: same results, and one that fails leaves the others published."""

import threading

import pytest
from pyspark.sql import functions as F

from covenant.operators.publish import current_version, read_published
from covenant.plans import refine as module
from covenant.plans.refine import RefineError, refine_all
from covenant.session import scratch_path
from covenant.sources import contracts as ct


def contract(name, expr="CAST(v AS INT)"):
    return {
        "apiVersion": "v3.0.0", "kind": "DataContract", "id": name, "dataset": {"name": name, "columns": [{"name": "k", "type": "string"}, {"name": "v", "type": "string"}]},
        "source": {"path": name, "format": "csv", "options": {"header": "true"}}, "silver": {"table_name": f"silver_{name}", "transforms": [{"column": "v", "expr": expr}]},
        "quality": [{"rule_name": "k_unique", "column": "k", "rule_type": "unique", "severity": "error", "params": {}}],
    }


def lake(spark, names, **contracts):
    root, cpath = scratch_path(spark, "landing"), scratch_path(spark, "contracts")
    for i, n in enumerate(names):
        spark.range(20 + i).selectExpr(f"CAST(id % {18 - i} AS string) AS k", "CAST(id AS string) AS v").write.option("header", "true").csv(f"{root}/{n}")
    ct.write_contracts(spark, {n: contracts.get(n, contract(n)) for n in names}, cpath)
    return cpath, root, scratch_path(spark, "lake")


def rows(df):
    return sorted((r.dataset_name, r.rule_name, r.total_count, r.fail_count) for r in df.collect())


def test_side_by_side_equals_one_by_one(spark):
    names = ["a", "b", "c"]
    cpath, root, _ = lake(spark, names)
    out = [rows(refine_all(spark, cpath, root, scratch_path(spark, "lake"), run_id="r", glob=ct.WRITTEN_GLOB, recursive=True, parallel=n)) for n in (1, 3)]
    assert out[0] == out[1] == [("a", "k_unique", 20, 2), ("b", "k_unique", 21, 4), ("c", "k_unique", 22, 6)]


def test_a_failing_dataset_leaves_the_others_published(spark):
    names = ["a", "bad", "c"]
    cpath, root, base = lake(spark, names, bad=contract("bad", "IF(k = '7', raise_error('broken row'), v)"))
    with pytest.raises(RefineError, match="bad: .*") as e:
        refine_all(spark, cpath, root, base, run_id="r", glob=ct.WRITTEN_GLOB, recursive=True)
    assert list(e.value.failed) == ["bad"] and "a:" not in str(e.value)
    assert [read_published(spark, f"{base}/silver_{n}").count() for n in ("a", "c")] == [18, 16]
    assert current_version(spark, f"{base}/silver_bad") is None
    assert {r.dataset_name for r in spark.read.parquet(f"{base}/dq_results").select(F.col("dataset_name")).collect()} == {"a", "c"}


def test_jobs_run_in_the_pool_of_their_dataset(spark):
    seen, met = {}, threading.Barrier(2, timeout=60)

    def work(name):
        met.wait()  # both are under way at a time
        seen[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    assert module._each_in_its_pool(spark, ["x", "y"], work, 2) == {}
    assert seen == {"x": "refine-x", "y": "refine-y"} and not spark.sparkContext.getLocalProperty("spark.scheduler.pool")
