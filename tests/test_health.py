"""Incremental rule health equals the rollup of the whole history, whatever is repeated."""

import pytest
from pyspark.sql import functions as F

from covenant.plans.health import ClosedRuns, health_report, read_health, update_health
from covenant.plans.marts import rule_health
from covenant.session import scratch_path

SCHEMA = "run_id string, run_timestamp timestamp, dataset_name string, rule_name string, severity string, fail_count long, fail_pct double"


def run(spark, run_id, day, **fails):
    rows = [(run_id, f"2024-01-{day:02d} 00:00:00", "d", rule, sev, n, float(n)) for rule, (sev, n) in fails.items()]
    return spark.createDataFrame(rows, SCHEMA.replace("timestamp timestamp", "timestamp string")).withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp"))


def report(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_updates_equal_recomputation_with_reruns(spark):
    path = scratch_path(spark, "health")
    assert health_report(read_health(spark, path)).collect() == []
    a = run(spark, "a", 1, r1=("CRITICAL", 3), r2=("ERROR", 0))
    b = run(spark, "b", 2, r1=("CRITICAL", 9), r3=("WARNING", 7))
    b2 = run(spark, "b", 2, r1=("CRITICAL", 1), r2=("ERROR", 0))  # repaired: the worst share of r1 falls back, r3 is gone
    c = run(spark, "c", 3, r1=("CRITICAL", 0))
    a2 = run(spark, "a", 1, r1=("CRITICAL", 20))
    history = a
    update_health(spark, path, a)
    assert report(health_report(read_health(spark, path))) == report(rule_health(history, ordered=False))
    for step, history in ((b, a.union(b)), (b, a.union(b)), (b2, a.union(b2)), (c, a.union(b2).union(c)), (c, a.union(b2).union(c))):
        update_health(spark, path, step)
        assert report(health_report(read_health(spark, path))) == report(rule_health(history, ordered=False))
    with pytest.raises(ClosedRuns):
        update_health(spark, path, a2)
    history = a2.union(b2).union(c)
    update_health(spark, path, a2, history)
    assert report(health_report(read_health(spark, path))) == report(rule_health(history, ordered=False))
    update_health(spark, path, run(spark, "d", 4, r1=("CRITICAL", 2)))
    assert health_report(read_health(spark, path)).where("rule_name = 'r1'").first().total_runs_checked == 4


def test_an_update_reads_no_earlier_results(spark):
    path = scratch_path(spark, "health")
    for i in range(3):
        results = scratch_path(spark, "results")
        run(spark, f"r{i}", i + 1, r1=("ERROR", i)).write.parquet(results)
        update_health(spark, path, spark.read.parquet(results))
    files = {f for f in read_health(spark, path).inputFiles()}
    assert files and all("health" in f for f in files)
    r = health_report(read_health(spark, path)).first()
    assert (r.latest_run_fail_pct, r.total_runs_checked, r.runs_with_failures, r.max_fail_pct_ever) == (2.0, 3, 2, 2.0)
