"""Streams (each file once, rerun, full refresh), bronze expectations, silver end to end."""

import pytest



from covenant.operators.publish import read_published
from covenant.plans.bronze import run_bronze
from covenant.plans.silver import run_silver
from covenant.session import scratch_path
from covenant.sources import shipped
from covenant.sources.files import read_delimited
from covenant.streaming.ingest import run_available_now

COLS = [{"name": "k"}, {"name": "v"}]


def land(spark, path, rows):
    spark.createDataFrame(rows, "k string, v string").write.mode("append").option("header", "true").csv(path)


def test_each_file_once_and_rerun(spark):
    src, target, ckpt = scratch_path(spark, "src"), scratch_path(spark, "t"), scratch_path(spark, "c")
    land(spark, src, [("a", "1"), ("b", "2")])
    stream = lambda: read_delimited(spark, src, COLS, {"header": "true"}, stream=True)
    run_available_now(stream(), target, ckpt)
    run_available_now(stream(), target, ckpt)
    assert spark.read.parquet(target).count() == 2
    land(spark, src, [("c", "3")])
    run_available_now(stream(), target, ckpt)
    assert spark.read.parquet(target).count() == 3
    run_available_now(stream(), target, scratch_path(spark, "c2"), full_refresh=True)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_bronze_expectations_are_observed_not_dropped(spark):
    contract = shipped.load("customer")
    src = scratch_path(spark, "cust")
    rows = [("1", "Customer#000000001", "3", "10.5", "BUILDING"), (None, "bad", "3", "-1", "X")]
    spark.createDataFrame(rows, "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string").write.option(
        "header", "true"
    ).option("delimiter", "|").csv(src)
    target = scratch_path(spark, "bronze")
    counters = run_bronze(spark, contract, target, scratch_path(spark, "ck"), path=src)
    assert spark.read.parquet(target).count() == 2
    assert counters.get("custkey_not_null") == 1 and counters.get("name_format") == 1


def test_silver_end_to_end_routes_and_is_rerun_safe(spark):
    contract = shipped.load("customer")
    rows = [("1", " Customer#000000001 ", "3", "10.5", " building"), ("1", "Customer#000000002", "3", "5", "BUILDING"), ("3", "Customer#000000003", "x", "-1", "BUILDING")]
    bronze = spark.createDataFrame(rows, "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string")
    base = scratch_path(spark, "lake")
    for _ in range(2):
        out = run_silver(spark, bronze, contract, base, run_id="run-1", run_ts="2024-01-01 00:00:00")
    clean = out.clean.collect()
    assert [(r.c_custkey, r.c_name, r.c_mktsegment, r.c_nationkey) for r in clean] == [(1, "Customer#000000001", "BUILDING", 3)]
    assert out.quarantined is True
    q = spark.read.parquet(f"{base}/customer_quarantine")
    assert q.count() == 2
    res = {r.rule_name: r.fail_count for r in spark.read.parquet(f"{base}/dq_results").collect()}
    assert res == {"custkey_not_null": 0, "custkey_unique": 1, "name_format": 0, "segment_valid": 0, "acctbal_min": 1}
    assert out.messages and out.messages[0].startswith("custkey_unique")
    assert read_published(spark, f"{base}/silver_customer").count() == 1  # clean rows and nothing else


def test_empty_run_id_gets_uuid(spark):
    from covenant.plans.silver import resolve_run_id

    a, b = resolve_run_id(""), resolve_run_id(None)
    assert a and b and a != b and resolve_run_id("x") == "x"


def test_silver_quarantine_severities_keeps_complement(spark):
    contract = shipped.load("customer")
    rows = [("1", "Customer#000000001", "3", "-5", "BUILDING"), ("2", "Customer#000000002", "3", "5", "BOATS")]
    bronze = spark.createDataFrame(rows, "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string")
    base = scratch_path(spark, "lake_sev")
    out = run_silver(spark, bronze, contract, base, run_id="r", run_ts="2024-01-01 00:00:00", quarantine_severities=["ERROR"])
    assert [r.c_custkey for r in out.clean.collect()] == [1]  # the WARNING-only failure stays clean
    assert [r.c_custkey for r in spark.read.parquet(f"{base}/customer_quarantine").collect()] == [2]


def test_silver_job_count_does_not_grow_with_rules(spark):
    from covenant import Rule

    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    contract = {"dataset": {"name": "orders"}, "silver": {"table_name": "silver_orders", "transforms": []}}
    sc = spark.sparkContext
    counts = []
    for n in (2, 20):
        rules = [Rule(f"r{i}", "o_totalprice", "range", "warning", {"max": 1000 * (i + 1)}) for i in range(n)]
        group = f"silver-jobs-{n}"
        sc.setJobGroup(group, group)
        run_silver(spark, o, contract, scratch_path(spark, "jobs"), rules=rules, run_id="r", run_ts="2024-01-01 00:00:00")
        counts.append(len(sc.statusTracker().getJobIdsForGroup(group)))
    sc.setJobGroup("", "")
    assert counts[0] == counts[1]


ORDER = {"dataset": {"name": "o"}, "silver": {"table_name": "silver_o"}}


def test_gate_stops_before_the_silver_table(spark):
    from covenant import Rule
    from covenant.operators.metrics import DataQualityException
    from covenant.session import path_exists

    base = scratch_path(spark, "gate")
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    with pytest.raises(DataQualityException):
        run_silver(spark, df, ORDER, base, rules=[Rule("v_nn", "v", "not_null", "critical")], run_id="r", mode="fail")
    assert not path_exists(spark, f"{base}/silver_o")
    assert [r.k for r in spark.read.parquet(f"{base}/o_quarantine").collect()] == [1]
    assert spark.read.parquet(f"{base}/dq_results").count() == 1


def test_silver_of_an_empty_feed(spark):
    from covenant import Rule

    base = scratch_path(spark, "empty")
    out = run_silver(spark, spark.createDataFrame([], "k int, v string"), ORDER, base, rules=[Rule("v_nn", "v", "not_null", "critical")], run_id="r")
    assert out.clean.collect() == [] and out.clean.columns[:2] == ["k", "v"] and not out.quarantined
    assert [(r.total_count, r.fail_count) for r in out.results.collect()] == [(0, 0)]


def test_silver_is_replaced_in_a_dynamic_overwrite_session(spark):
    from covenant import Rule

    base, rules = scratch_path(spark, "dynamic"), [Rule("v_nn", "v", "not_null", "error")]
    kept = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for rows in ([(1, None), (2, "x")], [(3, "y")]):
            out = run_silver(spark, spark.createDataFrame(rows, "k int, v string"), ORDER, base, rules=rules, run_id="run: 1/2")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", kept)
    assert [r.total_count for r in out.results.collect()] == [1] and out.annotated.count() == 1
    assert spark.read.schema("k int, run_id string").parquet(f"{base}/o_quarantine").count() == 0  # nothing stale is left


def test_empty_landing_folder_gives_an_empty_bronze_table(spark):
    from covenant.plans.bronze import read_bronze

    contract, land, target = shipped.load("customer"), scratch_path(spark, "nothing"), scratch_path(spark, "bronze")
    spark.createDataFrame([], "value string").write.text(land)
    assert set(run_bronze(spark, contract, target, scratch_path(spark, "ck"), path=land).values()) <= {0}
    assert read_bronze(spark, contract, target, land).count() == 0


def _checked(spark, src, ckpt, rules, fail_at=None):
    """Failing ids of each micro-batch (one file a batch); ``fail_at`` breaks that batch after its work."""
    from covenant.operators.checks import PASSED
    from covenant.streaming.batches import run_checked

    seen = {}

    def keep(annotated, batch_id):
        seen[batch_id] = (annotated.count(), sorted(r.id for r in annotated.where(f"NOT {PASSED}").collect()))
        if batch_id == fail_at:
            raise RuntimeError("lost")

    stream = spark.readStream.schema("id int, k string, v int").option("maxFilesPerTrigger", 1).parquet(src)
    try:
        query = run_checked(stream, rules, keep, ckpt)
    except Exception:
        assert fail_at is not None
        query = None
    return seen, query


def test_unique_across_batches_is_the_same_when_a_batch_is_replayed(spark):
    from covenant import Rule

    src, ckpt = scratch_path(spark, "batches"), scratch_path(spark, "ck")
    rules = [Rule("u", "k", "unique", order_by=("id",)), Rule("u2", "v", "unique"), Rule("nn", "k", "not_null")]
    feeds = [[(1, "a", 1), (2, "b", None), (3, None, 3)], [(4, "a", 4), (5, "c", 5), (6, "c", 6), (7, None, 7)], [(8, "c", 8), (9, "d", 3), (10, "e", 10)]]
    for rows in feeds:
        spark.createDataFrame(rows, "id int, k string, v int").coalesce(1).write.mode("append").parquet(src)
    first, _ = _checked(spark, src, ckpt, rules, fail_at=1)
    assert first == {0: (3, [3]), 1: (4, [4, 6, 7])}
    again, _ = _checked(spark, src, ckpt, rules)  # batch 1 is replayed from the state before it
    assert again == {1: (4, [4, 6, 7]), 2: (3, [8, 9])}
    spark.createDataFrame([(11, "e", 11), (12, "f", 12)], "id int, k string, v int").coalesce(1).write.mode("append").parquet(src)
    later, _ = _checked(spark, src, ckpt, rules)  # a new start knows the keys of all earlier ones
    assert later == {3: (2, [11])}
    other, _ = _checked(spark, src, scratch_path(spark, "ck"), rules)  # another stream has keys of its own
    assert {i for _, ids in other.values() for i in ids} == {3, 4, 6, 7, 8, 9, 11}
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false") == "false"


def test_a_batch_reads_its_own_rows_only(spark):
    from covenant import Rule

    src, ckpt = scratch_path(spark, "batches"), scratch_path(spark, "ck")
    for b in range(6):
        spark.range(200).selectExpr(f"CAST(id + {200 * b} AS int) AS id", f"CAST(id + {150 * b} AS string) AS k", "1 AS v").coalesce(1).write.mode("append").parquet(src)
    seen, query = _checked(spark, src, ckpt, [Rule("u", "k", "unique", order_by=("id",))])
    assert [len(ids) for _, ids in seen.values()] == [0, 50, 50, 50, 50, 50]
    states = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
    assert [s.numRowsUpdated for s in states] == [200, 150, 150, 150, 150, 150] and states[-1].numRowsTotal == 950
    assert any("rocksdb" in k.lower() for k in states[-1].customMetrics)


def test_checked_stream_without_unique_or_rules(spark):
    from covenant import Rule

    src = scratch_path(spark, "batches")
    spark.createDataFrame([(1, None, 1), (2, "b", 2)], "id int, k string, v int").coalesce(1).write.parquet(src)
    assert _checked(spark, src, scratch_path(spark, "ck"), [Rule("nn", "k", "not_null")])[0] == {0: (2, [1])}
    assert _checked(spark, src, scratch_path(spark, "ck"), [])[0] == {0: (2, [])}
