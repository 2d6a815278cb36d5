"""Injectors are deterministic and exactly caught by the paired rule."""

from pyspark.sql import functions as F

from covenant.operators import anomalies as an
from covenant.plans import catalog

SF = "/root/testdata/sf0.001"


def test_inject_then_detect_exact(spark):
    rows = catalog.an_detect(spark, SF).collect()
    assert rows and all(r.injected == r.detected == r.both and r.injected > 0 for r in rows)


def test_picks_do_not_depend_on_partitioning(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    a = an.inject_null(o.repartition(1), "o_custkey", 0.1, "o_orderkey").where("o_custkey IS NULL").select("o_orderkey")
    b = an.inject_null(o.repartition(7), "o_custkey", 0.1, "o_orderkey").where("o_custkey IS NULL").select("o_orderkey")
    assert sorted(a.collect()) == sorted(b.collect())


def test_report_counts_marks(spark):
    rep = {r.anomaly: r.rows for r in catalog.an_report(spark, SF).collect()}
    marks = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    assert set(rep) == {"total", "clean", *marks} and rep["total"] == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_duplicates_reuse_existing_keys(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_name")
    out = an.inject_duplicates(c, "c_name", 0.2, "c_custkey", donors=5, track=True)
    picked = out.where("_an_c_name").select("c_name").distinct().collect()
    original = {r.c_name for r in c.collect()}
    assert picked and len(picked) <= 5 and all(r.c_name in original for r in picked)
    assert out.count() == c.count()


def test_truncate_lengths(spark):
    lines = spark.range(200).select(F.col("id"), F.lit("x" * 80).alias("value"))
    out = an.inject_truncate(lines, "value", 0.5, "id", 30, 70)
    lens = {r[0] for r in out.select(F.length("value")).distinct().collect()}
    assert 80 in lens and all(30 <= n <= 70 for n in lens - {80})


def test_hash_sample_is_spread_merges_and_does_not_depend_on_the_layout(spark):
    from covenant.operators.anomalies import hash_sample

    df = spark.range(20_000).selectExpr("id % 10000 AS k").union(spark.sql("SELECT CAST(NULL AS bigint)"))
    sample = lambda d, n: sorted(r["_v"] for r in hash_sample(d, "k", n).collect())
    got = sample(df, 100)
    assert len(set(got)) == 100 and got == sample(df.repartition(7), 100)
    assert all(8 <= sum(a <= v < a + 2500 for v in got) <= 45 for a in range(0, 10_000, 2500))  # all over the key range
    halves = [df.where(f"k % 2 = {i}") for i in (0, 1)]
    both = spark.createDataFrame([(v,) for h in halves for v in sample(h, 100)], "k long")
    assert sample(both, 100) == got
    assert sample(df.where("k < 30"), 100) == list(range(30)) and sample(df.limit(0), 5) == []
