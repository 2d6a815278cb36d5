"""Joins with heavy keys: the plain join's rows, and no task that holds a whole key."""

import pytest
from pyspark.sql import functions as F

from covenant.operators import joins
from covenant.operators.joins import heavy_join, heavy_keys


def sides(spark):
    left = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE CAST(id % 700 AS string) END AS k", "map('a', id) AS m")
    right = spark.range(900).selectExpr("id AS rid", "CASE WHEN id % 30 = 0 THEN 'hot' WHEN id % 40 = 1 THEN NULL ELSE CAST(id AS string) END AS k")
    return left.repartition(4), right.repartition(3)


@pytest.mark.parametrize("heavy_rows,most", [(10**9, 100_000), (100, 100_000), (7, 100_000), (100, 0)])
def test_heavy_join_equals_the_plain_join(spark, monkeypatch, heavy_rows, most):
    monkeypatch.setattr(joins, "HEAVY_KEYS", most)
    left, right = sides(spark)
    want = left.join(right, "k")
    got = heavy_join(left, right, "k", heavy_rows)
    assert got.columns == want.columns
    rows = lambda df: sorted((r.k, r.id, r.rid) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(want)) > 30_000


def test_heavy_keys_are_few_and_both_sided(spark):
    left, right = sides(spark)
    assert [tuple(r) for r in heavy_keys(left, right, "k", 100).collect()] == [("hot", 10, 1)]
    assert heavy_keys(left, right.where("k <> 'hot'"), "k", 100).collect() == []
    assert heavy_join(left.limit(0), right, "k", 10).collect() == []


def test_no_task_is_above_twice_the_median(spark):
    left = spark.range(60_000).selectExpr("id", "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS k")
    right = spark.range(60_000).where("id % 3 <> 0").selectExpr("CAST(id AS string) AS k", "id AS rid").union(spark.sql("SELECT 'hot', -1L"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        size = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain, dealt = size(left.join(right, "k")), size(heavy_join(left, right, "k", 100))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert plain[-1] > 5 * plain[len(plain) // 2]
    assert sum(dealt) == sum(plain) and dealt[-1] <= 2 * dealt[len(dealt) // 2]
