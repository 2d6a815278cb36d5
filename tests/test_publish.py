"""Atomic refresh: the former version can be read until the switch, whatever happens to a write."""

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from covenant.operators.publish import current_version, publish, publish_table, read_published, register, version_path, versions
from covenant.operators.sinks import table_facts
from covenant.session import path_exists, scratch_path


def broken(spark, n, at):
    row = F.when(F.col("id") == at, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(0, n, 1, 4).select(row.cast("long").alias("id"))


def test_a_write_that_breaks_leaves_the_former_table(spark):
    path = scratch_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    with pytest.raises(SparkRuntimeException):
        publish(broken(spark, 10, 9), path)
    assert current_version(spark, path) is None
    publish(spark.range(5), path)
    assert len(versions(spark, path)) == 1  # the unfinished first write is gone
    first, held = current_version(spark, path), read_published(spark, path)
    with pytest.raises(SparkRuntimeException):
        publish(broken(spark, 10, 9), path)
    assert current_version(spark, path) == first and read_published(spark, path).count() == 5
    publish(spark.range(7), path)
    assert read_published(spark, path).count() == 7 and held.count() == 5  # a reader of the old version can finish
    publish(spark.range(8), path)
    assert not path_exists(spark, version_path(path, first)) and len(versions(spark, path)) == 2


def test_a_lost_switch_leaves_the_former_table(spark, monkeypatch):
    from covenant.operators import publish as module

    path = scratch_path(spark, "published")
    publish(spark.range(3), path)
    monkeypatch.setattr(module, "point_to", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        publish(spark.range(4), path)
    monkeypatch.undo()
    assert read_published(spark, path).count() == 3
    publish(spark.range(4), path)
    assert read_published(spark, path).count() == 4 and len(versions(spark, path)) == 2


def test_partitioned_and_empty_versions(spark):
    path = scratch_path(spark, "published")
    df = spark.range(6).selectExpr("id", "id % 2 AS p")
    publish(df, path, partition_by=["p"])
    assert sorted(r.p for r in read_published(spark, path).select("p").distinct().collect()) == [0, 1]
    publish(df.limit(0), path)
    assert read_published(spark, path, schema=df.schema).count() == 0


def test_catalog_table_moves_and_takes_new_columns(spark):
    path = scratch_path(spark, "published")
    name = f"moved_{path[-12:]}"
    publish_table(spark.range(3).withMetadata("id", {"comment": "it's the key"}), name, path, "c'1", {"quality": "gold"})
    held = spark.table(name)
    assert held.schema["id"].metadata["comment"] == "it's the key"
    publish_table(spark.range(4), name, path, "second", {"quality": "gold", "team": "me"})
    assert spark.table(name).count() == 4 and held.count() == 3
    with pytest.raises(SparkRuntimeException):
        publish_table(broken(spark, 10, 9), name, path, "third")
    assert spark.table(name).count() == 4
    publish_table(spark.range(2).withColumn("z", F.lit("z")), name, path, "new columns", {"quality": "gold"})
    assert spark.table(name).columns == ["id", "z"] and spark.table(name).count() == 2
    assert {(r.property, r.value) for r in table_facts(spark, name).collect()} == {("quality", "gold"), ("comment", "new columns")}
    spark.sql(f"DROP TABLE {name}")


def test_registered_run_partitions_grow(spark):
    from covenant.operators.sinks import write_run_partition

    path = scratch_path(spark, "runs")
    name, df = f"runs_{path[-12:]}", spark.range(3).selectExpr("id", "'2024-01-01' AS run_id")
    for run in ("2024-01-01", "2024-01-02", "2024-01-02"):
        write_run_partition(df.withColumn("run_id", F.lit(run)), path)
        register(spark, name, path, df.schema, partition_by=["run_id"], comment="runs", properties={"quality": "results"})
    assert sorted((r.run_id, r["count"]) for r in spark.table(name).groupBy("run_id").count().collect()) == [("2024-01-01", 3), ("2024-01-02", 3)]
    spark.sql(f"DROP TABLE {name}")
