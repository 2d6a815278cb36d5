"""Incremental file ingestion with Structured Streaming.

A file stream source with a checkpoint reads each file once; the
``availableNow`` trigger processes what is there and stops (a triggered,
non-continuous run).  The sink writes every micro-batch into its own
``(_stream_id, _batch_id)`` partition with dynamic partition overwrite, so a
batch that is replayed after a failure replaces its own output instead of
duplicating it, and feeds with different checkpoints never overwrite each
other: the stream id is the query id that Spark keeps in the checkpoint.

Counters of a batch are taken while the batch is written and stored beside the
target, one row per (stream, batch, counter), replaced like the batch itself.
A full refresh removes the target, its counters and the checkpoint first; with
``run_versioned`` it fills a new version instead, and the former one is the
table until that is complete.
"""

from __future__ import annotations

import json
from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.publish import current_version, new_version, point_to, version_path
from ..session import path_exists, remove_path

BATCH_ID = "_batch_id"
STREAM_ID = "_stream_id"
PARTITIONS = (STREAM_ID, BATCH_ID)
COUNTERS_SCHEMA = f"name string, failed long, {STREAM_ID} string, {BATCH_ID} long"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark stored with the checkpoint when its first query started."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def counters_path(target: str) -> str:
    return f"{target.rstrip('/')}_counters"


def write_batch(df: DataFrame, path: str, stream: str, batch_id: int, fmt: str = "parquet") -> None:
    """Replace the (stream, batch) partition of ``path``."""
    out = df.withColumn(STREAM_ID, F.lit(stream)).withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
    out.write.format(fmt).partitionBy(*PARTITIONS).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def _finish(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def run_foreach_batch(df: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``handler(batch_df, batch_id)`` per micro-batch until the available input is processed."""
    return _finish(df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_available_now(
    df: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    full_refresh: bool = False,
    counters: Mapping[str, Column] | None = None,
) -> StreamingQuery:
    """Run a streaming frame to completion (availableNow) into ``target``; returns the stopped query.

    ``counters`` maps names to pass conditions; rows that fail them are counted
    per batch (see ``counted``), none is dropped.
    """
    spark = df.sparkSession
    if full_refresh:
        for path in (target, counters_path(target), checkpoint):
            remove_path(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, stream = batch.sparkSession, stream_id(batch.sparkSession, checkpoint)
        seen = Observation() if counters else None
        if seen is not None:
            batch = batch.observe(seen, *[F.count_if(~c).alias(f"c{i}") for i, c in enumerate(counters.values())])
        write_batch(batch, target, stream, batch_id, fmt)
        if seen is not None:
            rows = [(name, int(seen.get[f"c{i}"])) for i, name in enumerate(counters)]
            write_batch(session.createDataFrame(rows, "name string, failed long").coalesce(1), counters_path(target), stream, batch_id, fmt)

    return run_foreach_batch(df, write, checkpoint)


def run_versioned(
    df: DataFrame, path: str, fmt: str = "parquet", full_refresh: bool = False, counters: Mapping[str, Column] | None = None
) -> str:
    """``run_available_now`` into the current version below ``path``, whose checkpoint lies in the version's folder; returns that folder.

    A full refresh, and the first run, fill a new version and switch to it when
    it is complete.  If that fails, readers keep the former version, and the next
    run cleans up.
    """
    spark = df.sparkSession
    version = None if full_refresh else current_version(spark, path)
    fresh = version or new_version(spark, path)
    folder = version_path(path, fresh)
    run_available_now(df, f"{folder}/table", f"{folder}/checkpoint", fmt, counters=counters)
    if version is None:
        point_to(spark, path, fresh)
    return folder


def read_versioned(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """The rows of the current version below ``path`` (empty when nothing was ingested)."""
    version = current_version(spark, path)
    return spark.createDataFrame([], schema) if version is None else read_ingested(spark, f"{version_path(path, version)}/table", schema, fmt)


def counted(spark: SparkSession, target: str, checkpoint: str, fmt: str = "parquet") -> dict[str, int]:
    """Failures per counter over all batches that the stream of ``checkpoint`` has written into ``target``."""
    path = counters_path(target)
    if not path_exists(spark, path) or not path_exists(spark, f"{checkpoint}/metadata"):
        return {}
    rows = spark.read.schema(COUNTERS_SCHEMA).format(fmt).load(path).where(F.col(STREAM_ID) == stream_id(spark, checkpoint))
    return {r["name"]: r.n for r in rows.groupBy("name").agg(F.sum("failed").alias("n")).collect()}  # one row per counter


def read_ingested(spark: SparkSession, target: str, schema, fmt: str = "parquet") -> DataFrame:
    """What all streams have written into ``target``, without the partition columns; empty when nothing was."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(target).drop(*PARTITIONS)
