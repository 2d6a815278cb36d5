"""Bronze: a contract's source streamed into a table, with monitor-mode expectations.

The bronze frame is the source read (all-string landing or fixed-width parse)
with lineage columns, cast to the declared column types (``try_cast``, so a
bad value becomes NULL) and carrying the column comments as metadata.  The
CRITICAL rules of the kinds bronze can express are counted per batch; no row is
dropped.
"""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import as_rules
from ..operators.publish import register
from ..operators.routing import expectations
from ..sources.files import INGESTION_TS, RESCUED_FIELDS, RESCUED_KIND, RESCUED_LINE, SOURCE_FILE, read_source, table_schema
from ..streaming.ingest import BATCH_ID, PARTITIONS, STREAM_ID, counted, read_ingested, run_available_now


def declared(df: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """Project to the declared table schema (types and comments), lineage kept."""
    schema = table_schema(contract["dataset"]["columns"], lineage=False)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if dict(df.dtypes).get(f.name) != f.dataType.simpleString():
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))
    extra = [c for c in (RESCUED_LINE, RESCUED_KIND, RESCUED_FIELDS, SOURCE_FILE, INGESTION_TS) if c in df.columns]
    return df.select(*cols, *extra)


def bronze_frame(spark: SparkSession, contract: Mapping[str, Any], path: str | None = None, stream: bool = True) -> DataFrame:
    return declared(read_source(spark, contract, path, stream=stream), contract)


def run_bronze(
    spark: SparkSession,
    contract: Mapping[str, Any],
    target: str,
    checkpoint: str,
    path: str | None = None,
    full_refresh: bool = False,
    table: str | None = None,
) -> Mapping[str, int]:
    """Ingest new files of the contract's source into ``target``; returns the failures per expectation.

    The counts are of every batch that this checkpoint's stream has written.
    ``table`` names a catalog table over the target, with the dataset's
    description and its column comments.
    """
    counters = expectations(contract.get("quality") or [])
    frame = bronze_frame(spark, contract, path)
    run_available_now(frame, target, checkpoint, full_refresh=full_refresh, counters=counters)
    if table:
        schema = T.StructType(frame.schema.fields + [T.StructField(STREAM_ID, T.StringType()), T.StructField(BATCH_ID, T.LongType())])
        register(spark, table, target, schema, partition_by=PARTITIONS, comment=contract["dataset"].get("description") or "", properties={"quality": "bronze"})
    return counted(spark, target, checkpoint)


def read_bronze(spark: SparkSession, contract: Mapping[str, Any], target: str, path: str | None = None) -> DataFrame:
    """The bronze table of a contract; an empty feed gives an empty frame of the contract's schema."""
    return read_ingested(spark, target, bronze_frame(spark, contract, path).schema)
