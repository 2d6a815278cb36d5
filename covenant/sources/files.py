"""File sources: delimited and fixed-width feeds, upstream tables, results history.

Delimited feeds land every column as a string (declared schema, no
inference), so nothing is lost before the typed silver casts.  Fixed-width
feeds are read as text lines and parsed with one ``select`` of
``substring`` / ``trim`` / ``try_cast``.  Both work in batch (``spark.read``)
and as streams (``spark.readStream``; the file source plus a checkpoint
gives "each file once").
"""

from __future__ import annotations

import re
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metrics import RESULTS_SCHEMA
from ..session import path_exists

SOURCE_FILE = "_source_file"
INGESTION_TS = "_ingestion_ts"
LINE_LENGTH = "_line_length"
RESCUED_LINE, RESCUED_KIND, RESCUED_FIELDS = "_rescued_line", "_rescued_kind", "_rescued_fields"

# Contract type names accepted for the declared (table) schema;
# anything else declares a string.
TABLE_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _get(obj: Any, key: str, default=None):
    if isinstance(obj, Mapping):
        v = obj.get(key, default)
    else:
        v = getattr(obj, key, default)
    return default if v is None else v


def reader_schema(columns: Iterable[Any]) -> T.StructType:
    """All-string landing schema in contract column order."""
    return T.StructType([T.StructField(_get(c, "name"), T.StringType()) for c in columns])


def table_schema(columns: Iterable[Any], lineage: bool = True) -> T.StructType:
    """Declared schema: contract types plus column comments as field metadata."""
    fields = []
    for c in columns:
        desc = _get(c, "description", "")
        fields.append(
            T.StructField(_get(c, "name"), TABLE_TYPES.get(_get(c, "type", "string"), T.StringType()), True, {"comment": desc} if desc else {})
        )
    if lineage:
        fields += [
            T.StructField(SOURCE_FILE, T.StringType(), True, {"comment": "Path to the source file"}),
            T.StructField(INGESTION_TS, T.TimestampType(), True, {"comment": "Timestamp when the row was ingested"}),
        ]
    return T.StructType(fields)


def with_lineage(df: DataFrame) -> DataFrame:
    """``_source_file`` from the file metadata column and ``_ingestion_ts``."""
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).withColumn(INGESTION_TS, F.current_timestamp())


def rescued(df: DataFrame, n_columns: int, options: Mapping[str, str] | None = None) -> DataFrame:
    """Say of each malformed line what is wrong with it, and keep the fields that have no column.

    ``_rescued_kind`` is ``short`` or ``long`` (too few or too many fields) or
    ``broken`` (a quote that is never closed swallows fields), NULL for a sound
    line; ``_rescued_fields`` holds the fields beyond the declared
    ones.  Fields are told apart outside quotes, on malformed lines only.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    sep, quote = (re.escape(options.get(k, options.get(other, default))) for k, other, default in (("sep", "delimiter", ","), ("quote", "quote", '"')))
    outside = f"{sep}(?=(?:[^{quote}]*{quote}[^{quote}]*{quote})*[^{quote}]*$)" if quote else sep
    fields = F.split(F.col(RESCUED_LINE), outside, -1)
    balanced = F.length(F.regexp_replace(RESCUED_LINE, f"[^{quote}]", "")) % 2 == 0 if quote else F.lit(True)
    n = F.size(fields)
    kind = F.when(~balanced | (n == n_columns), F.lit("broken")).when(n < n_columns, "short").otherwise("long")
    extra = F.when(kind == "long", F.slice(fields, n_columns + 1, F.greatest(n - n_columns, F.lit(0))))
    known = F.col(RESCUED_LINE).isNotNull()
    return df.withColumns({RESCUED_KIND: F.when(known, kind), RESCUED_FIELDS: F.when(known, extra)})


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[Any],
    options: Mapping[str, str] | None = None,
    fmt: str = "csv",
    stream: bool = False,
    lineage: bool = True,
    rescue: bool = False,
) -> DataFrame:
    """Delimited feed with an all-string reader schema; reader options pass through.

    A line that does not fit the columns lands with what fits.  With ``rescue``
    its text is kept too, in ``_rescued_line``, with what ``rescued`` says of it.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt).option("inferSchema", "false")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    schema = reader_schema(columns)
    if rescue:
        schema = T.StructType([*schema.fields, T.StructField(RESCUED_LINE, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED_LINE)
    df = reader.schema(schema).load(path)
    df = rescued(df, len(schema.fields) - 1, options) if rescue else df
    return with_lineage(df) if lineage else df


def fixed_width_columns(fields: Sequence[Any], value: str = "value", charset: str | None = None) -> list[Column]:
    """One Column per field: 1-based substring, optional trim, optional try_cast.

    With a ``charset`` the line is bytes and positions count bytes, so characters
    of several bytes shift nothing; each field is decoded on its own, and one
    whose bytes are no text of that encoding is NULL.
    """
    out = []
    for f in fields:
        c = F.substring(F.col(value), int(_get(f, "start")), int(_get(f, "length")))
        if charset:
            c = F.try_validate_utf8(c.cast("string")) if charset.lower().replace("-", "") == "utf8" else F.decode(c, charset)
        if _get(f, "trim", False):
            c = F.trim(c)
        cast = _get(f, "cast")
        if cast:
            c = c.try_cast(cast)
        out.append(c.alias(_get(f, "name")))
    return out


def parse_fixed_width(df: DataFrame, fields: Sequence[Any], value: str = "value", keep: Sequence[str] = (), charset: str | None = None) -> DataFrame:
    """Parse text lines into fields in declared order, plus ``_line_length`` (bytes with a ``charset``); drops ``value``."""
    extra = [c for c in df.columns if c != value]
    return df.select(*fixed_width_columns(fields, value, charset), F.length(F.col(value)).alias(LINE_LENGTH), *extra)


def read_fixed_width(
    spark: SparkSession, path: str, fields: Sequence[Any], stream: bool = False, lineage: bool = True, charset: str | None = None
) -> DataFrame:
    """Fixed-width lines; positions count characters of UTF-8 text, or bytes of the declared ``charset``.

    The text source hands over the bytes of a line as they are (it splits at
    line feeds), so they are cut before they are decoded.
    """
    reader = spark.readStream if stream else spark.read
    raw = reader.format("text").load(path)
    if lineage:
        raw = with_lineage(raw)
    if charset:
        raw = raw.withColumn("value", F.col("value").cast("binary"))
    return parse_fixed_width(raw, fields, charset=charset)


# Formats that carry types: read with the contract's types instead of all-string.
TYPED_FORMATS = ("parquet", "orc", "avro")


def read_typed(spark: SparkSession, path: str, columns: Sequence[Any], fmt: str, stream: bool = False) -> DataFrame:
    """A typed feed with the contract's declared columns and types, and lineage."""
    reader = spark.readStream if stream else spark.read
    return with_lineage(reader.format(fmt).schema(table_schema(columns, lineage=False)).load(path))


def read_source(spark: SparkSession, contract: Mapping[str, Any], path: str | None = None, stream: bool = False) -> DataFrame:
    """Bronze read of a contract's source: text + fixed-width fields, or a delimited format."""
    source = contract["source"]
    path = path or source["path"]
    fields = source.get("fixed_width_columns")
    if source.get("format") == "text" and fields:
        return read_fixed_width(spark, path, fields, stream=stream, charset=(source.get("options") or {}).get("charset"))
    if source.get("format") in TYPED_FORMATS:
        return read_typed(spark, path, contract["dataset"]["columns"], source["format"], stream=stream)
    return read_delimited(
        spark, path, contract["dataset"]["columns"], source.get("options") or {}, source.get("format") or "csv", stream=stream, rescue=bool(source.get("rescue"))
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Upstream table scan by path (or by catalog name when ``fmt == 'table'``)."""
    if fmt == "table":
        return spark.read.table(path)
    return spark.read.format(fmt).load(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def read_results_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The quality-results table, or an empty typed frame when it does not exist yet.

    Read with the declared schema, so partition values (run ids such as
    ``2024-06-30``) stay strings instead of being inferred as dates or numbers.
    """
    schema = nullable(RESULTS_SCHEMA)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames())
