"""Atomic refresh: a table is written as a new version, and becomes the table by one switch.

A table's folder holds its versions and a pointer to the current one::

    <path>/_versions/<version>/...   whole tables, each written once
    <path>/_current                  the name of the current version

``publish`` writes the new version beside the current one and then replaces the
pointer by a rename.  A write that fails half way leaves an unfinished version
that nothing points to; readers go on reading the former table, and the next
publish removes what is neither current nor new.  The version before the
current one stays until then, so that readers that began with it can finish.

``publish_table`` does the same for a catalog table: its location is switched.
``register`` gives any folder that Spark writes (also partitioned run and batch
folders) a catalog table with comment, column comments and properties.

One writer per table at a time is assumed, as for any overwrite.
"""

from __future__ import annotations

import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import _hadoop, remove_path
from .sinks import _quoted

VERSIONS, CURRENT = "_versions", "_current"


def version_path(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{version}"


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that the pointer names; None if nothing was published."""
    p, fs = _hadoop(spark, f"{path.rstrip('/')}/{CURRENT}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of all versions on disk, finished or not."""
    p, fs = _hadoop(spark, f"{path.rstrip('/')}/{VERSIONS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def new_version(spark: SparkSession, path: str) -> str:
    """A fresh version name; what is not current is removed first (older versions, unfinished writes)."""
    now = current_version(spark, path)
    for v in versions(spark, path):
        if v != now:
            remove_path(spark, version_path(path, v))
    return uuid.uuid4().hex


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one: the pointer is written beside its place and renamed over it."""
    target, fs = _hadoop(spark, f"{path.rstrip('/')}/{CURRENT}")
    beside, _ = _hadoop(spark, f"{path.rstrip('/')}/_next-{version}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.isAbsolute() and target.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(beside, target, over)


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace the table below ``path`` by ``df``; returns the folder of the new version."""
    spark = df.sparkSession
    version = new_version(spark, path)
    writer = df.write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(version_path(path, version))
    point_to(spark, path, version)
    return version_path(path, version)


def read_published(spark: SparkSession, path: str, fmt: str = "parquet", schema: "T.StructType | str | None" = None) -> DataFrame:
    """The current version of the table below ``path``."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing was published below {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(version_path(path, version))


def _columns_ddl(schema: T.StructType) -> str:
    def one(f: T.StructField) -> str:
        said = f.metadata.get("comment") if f.metadata else None
        return f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" + (f" COMMENT {_quoted(said)}" if said else "")

    return ", ".join(map(one, schema.fields))


def _create(spark: SparkSession, name: str, location: str, schema: T.StructType, fmt: str, partition_by: Sequence[str], comment: str, properties: Mapping[str, str]) -> None:
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    kept = f" TBLPROPERTIES ({', '.join(f'{_quoted(k)} = {_quoted(v)}' for k, v in properties.items())})" if properties else ""
    spark.sql(f"CREATE TABLE {name} ({_columns_ddl(schema)}) USING {fmt}{parts} LOCATION {_quoted(location)} COMMENT {_quoted(comment)}{kept}")


def _facts(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def register(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> str:
    """The catalog table ``name`` over ``location``, with comment, column comments and properties.

    An existing table of the same columns is moved to ``location`` by one catalog
    change.  With other columns, a table made beside it takes its name; between
    the two changes the name is missing from the catalog, its files are not.
    """
    properties = dict(properties or {})
    ordered = T.StructType([f for f in schema.fields if f.name not in partition_by] + [schema[c] for c in partition_by])
    if not spark.catalog.tableExists(name):
        _create(spark, name, location, ordered, fmt, partition_by, comment, properties)
    elif _facts(spark.table(name).schema) == _facts(ordered):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(location)}")
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
        if properties:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{_quoted(k)} = {_quoted(v)}' for k, v in properties.items())})")
    else:
        beside = f"{name}__next"
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        _create(spark, beside, location, ordered, fmt, partition_by, comment, properties)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    return name


def publish_table(
    df: DataFrame, name: str, path: str, comment: str = "", properties: Mapping[str, str] | None = None, fmt: str = "parquet"
) -> str:
    """Publish ``df`` below ``path`` and switch the catalog table ``name`` to the new version."""
    return register(df.sparkSession, name, publish(df, path, fmt), df.schema, fmt, comment=comment, properties=properties)
