"""Sinks: refreshed tables, rerun-safe run partitions, delimited and fixed-width files.

Rerun safety: results and quarantine are partitioned by ``run_id`` and
written with dynamic partition overwrite, so writing the same run twice
replaces that run's partition instead of appending a second copy.  No sink
coalesces to one file; at scale every task writes its own part file.
"""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import path_exists, remove_path
from .checks import PASSED


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    # static: a refresh replaces the whole table, whatever the session's overwrite mode is
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_run_partition(df: DataFrame, path: str, run_col: "str | Sequence[str]" = "run_id", fmt: str = "parquet") -> str:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    cols = [run_col] if isinstance(run_col, str) else list(run_col)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*cols)
        .save(path)
    )
    return path


def write_results(results: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Results of one run and dataset replace exactly that (run_id, dataset_name) partition,
    so datasets refined under one run id never overwrite each other."""
    return write_run_partition(results, path, ["run_id", "dataset_name"], fmt)


def drop_run_partition(spark, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Remove what an earlier attempt of ``run_id`` left in ``path``; Spark itself says which folders that is."""
    if not path_exists(spark, path):
        return
    files = spark.read.schema("run_id string").format(fmt).load(path).where(F.col("run_id") == run_id)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    for r in files.select(folder.alias("folder")).distinct().collect():  # one folder per run
        remove_path(spark, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(r.folder)).toString())


def write_quarantine(
    annotated: DataFrame,
    path: str,
    run_id: str,
    fmt: str = "parquet",
    condition: Column | None = None,
    known_nonempty: bool | None = None,
) -> bool:
    """Write failing rows (or rows matching ``condition``) for ``run_id``.

    Without such rows, what an earlier attempt of the run wrote is removed, and
    False is returned.  ``known_nonempty`` skips the emptiness probe when the
    caller already knows the answer (e.g. from the per-rule fail counts).
    """
    bad = annotated.where(~F.col(PASSED) if condition is None else condition)
    if known_nonempty is False or (known_nonempty is None and bad.isEmpty()):
        drop_run_partition(annotated.sparkSession, path, run_id, fmt)
        return False
    write_run_partition(bad.withColumn("run_id", F.lit(run_id)), path, "run_id", fmt)
    return True


def write_delimited(df: DataFrame, path: str, delimiter: str = ",", header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", str(header).lower()).option("delimiter", delimiter).csv(path)
    return path


def fixed_width_line(layout: Sequence[Mapping[str, Any]]) -> Column:
    """Assemble one text line from a layout of fields; every field has its full length.

    Each field: ``{"column", "length", "kind"}`` with kind ``number``
    (zero-filled, sign first: ``%0Nd``), ``text`` (right-padded, cut to
    length) or ``raw`` (an already formatted string, padded and cut like
    text).  NULL is blanks in every kind.  A number too wide for its field is
    asterisks, which no cast reads back, rather than a shortened number.
    """
    parts = []
    for f in layout:
        c, n, kind = F.col(f["column"]), int(f["length"]), f.get("kind", "text")
        if kind == "number":
            digits = F.format_string(f"%0{n}d", c.cast("long"))
            shown = F.when(F.length(digits) > n, F.lit("*" * n)).otherwise(digits)
            parts.append(F.when(c.isNull(), F.lit(" " * n)).otherwise(shown))
        else:
            parts.append(F.rpad(F.coalesce(c.cast("string"), F.lit("")), n, " "))
    return F.concat(*parts)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments as field metadata (kept through a parquet round trip)."""
    for name, text in comments.items():
        if text and name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def column_comments(df: DataFrame) -> list[tuple[str, str]]:
    """(column, comment) pairs from the schema metadata (schema only, no job)."""
    return [(f.name, f.metadata.get("comment", "")) for f in df.schema.fields if f.metadata.get("comment")]


def _quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def save_table(
    df: DataFrame,
    name: str,
    path: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> str:
    """Catalog table over ``path`` with a table comment and table properties.

    Column comments travel in the schema metadata (``with_comments``).
    """
    df.write.mode(mode).format(fmt).option("path", path).option("partitionOverwriteMode", "static").saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        items = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({items})")
    return name


def table_facts(spark, name: str) -> DataFrame:
    """(property, value) of a catalog table, its comment included."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").select(F.col("key").alias("property"), "value")
    said = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'")
    return rows.where("key NOT LIKE 'transient%'").unionByName(said.select(F.lit("comment").alias("property"), F.col("data_type").alias("value")))
