"""Equi-joins in which single key values hold very many rows.

A join deals rows by key, so a key that holds a third of a feed makes one task
that more machines do not shorten.  ``heavy_join`` counts the keys of both sides
first (map-side combined).  A key above ``heavy_rows`` on a side becomes a grid:
its left rows are dealt over as many strips as they are ``heavy_rows``, its right
rows likewise, and a row is repeated once for each strip of the other side, so
every pair of rows meets in exactly one cell.  All other keys are one cell.

The table of heavy keys has at most (rows / heavy_rows) entries by construction;
it is stored, counted, and broadcast only within HEAVY_KEYS.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Heavy keys (a key and two numbers) up to which their table is broadcast.
HEAVY_KEYS = 100_000

LEFT, RIGHT = "_strips_left", "_strips_right"


def heavy_keys(left: DataFrame, right: DataFrame, key: str, heavy_rows: int) -> DataFrame:
    """(key, strips of each side) of the keys with more than ``heavy_rows`` rows on a side, among those both sides have."""
    n = F.count(F.lit(1))
    both = left.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("l")).join(right.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("r")), key)
    strips = lambda c: F.ceil(F.col(c) / heavy_rows).cast("int")
    return both.where((F.col("l") > heavy_rows) | (F.col("r") > heavy_rows)).select(key, strips("l").alias(LEFT), strips("r").alias(RIGHT))


def _dealt(df: DataFrame, heavy: DataFrame, key: str, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
    """Rows with their strip on the own side, once for each strip of the other side."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]), F.coalesce(F.col(own), F.lit(1)))
    cells = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    out = df.join(heavy, key, "left").select("*", spread.cast("int").alias(own_cell), F.explode(cells).alias(other_cell))
    return out.drop(LEFT, RIGHT)


def heavy_join(left: DataFrame, right: DataFrame, key: str, heavy_rows: int) -> DataFrame:
    """Inner join on ``key`` (one column of that name), no task of which grows with a single key.

    NULL keys match nothing.  Equal rows of a heavy key share a strip: a row that
    is repeated very often needs a column that tells its copies apart.
    """
    spark, path = left.sparkSession, scratch_path(left.sparkSession, "heavy")
    heavy = heavy_keys(left, right, key, heavy_rows)
    heavy.write.parquet(path)
    heavy = spark.read.schema(heavy.schema).parquet(path)
    heavy = F.broadcast(heavy) if heavy.count() <= HEAVY_KEYS else heavy
    a = _dealt(left.where(F.col(key).isNotNull()), heavy, key, LEFT, RIGHT, "_i", "_j")
    b = _dealt(right.where(F.col(key).isNotNull()), heavy, key, RIGHT, LEFT, "_j", "_i")
    return a.join(b, [key, "_i", "_j"]).drop("_i", "_j")
