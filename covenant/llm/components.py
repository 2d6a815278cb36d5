"""Connected components of a link table: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for every node of ``links`` (two long columns); label is the smallest node reachable.

    Each round is two shuffles of the remaining links by node, with a partial
    minimum before each; a node with very many links is one row per neighbour on
    the big side of a join that AQE can split.  Rounds end when nothing changes
    (a number that grows with the logarithm of the diameter).  Nulls and
    self-links are left out; an empty table gives an empty result.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    sign = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen, now = None, sign(edges)
    while now != seen:
        edges, seen = stage(_small(_large(edges)), "edges"), now
        now = sign(edges)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
