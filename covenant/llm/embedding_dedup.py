"""Near-duplicate vectors within a label: int8 tile products with error bounds, full precision where they leave doubt.

Unit vectors are rounded to int8 with a scale of their own; the length of each
rounding error is kept.  A product of int8 tiles is exact in float32, and with
the two error lengths it bounds the true cosine, so only pairs whose upper bound
reaches the threshold are computed in double precision.  Equal vectors of a
label are worked on as one with a number of copies.  Tiles of a label are dealt
as pairs of blocks, so a label of any size is spread over many tasks.  A task
returns link counts and enough links to keep its parts connected, not all pairs.

Cases: a null label, a null or empty vector, one of zeros, and one with null or
non-finite components link with nothing and are their own component; vectors of
different lengths do not link; each row has the links of its own vector, also
where rows share a vec_id, and rows that share a vec_id are one for the
components; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_checked, local_labels, stage
from .components import connected
from .exact_search import valid

TILE, PAIRS = 1024, 65_536
#: For the rounding of the bound itself, in double precision.
SLACK = 1e-9


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows -> (int8 rows, scales, upper bounds of the rounding error's length)."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - scale[:, None] * q) ** 2).sum(1)) + SLACK
    return q, scale, error


def may_link(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose cosine can reach the threshold.

    With a = A + e and b = B + f for the rounded A, B: |a.b - A.B| <= |e| |b| + |A| |f|
    <= |e| + (1 + |e|) |f|.
    """
    (qa, sa, ea), (qb, sb, eb) = quantise(a), quantise(b)
    # int8 products sum exactly in float32 up to 2**24, in float64 beyond
    kind = np.float32 if a.shape[1] * 127 * 127 < 2**24 else np.float64
    upper = (qa.astype(kind) @ qb.astype(kind).T).astype(np.float64) * sa[:, None] * sb + ea[:, None] + (1 + ea)[:, None] * eb
    return np.nonzero(upper >= threshold - SLACK)


def link_tiles(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold, decided in double precision."""
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    i, j = may_link(a / na[:, None], b / nb[:, None], threshold)
    keep = np.zeros(len(i), bool)
    for s in range(0, len(i), PAIRS):
        u, v = i[s : s + PAIRS], j[s : s + PAIRS]
        keep[s : s + PAIRS] = np.einsum("ij,ij->i", a[u], b[v]) / (na[u] * nb[v]) >= threshold
    return i[keep], j[keep]


def _unit(v: pd.Series) -> np.ndarray:
    """Rows scaled by their largest component, so that squares neither overflow nor vanish."""
    x = np.array(v.tolist(), float)
    return x / np.abs(x).max(1, keepdims=True)


def link_cell(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One pair of blocks: for each linked class its number of links here and the smallest class it reaches here."""
    pdf = pdf.sort_values("node", ignore_index=True)
    x, n = _unit(pdf.v), len(pdf)
    i, j = int(pdf.i.iat[0]), int(pdf.j.iat[0])
    left = np.flatnonzero(pdf.block.to_numpy() == i)
    right = left if i == j else np.flatnonzero(pdf.block.to_numpy() == j)
    u, v = link_tiles(x[left], x[right], threshold) if len(left) and len(right) else (left[:0], right[:0])
    u, v = left[u], right[v]
    if i == j:
        u, v = u[u < v], v[u < v]
    copies, node = pdf.copies.to_numpy(), pdf.node.to_numpy()
    links = np.zeros(n, np.int64)
    np.add.at(links, u, copies[v])
    np.add.at(links, v, copies[u])
    got = np.flatnonzero(links)
    return pd.DataFrame({"node": node[got], "links": links[got], "low": node[local_labels(n, u, v)[got]]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of (vec_id, embedding, label)."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & valid(F.col("v")) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    classes = rows.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = stage(classes.withColumn("dim", F.size("v")), "vector-classes")
    # a class goes by its smallest vec_id, or by a name beyond all ids where another class has the same
    shared = stage(classes.groupBy("least").agg(F.count("*").alias("n")).where("n > 1").select("least", F.lit(True).alias("_shared")), "shared")
    classes = classes.join(broadcast_checked(shared, shared.count()), "least", "left")
    beyond = F.xxhash64("label", "v").bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    classes = classes.withColumn("node", F.when(F.col("_shared"), beyond).otherwise(F.col("least").cast("long"))).drop("_shared")
    vector = F.xxhash64("label", "v")
    several = rows.where("ok").groupBy("vec_id").agg(F.min(vector).alias("a"), F.max(vector).alias("b")).where("a <> b").select("vec_id")
    several = stage(several, "several")
    same_id = rows.where("ok").join(broadcast_checked(several, several.count()), "vec_id", "left_semi").join(classes, ["label", "v"])
    blocks = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("m"))
    cells = classes.join(blocks, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("v"), F.col("m")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    cells = cells.select("label", "dim", "node", "copies", "v", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    linked = cells.groupBy("label", "dim", "i", "j").applyInPandas(lambda p: link_cell(p, threshold), "node long, links long, low long")
    linked = stage(linked, "vector-links")
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected(linked.select("node", "low").union(same_id.select("node", F.col("vec_id").cast("long"))), "node", "low")
    per = classes.join(counts, "node", "left").join(labels.withColumnRenamed("label", "component_id"), "node", "left")
    per = per.select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")
    )
    found = rows.where("ok").join(per, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE all_ AS (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings),
v AS (
  SELECT r, vec_id, label, embedding::DOUBLE[] AS x FROM all_
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (
  SELECT a.r, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT r, count(*) AS n FROM e GROUP BY r),
o AS (SELECT all_.vec_id, coalesce(n, 0)::BIGINT AS n_links, CASE WHEN v.r IS NULL THEN all_.vec_id ELSE component_id END AS component_id
      FROM all_ LEFT JOIN v USING (r) LEFT JOIN n USING (r) LEFT JOIN c ON c.vec_id = v.vec_id)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM o
"""
