"""Exact top-k by integer inner product, with pivot distances that rule candidates out.

Vectors are scaled to integers.  A table keeps the distances of every vector to
P pivots.  For a query q and a candidate x the largest difference of their
distances to a pivot is a lower bound of their distance, and so
``(|q|^2 + |x|^2 - bound^2) / 2`` is an upper bound of their product.  Blocks of
queries meet blocks of candidates; within a pair of blocks the candidates of
highest bounds give each query a k-th score, and those whose bound is below it
are out; the products of the others are taken for many queries at once.  (Beyond
what doubles hold exactly, each query takes candidates in bound order and stops
at the first bound below its k-th score.)  Pivots only steer the work: any choice
gives exact results.

Cases: null vectors, null ids and vectors with null or non-finite components
take no part; rows with equal vec_id and vector are one row, rows that share a
vec_id with different vectors are rows of their own, each a candidate of all
others (and each with its own ranks, if the id is a query's); only vectors of
equal length are compared; ties go to the smaller vec_id; scores
beyond 64 bits are held at the end of the range; a query without candidates has
no rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_checked, stage

SCALE, PIVOTS, PIVOT_SAMPLE = 256.0, 32, 256
#: Vectors in a block of queries and of candidates; a task holds one of each.
QUERY_BLOCK, BLOCK = 1024, 4096
#: Relative slack for the rounding of distances.
SLACK = 1e-9
#: Candidates whose products are taken first, and queries of a block that are worked on at once.
STEP, TOGETHER = 64, 64


def valid(vec) -> F.Column:
    """Rows whose vector takes part: not null, every component known and finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of up to n rows."""
    chosen, far = [], np.full(len(x), np.inf)
    while len(chosen) < min(n, len(x)):
        i = int(np.argmax(far)) if chosen else 0
        chosen.append(i)
        far = np.minimum(far, ((x - x[i]) ** 2).sum(1))
    return x[chosen]


def index(vectors: DataFrame, id_col: str, vec_col: str, pivots: int = PIVOTS) -> DataFrame:
    """Staged table (id, key, dim, x, norm, far): scaled vectors, a name for each row, and distances to the pivots of their length."""
    spark = vectors.sparkSession
    vec = F.col("v").cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).withColumn("v", vec)
    rows = rows.where(F.col("id").isNotNull() & valid(F.col("v"))).distinct()
    rows = stage(rows.select("id", F.xxhash64("id", "v").alias("key"), F.size("v").alias("dim"), "v"), "vectors")
    chosen = {}
    for dim in (r.dim for r in rows.select("dim").distinct().orderBy("dim").limit(1000).collect()):
        sample = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("key"), "key").limit(PIVOT_SAMPLE).collect()
        chosen[dim] = choose_pivots(np.floor(SCALE * np.array([r.v for r in sample], float).reshape(len(sample), dim)), pivots)
    shared = spark.sparkContext.broadcast(chosen)  # PIVOTS vectors of each length

    def measure(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for dim, part in pdf.groupby("dim"):
                x = np.floor(SCALE * np.array(part.v.tolist(), float).reshape(len(part), dim))
                p = shared.value.get(dim, np.zeros((0, dim)))
                far = [np.sqrt(((x - y) ** 2).sum(1)) for y in p]
                far = np.array(far).reshape(len(p), len(x)).T
                yield pd.DataFrame({"id": part.id, "key": part.key, "dim": dim, "x": list(x), "norm": (x**2).sum(1), "far": list(far)})

    return stage(rows.mapInPandas(measure, "id long, key long, dim int, x array<double>, norm double, far array<double>"), "pivots")


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Products beyond what doubles hold exactly, by Python's integers."""
    to_int = np.frompyfunc(int, 1, 1)
    got = (to_int(x) * to_int(q)).sum(1) if x.shape[1] else np.zeros(len(x), object)
    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in got], np.int64)


def _bounds(qf: np.ndarray, qnorm: np.ndarray, xf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Upper bounds of the products of queries (rows) and candidates (columns)."""
    low, diff = np.zeros((len(qf), len(xf))), np.empty((len(qf), len(xf)))
    for a, b in zip(qf.T, xf.T):
        np.subtract(a[:, None], b, out=diff)
        np.maximum(low, np.abs(diff, out=diff), out=low)
    low = np.maximum(0, low - SLACK * (low + xf.max(1, initial=0)))
    bound = (qnorm[:, None] + norm - low**2) / 2
    return bound + SLACK * (np.abs(bound) + norm + qnorm[:, None])


def _left(q: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
    """Which candidates may be among the k best of each query; one of bound -inf takes no part."""
    first = np.argpartition(bound, len(x) - STEP, axis=1)[:, -STEP:] if len(x) > STEP else np.broadcast_to(np.arange(len(x)), bound.shape)
    known = np.where(np.take_along_axis(bound, first, 1) > -np.inf, np.einsum("qcd,qd->qc", x[first], q), -np.inf)
    kth = np.partition(known, -k, axis=1)[:, -k] if known.shape[1] >= k else np.full(len(q), -np.inf)
    return (bound >= kth[:, None]) & (bound > -np.inf)


def _best_together(q: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the k best candidates of each query, best first, of equal ones the first."""
    alive = _left(q, x, bound, k)
    at = np.flatnonzero(alive.any(0))
    out = []
    for score, mine in zip(q @ x[at].T, alive[:, at]):
        own = np.flatnonzero(mine)
        score = score[own]
        if len(own) > k:
            own = own[top := np.flatnonzero(score >= np.partition(score, -k)[-k])]
            score = score[top]
        out.append(at[own[np.argsort(-score, kind="stable")[:k]]])
    return out


def best_of_block(qs: pd.DataFrame, cs: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one block for every query of another, by elimination."""
    cols = {"query_id": "int64", "key": "int64", "vec_id": "int64", "score": "int64"}
    if not len(qs) or not len(cs):
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in cols.items()})
    stack = lambda s, n: np.array(s.tolist(), float).reshape(n, -1)
    q, x, qf, xf = stack(qs.x, len(qs)), stack(cs.x, len(cs)), stack(qs.far, len(qs)), stack(cs.far, len(cs))
    ids, keys, norm = cs.id.to_numpy(), cs.key.to_numpy(), cs.norm.to_numpy()
    top = lambda a: float(np.abs(a).max(initial=0))
    small = top(q) * top(x) * max(1, x.shape[1]) < 2**53
    out = []
    if small:
        byid = np.argsort(ids, kind="stable")
        x, xf, ids, keys, norm = x[byid], xf[byid], ids[byid], keys[byid], norm[byid]
        own_key, qnorm, places = qs.key.to_numpy(), qs.norm.to_numpy(), []
        for s in range(0, len(qs), TOGETHER):
            some = slice(s, s + TOGETHER)
            bound = _bounds(qf[some], qnorm[some], xf, norm)
            bound[own_key[some, None] == keys] = -np.inf
            places += _best_together(q[some], x, bound, k)
        asks, at = np.repeat(np.arange(len(places)), list(map(len, places))), np.concatenate([np.zeros(0, int), *places])
        score = np.einsum("rd,rd->r", q[asks], x[at]).astype(np.int64)
        out.append(pd.DataFrame({"query_id": qs.id.to_numpy()[asks], "key": own_key[asks], "vec_id": ids[at], "score": score}))
    for i, (qid, own) in enumerate(zip(qs.id, qs.key) if not small else ()):
        with np.errstate(all="ignore"):
            low = np.abs(xf - qf[i]).max(1, initial=0)
            low = np.maximum(0, low - SLACK * (low + xf.max(1, initial=0)))
            bound = (qs.norm.iat[i] + norm - low**2) / 2
            bound = np.where(np.isfinite(bound), bound + SLACK * (np.abs(bound) + norm + qs.norm.iat[i]), np.inf)
        bound[keys == own] = -np.inf
        order, scores, at = np.argsort(-bound, kind="stable"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(order), STEP):
            part = order[start : start + STEP]
            part = part[bound[part] > -np.inf]
            if not len(part) or len(scores) >= k and bound[part[0]] < scores[k - 1]:
                break
            got = _exact(q[i], x[part])
            scores, at = np.concatenate([scores, got]), np.concatenate([at, part])
            keep = np.lexsort((ids[at], [-int(s) for s in scores]))[:k]
            scores, at = scores[keep], at[keep]
        out.append(pd.DataFrame({"query_id": qid, "key": own, "vec_id": ids[at], "score": scores}))
    return pd.concat(out).astype(cols)


def search(vectors: DataFrame, is_query: F.Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best for the rows of which ``is_query`` (over ``id``) holds.

    The rows are dealt as pairs of blocks: a candidate goes to every block of
    queries and a query to every block of candidates, so a task's memory is set
    by the two block sizes, whatever the table's size.
    """
    table = index(vectors, id_col, vec_col)
    sizes = table.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("nq"))
    sizes = sizes.select("dim", F.ceil(F.col("n") / BLOCK).cast("int").alias("nc"), F.ceil(F.col("nq") / QUERY_BLOCK).cast("int").alias("nb")).where("nb > 0")
    rows = table.join(broadcast_checked(sizes, sizes.count()), "dim")  # a row for each vector length
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["dim", "qb", "cb", "asks", "id", "key", "x", "norm", "far"]
    qs = rows.where(is_query).select("*", F.lit(True).alias("asks"), spread("nb").alias("qb"), each("nc").alias("cb"))
    cs = rows.select("*", F.lit(False).alias("asks"), spread("nc").alias("cb"), each("nb").alias("qb"))
    pairs = qs.select(cols).unionByName(cs.select(cols)).groupBy("dim", "qb", "cb")
    found = pairs.applyInPandas(lambda p: best_of_block(p[p.asks], p[~p.asks], k), "query_id long, key long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", best.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op4(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, F.pmod(F.col("id"), F.lit(50)) == 0)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.embedding AS own, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON (q.vec_id <> c.vec_id OR q.embedding <> c.embedding) AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, own ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
