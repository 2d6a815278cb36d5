"""Mix sources to target weights by nested hash thresholds.

Every document has a 52-bit hash.  A source whose target is k times its size
plus a rest takes every document k times, and those with a hash below a
threshold once more.  The threshold comes from histograms: sizes are summed by
source and hash bucket, the bucket in which the rest is reached is found, and
only that bucket is summed anew by finer buckets.  Documents are filtered by
comparing hashes; they are never sorted, and a higher target only adds copies.

Cases: null text has size 0 and takes nothing; a null source is a source of its
own, after all others; rows that repeat a doc_id and text share a hash, so they
are taken together; an empty table gives an empty result; other columns,
whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_checked, stage, word_count

#: Four levels of 13 bits each name a hash completely.
LEVELS, BITS = 4, 13
WEIGHTS, MOST = (1, 2, 3), 3


def hash_value(doc_id="doc_id", text="text"):
    """52 bits of md5 over id and text."""
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(key, 1, LEVELS * BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): shares by weight, cut at ``most`` times a size, the excess shared anew.

    Sources that are cut come first when ordered by limit / weight, so running
    sums over one row per source give the final share without iterating.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("decimal(18,0)")).withColumn("limit", (F.col("source_size") * most).cast("decimal(20,0)"))
    to_end = Window.orderBy((F.col("limit") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rest = F.sum("source_size").over(whole) - (F.sum("limit").over(whole) - F.sum("limit").over(to_end))
    per = per.withColumn("r", rest.cast("decimal(20,0)")).withColumn("ws", F.sum("w").over(to_end).cast("decimal(18,0)"))
    per = per.withColumn("cut", F.col("limit") * F.col("ws") <= F.col("w") * F.col("r"))
    first = F.min(F.when(~F.col("cut"), F.struct((F.col("limit") / F.col("w")).alias("o"), F.col("source").isNull().alias("n"), "source", "r", "ws"))).over(whole)
    per = per.withColumn("f", first)
    share = (F.col("w") * F.col("f.r")).cast("double") / F.col("f.ws").cast("double")
    return per.select("source", "source_size", F.when(F.col("cut"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def _by_source(rows: DataFrame, per: DataFrame, n: int) -> DataFrame:
    """Rows with the columns of their source (null is a source); ``per`` has one row for each of ``n`` sources."""
    per = broadcast_checked(per.withColumnRenamed("source", "t_source"), n)
    return rows.join(per, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")


def thresholds(sizes: DataFrame, goal: DataFrame, n: int) -> DataFrame:
    """Per source: ``copies`` of every document and the hash ``below`` which one more is taken."""
    size = F.col("source_size").cast("double")
    t = goal.withColumn("copies", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long"))
    t = t.withColumn("rest", F.col("target") - F.col("copies") * size).withColumn("prefix", F.lit(0).cast("long"))
    t = t.withColumn("before", F.lit(0).cast("long")).withColumn("upto", F.lit(0).cast("long"))
    running = Window.partitionBy("source").orderBy("bin")
    for level in range(1, LEVELS + 1):
        bits = BITS * (LEVELS - level)
        near = sizes if level == 1 else _by_source(sizes, t.select("source", "prefix"), n).where(F.shiftright("u", bits + BITS) == F.col("prefix"))
        bins = near.groupBy("source", F.shiftright("u", bits).alias("bin")).agg(F.sum("size").alias("bin_size"))
        bins = _by_source(bins, t, n).withColumn("cum", F.col("before") + F.sum("bin_size").over(running))
        hit = F.when(F.col("cum") > F.col("rest"), F.struct("bin", (F.col("cum") - F.col("bin_size")).alias("before"), F.col("cum").alias("upto")))
        found = bins.groupBy("source").agg(F.min(hit).alias("hit")).withColumnRenamed("source", "t_source")
        t = t.join(broadcast_checked(found, n), F.col("source").eqNullSafe(F.col("t_source")), "left").select(
            "source", "source_size", "target", "copies", "rest",
            F.coalesce("hit.bin", F.lit(1 << BITS * level)).cast("long").alias("prefix"),
            F.coalesce("hit.before", "before").alias("before"), F.coalesce("hit.upto", "upto").alias("upto"),
        )
        t = stage(t, f"mix-{level}")
    nearer = (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("rest") < F.col("rest") - F.col("before"))
    return t.select("source", "source_size", "target", "copies", (F.col("prefix") + nearer.cast("long")).alias("below"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc, size, source_size, target, copies): ``doc`` holds all columns of the row, ``copies`` how often it is taken."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(F.col("source"), word_count(F.col("text")).alias("size"), hash_value().alias("u"), own.alias("doc"))
    sizes = stage(rows.select("source", "size", "u"), "mix-sizes")
    goal = stage(targets(sizes, weights, most), "mix-targets")
    n = goal.count()
    out = _by_source(rows, thresholds(sizes, goal, n), n)
    copies = F.col("copies") + (F.col("u") < F.col("below")).cast("long")
    return out.select("doc", "size", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(0).cast("long").alias("copies"))


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it."""
    taken = mix(docs).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS size, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::HUGEINT AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, (SELECT sum(size) FROM s) - coalesce(sum(3 * size) OVER p, 0) AS r, sum(w) OVER q AS ws
  FROM s
  WINDOW p AS (ORDER BY 3 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         q AS (ORDER BY 3 * size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (SELECT r, ws FROM r WHERE 3 * size * ws > w * r ORDER BY 3 * size / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT r.source, r.size, CASE WHEN 3 * r.size * r.ws <= r.w * r.r THEN (3 * r.size)::DOUBLE
         ELSE (r.w * f.r)::DOUBLE / f.ws::DOUBLE END AS target
  FROM r LEFT JOIN f ON TRUE),
k AS (SELECT *, CASE WHEN size > 0 THEN floor(target / size::DOUBLE) ELSE 0 END::BIGINT AS copies FROM t),
c AS (
  SELECT d.doc_id, d.size, k.size::BIGINT AS source_size, k.target, k.copies, k.target - k.copies * k.size::DOUBLE AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.u) AS tied
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= rest OR (upto - tied < rest AND upto - rest < rest - (upto - tied)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
