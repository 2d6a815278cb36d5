"""Deterministic anomaly injectors: corrupt an existing table at known rates.

Each injector picks rows with ``picks.pick(kind, key, rate)`` (md5 of the
row key), so the corrupted set is the same on every run, every partitioning
and every recomputed task, and a test can compute it independently.  With
``track=True`` an injector also adds a boolean ``_an_<name>`` column so that
``injection_report`` can count what was injected (one aggregation).

Injectors that need values from elsewhere (donor keys for duplicates, keys
of another table for key reuse) take a bounded, sorted top-k (at most
``n`` rows) and broadcast it; its size is bounded by ``n`` by construction.
The smallest keys are one end of the key range; with ``spread`` the pool is a
hash sample instead (``hash_sample``), which lies all over it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.picks import choice, choose, pick

MARK_PREFIX = "_an_"


@dataclass(frozen=True)
class AnomalyRates:
    """Default injection rate per anomaly kind."""

    null: float = 0.03
    duplicate: float = 0.02
    invalid_enum: float = 0.04
    out_of_range: float = 0.03
    future_date: float = 0.02
    format_error: float = 0.02

    def rate(self, kind: str) -> float:
        return float(getattr(self, kind, 0.0) or 0.0)


def _key(key: "str | Column") -> Column:
    return F.col(key) if isinstance(key, str) else key


def _apply(df: DataFrame, column: str, picked: Column, value: Column, name: str | None, track: bool) -> DataFrame:
    df = df.withColumn(column, F.when(picked, value).otherwise(F.col(column)))
    if track:
        df = df.withColumn(MARK_PREFIX + (name or column), picked)
    return df


def inject_null(df, column, rate, key, kind="null", track=False, name=None):
    """Set ``column`` to NULL on picked rows."""
    p = pick(kind, _key(key), rate)
    return _apply(df, column, p, F.lit(None).cast(dict(df.dtypes)[column]), name, track)


def inject_choice(df, column, rate, key, values, kind="invalid_enum", track=False, name=None):
    """Replace ``column`` with one of ``values`` (chosen by key) on picked rows."""
    k = _key(key)
    return _apply(df, column, pick(kind, k, rate), choose(f"{kind}:value", k, list(values)), name, track)


def inject_constant(df, column, rate, key, value, kind="out_of_range", track=False, name=None):
    return _apply(df, column, pick(kind, _key(key), rate), F.lit(value), name, track)


def inject_two_sided(df, column, rate, key, low, high, kind="out_of_range", track=False, name=None):
    """Out of range on either side, low or high by a second key hash."""
    k = _key(key)
    side = F.when(choice(f"{kind}:side", k, 2) == 0, F.lit(low)).otherwise(F.lit(high))
    return _apply(df, column, pick(kind, k, rate), side, name, track)


def inject_future_date(df, column, rate, key, as_of, max_days, kind="future_date", track=False, name=None):
    """Move ``column`` to ``as_of`` + 1..max_days days on picked rows."""
    k = _key(key)
    future = F.date_add(F.lit(str(as_of)).cast("date"), choice(f"{kind}:days", k, max_days) + 1)
    dtype = dict(df.dtypes)[column]
    value = future if dtype == "date" else future.cast(dtype)
    return _apply(df, column, pick(kind, k, rate), value, name, track)


def inject_truncate(df, column, rate, key, min_len=30, max_len=70, kind="format_error", track=False, name=None):
    """Cut a text line to min_len..max_len characters."""
    k = _key(key)
    n = choice(f"{kind}:len", k, max_len - min_len + 1) + min_len
    return _apply(df, column, pick(kind, k, rate), F.left(F.col(column), n), name, track)


def inject_negative(df, column, rate, key, lo=1000, hi=999999, kind="out_of_range", track=False, name=None):
    """Replace a non-negative amount with -(lo..hi)."""
    k = _key(key)
    value = -(choice(f"{kind}:amount", k, hi - lo + 1) + lo).cast("long")
    dtype = dict(df.dtypes)[column]
    return _apply(df, column, pick(kind, k, rate), value.cast(dtype), name, track)


#: Slots that may be broadcast: at most this many rows of one value.
MAX_SLOTS = 100_000


def _place(v: Column) -> Column:
    """32 bits of a value's digest: its place in the pool's order, as a share of 2^32."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("pool:"), v.cast("string"))), 1, 8), 16, 10).cast("bigint")


def hash_sample(values: DataFrame, col: str, n: int) -> DataFrame:
    """(_v): the ``n`` distinct values of smallest digest (all, if fewer), the same however the rows lie.

    Samples merge: that of two tables together is that of their two samples.  The
    number of distinct values is estimated first, and only values whose digest
    may be among the smallest are made distinct and sorted, about 4 * n of them;
    if they are too few the limit is raised.
    """
    some = values.where(F.col(col).isNotNull()).select(F.col(col).alias("_v"))
    m = some.agg(F.approx_count_distinct("_v")).first()[0]
    limit = min(1 << 32, ((4 * n << 32) // max(1, m)) + 1)
    while True:
        kept = some.where(_place(F.col("_v")) < limit).distinct()
        if limit >= 1 << 32 or kept.count() >= n:
            return kept.orderBy(F.md5(F.concat(F.lit("pool:"), F.col("_v").cast("string"))), "_v").limit(n)
        limit = min(1 << 32, limit * 8)


def _slots(values: DataFrame, col: str, n: int, spread: bool = False) -> DataFrame:
    """Map slots 0..n-1 onto the (at most n) sorted ``values``: slot s -> value[s mod m]."""
    if not 0 < n <= MAX_SLOTS:
        raise ValueError(f"a pool has 1 to {MAX_SLOTS} slots, not {n}")
    ranked = hash_sample(values, col, n) if spread else values.select(F.col(col).alias("_v")).distinct().orderBy("_v").limit(n)
    # Windows over at most n rows (after the limit), so one task is fine.
    indexed = ranked.select(
        "_v",
        (F.row_number().over(Window.orderBy("_v")) - 1).alias("_i"),
        F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("_m"),
    )
    return indexed.select(F.explode(F.sequence(F.col("_i"), F.lit(n - 1), F.col("_m"))).alias("_slot"), "_v")


def _take_from(df, column, picked, key, pool: DataFrame, pool_col: str, n: int, kind: str, name, track, spread: bool = False):
    k = _key(key)
    slots = F.broadcast(_slots(pool, pool_col, n, spread))  # n rows, at most MAX_SLOTS
    tagged = df.withColumn("_tk_slot", F.when(picked, choice(f"{kind}:slot", k, n)))
    joined = tagged.join(slots, tagged["_tk_slot"] == slots["_slot"], "left")
    out = joined.withColumn(column, F.when(F.col("_slot").isNotNull(), F.col("_v").cast(dict(df.dtypes)[column])).otherwise(F.col(column)))
    if track:
        out = out.withColumn(MARK_PREFIX + (name or column), F.col("_slot").isNotNull())
    return out.drop("_tk_slot", "_slot", "_v")


def inject_duplicates(df, column, rate, key, donors=50, kind="duplicate", track=False, name=None, spread=False):
    """Overwrite ``column`` on picked rows with one of the ``donors`` smallest
    keys of unpicked rows (with ``spread``: of a hash sample of them), creating
    duplicates of existing keys."""
    k = _key(key)
    picked = pick(kind, k, rate) & F.col(column).isNotNull()
    pool = df.where(~pick(kind, k, rate) & F.col(column).isNotNull())
    return _take_from(df, column, picked, key, pool, column, donors, kind, name, track, spread)


def reuse_keys(df, column, rate, key, source: DataFrame, source_col: str, sample=500, kind="reuse", track=False, name=None, spread=False):
    """A share ``rate`` of rows take a key from another table's ``sample``
    smallest distinct keys, or with ``spread`` from a hash sample of its keys
    (referential overlap between two feeds)."""
    picked = pick(kind, _key(key), rate)
    pool = source.where(F.col(source_col).isNotNull())
    return _take_from(df, column, picked, key, pool, source_col, sample, kind, name, track, spread)


def reuse_prefixes(df, column, rate, key, source: DataFrame, source_col: str, length: int, sample=500, kind="reuse_prefix", track=False, name=None, spread=False):
    """As ``reuse_keys``, with the first ``length`` characters of another table's keys."""
    picked = pick(kind, _key(key), rate)
    prefixes = source.where(F.col(source_col).isNotNull()).select(F.substring(F.col(source_col).cast("string"), 1, length).alias("_prefix"))
    return _take_from(df, column, picked, key, prefixes, "_prefix", sample, kind, name, track, spread)


def inject_anomalies(
    df: DataFrame,
    steps: Iterable[tuple[str, Callable[..., DataFrame], Mapping]],
    rates: AnomalyRates | None = None,
) -> DataFrame:
    """Apply ``(kind, injector, kwargs)`` steps in order at the rate of their kind.

    An unknown kind has rate 0 and is skipped.
    """
    rates = rates or AnomalyRates()
    for kind, fn, kwargs in steps:
        rate = rates.rate(kind)
        if rate > 0:
            df = df.transform(lambda d: fn(d, rate=rate, **dict(kwargs)))
    return df


def injection_report(df: DataFrame) -> DataFrame:
    """(anomaly, rows) for every ``_an_*`` mark, plus 'total' and 'clean'; one aggregation."""
    marks = [c for c in df.columns if c.startswith(MARK_PREFIX)]
    any_mark = F.lit(False)
    for m in marks:
        any_mark = any_mark | F.coalesce(F.col(m), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("_total"), F.count_if(~any_mark).alias("_clean")] + [
        F.count_if(F.col(m)).alias(f"_m{i}") for i, m in enumerate(marks)
    ]
    rows = [F.struct(F.lit("total").alias("anomaly"), F.col("_total").alias("rows")), F.struct(F.lit("clean").alias("anomaly"), F.col("_clean").alias("rows"))]
    rows += [F.struct(F.lit(m[len(MARK_PREFIX):]).alias("anomaly"), F.col(f"_m{i}").alias("rows")) for i, m in enumerate(marks)]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select("anomaly", F.col("rows").cast("long").alias("rows"))


def drop_marks(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(MARK_PREFIX)])
