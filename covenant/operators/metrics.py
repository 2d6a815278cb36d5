"""Per-rule metrics, failure samples, the severity summary and the critical gate.

``measure_rules`` measures a frame as it is: without samples, the predicates of
all rules are counted in **one** aggregation, and a ``unique`` rule is the rows
minus the distinct values of its column, with no join; with samples, one scan
gives rows per (rule, failing value), combined map-side, from which both the
counts and the samples follow.  ``measure`` reads the failure lists of an
annotated frame (stored once by the silver plan).  Nothing but the small
results frame (one row per rule) is ever looked at on the driver, and only by
``enforce``.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import SEVERITIES, Rule, as_rules, fail_condition
from ..functions.scalars import pass_fail
from .checks import FAILED_RULES, PASSED
from .membership import join_references

# Fixed value: the quality-results schema (12 fields; only the samples may be NULL).
RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_timestamp", T.TimestampType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("rule_type", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("total_count", T.LongType(), False),
        T.StructField("pass_count", T.LongType(), False),
        T.StructField("fail_count", T.LongType(), False),
        T.StructField("fail_pct", T.DoubleType(), False),
        T.StructField("sample_failures", T.ArrayType(T.StringType()), True),
    ]
)

SAMPLE_SIZE = 5


class DataQualityException(Exception):
    pass


def fail_pct(fail: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(fail / total * 100, 2)).otherwise(F.lit(0.0))


def _sql_str(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_struct(i: int, r: Rule, count_col: str) -> Column:
    """One rule's result row as a struct, built as a single expression (one JVM call)."""
    return F.expr(
        f"named_struct('rule_idx', {i}, 'rule_name', {_sql_str(r.rule_name)}, 'column', {_sql_str(r.column)}, "
        f"'rule_type', {_sql_str(r.rule_type)}, 'severity', {_sql_str(r.severity)}, 'fail_count', `{count_col}`)"
    )


def rule_counts(annotated: DataFrame, rules: Sequence[Rule], group_cols: Sequence[str] = ()) -> DataFrame:
    """One aggregation for all rules -> one row per (group, rule) with total/pass/fail/fail_pct."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(F.array_contains(F.col(FAILED_RULES), r.rule_name)).alias(f"_f{i}") for i, r in enumerate(rules)
    ]
    grouped = annotated.groupBy(*group_cols).agg(*aggs) if group_cols else annotated.agg(*aggs)
    rows = F.array(*[_rule_struct(i, r, f"_f{i}") for i, r in enumerate(rules)])
    return grouped.select(*group_cols, F.col("_total").alias("total_count"), F.inline(rows)).select(
        *group_cols,
        "rule_idx",
        "rule_name",
        "column",
        "rule_type",
        "severity",
        F.col("total_count").cast("long").alias("total_count"),
        (F.col("total_count") - F.col("fail_count")).cast("long").alias("pass_count"),
        F.col("fail_count").cast("long").alias("fail_count"),
        fail_pct(F.col("fail_count"), F.col("total_count")).alias("fail_pct"),
    )


def failure_samples(
    annotated: DataFrame, rules: Sequence[Rule], group_cols: Sequence[str] = (), size: int = SAMPLE_SIZE
) -> DataFrame:
    """Up to ``size`` distinct failing values per rule, ascending; NULL shows as 'None'.

    Distinct (rule, value) pairs are reduced map-side, and the per-rule top-k
    runs as a partial ``WindowGroupLimit`` before the shuffle, so each rule's
    final task sees at most ``size`` rows per input partition.
    """
    empty = F.array().cast("array<struct<rule_idx:int,value:string>>")
    hits = F.concat(
        *[
            F.when(
                F.array_contains(F.col(FAILED_RULES), r.rule_name),
                F.array(F.struct(F.lit(i).alias("rule_idx"), F.coalesce(F.col(r.column).cast("string"), F.lit("None")).alias("value"))),
            ).otherwise(empty)
            for i, r in enumerate(rules)
        ]
    )
    pairs = (
        annotated.where(~F.col(PASSED))
        .select(*group_cols, F.inline(hits))
        .select(*group_cols, "rule_idx", "value")
        .distinct()
    )
    w = Window.partitionBy(*group_cols, "rule_idx").orderBy("value")
    top = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= size)
    return top.groupBy(*group_cols, "rule_idx").agg(F.array_sort(F.collect_list("value")).alias("sample_failures"))


def _stamp(run_ts: "_dt.datetime | str | Column | None") -> Column:
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp")


def _results(counts: DataFrame, dataset: str, run_id: str, run_ts, group_cols: Sequence[str] = ()) -> DataFrame:
    return counts.select(
        *group_cols,
        F.lit(run_id).alias("run_id"),
        _stamp(run_ts).alias("run_timestamp"),
        F.lit(dataset).alias("dataset_name"),
        "rule_name",
        "column",
        "rule_type",
        "severity",
        "total_count",
        "pass_count",
        "fail_count",
        "fail_pct",
        F.coalesce("sample_failures", F.array().cast("array<string>")).alias("sample_failures"),
        "rule_idx",
    )


def _unpivot(row: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A frame of one row (_total, _f0, _f1, ..) -> one row per rule."""
    rows = F.array(*[_rule_struct(i, r, f"_f{i}") for i, r in enumerate(rules)])
    out = row.select(F.col("_total").cast("long").alias("total_count"), F.inline(rows))
    return out.withColumn("fail_count", F.col("fail_count").cast("long")).withColumn("pass_count", F.col("total_count") - F.col("fail_count"))


def _counted(df: DataFrame, rules: Sequence[Rule], as_of) -> DataFrame:
    """One row with the row count and each rule's failures."""
    kinds = dict(df.dtypes)
    fails = [F.count_if(fail_condition(r, as_of, kinds.get(r.column))) for r in rules]
    out = df.agg(F.count(F.lit(1)).alias("_total"), *[c.alias(f"_f{i}") for i, (c, r) in enumerate(zip(fails, rules)) if r.rule_type != "unique"])
    for i, r in enumerate(rules):
        if r.rule_type == "unique":
            key = F.col(r.column)
            names = [F.xxhash64(key), F.xxhash64(F.lit("key"), key)] if kinds[r.column] in ("string", "binary") else [key]
            per_key = df.where(key.isNotNull()).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
            extra = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(f"_f{i}"))
            # two frames of one row, joined on a zero that both compute
            out = out.withColumn("_one", F.col("_total") * 0).join(extra.withColumn("_one", F.col(f"_f{i}") * 0), "_one").drop("_one")
    return out


def _counted_with_samples(df: DataFrame, rules: Sequence[Rule], as_of, size: int) -> DataFrame:
    """(rule_idx, total_count, fail_count, sample_failures) from one scan.

    Every row gives one (-1, NULL) for the total, its value for each failing
    rule, and its key for each ``unique`` rule; they are counted by value.
    """
    kinds = dict(df.dtypes)
    empty = F.array().cast("array<struct<rule_idx:int,value:string>>")
    parts = [F.array(F.struct(F.lit(-1).alias("rule_idx"), F.lit(None).cast("string").alias("value")))]
    for i, r in enumerate(rules):
        value = F.struct(F.lit(i).alias("rule_idx"), F.coalesce(F.col(r.column).cast("string"), F.lit("None")).alias("value"))
        hit = F.col(r.column).isNotNull() if r.rule_type == "unique" else fail_condition(r, as_of, kinds.get(r.column))
        parts.append(F.when(hit, F.array(value)).otherwise(empty))
    per = df.select(F.inline(F.concat(*parts))).groupBy("rule_idx", "value").agg(F.count(F.lit(1)).alias("n"))
    unique = [i for i, r in enumerate(rules) if r.rule_type == "unique"]
    fails = F.when(F.col("rule_idx").isin(unique), F.col("n") - 1).otherwise(F.col("n"))
    per = per.withColumn("n", fails).where("n > 0")
    sums = per.groupBy("rule_idx").agg(F.sum("n").alias("fail_count"))
    top = per.withColumn("_rn", F.row_number().over(Window.partitionBy("rule_idx").orderBy("value"))).where((F.col("_rn") <= size) & (F.col("rule_idx") >= 0))
    samples = top.groupBy("rule_idx").agg(F.array_sort(F.collect_list("value")).alias("sample_failures"))
    return sums.join(samples, "rule_idx", "left")


def measure_rules(
    df: DataFrame,
    rules: Iterable[Rule | Mapping],
    *,
    dataset: str,
    run_id: str,
    run_ts: "_dt.datetime | str | Column | None" = None,
    as_of=None,
    samples: bool = True,
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Quality results (``RESULTS_SCHEMA`` columns) of ``rules`` on a frame that need not be annotated."""
    rules = as_rules(rules)
    df = join_references(df, rules, references)
    if samples:
        per = _counted_with_samples(df, rules, as_of, SAMPLE_SIZE)
        total = F.coalesce(F.max(F.when(F.col("rule_idx") == -1, F.col("fail_count"))), F.lit(0))
        found = F.map_from_entries(F.collect_list(F.struct("rule_idx", F.struct("fail_count", "sample_failures"))))  # a row per rule
        row = per.agg(total.alias("_total"), found.alias("_found"))
        row = row.select("*", *[F.coalesce(F.col("_found")[i]["fail_count"], F.lit(0)).alias(f"_f{i}") for i in range(len(rules))])
        named = F.array(*[_rule_struct(i, r, f"_f{i}") for i, r in enumerate(rules)])
        counts = row.select(F.col("_total").cast("long").alias("total_count"), "_found", F.inline(named))
        counts = counts.withColumn("sample_failures", F.col("_found")[F.col("rule_idx")]["sample_failures"]).withColumn("pass_count", F.col("total_count") - F.col("fail_count"))
    else:
        counts = _unpivot(_counted(df, rules, as_of), rules).withColumn("sample_failures", F.array().cast("array<string>"))
    return _results(counts.withColumn("fail_pct", fail_pct(F.col("fail_count"), F.col("total_count"))), dataset, run_id, run_ts)


def measure(
    annotated: DataFrame,
    rules: Iterable[Rule | Mapping],
    *,
    dataset: str,
    run_id: str,
    run_ts: "_dt.datetime | str | Column | None" = None,
    samples: bool = True,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Quality results (``RESULTS_SCHEMA`` columns) for an annotated frame.

    ``group_cols`` measures many runs at once (one result row per group and
    rule), still in one aggregation.
    """
    rules = as_rules(rules)
    counts = rule_counts(annotated, rules, group_cols)
    if samples and rules:
        smp = failure_samples(annotated, rules, group_cols)
        # One row per rule and group on the right: joined on (group, rule).
        counts = counts.join(smp, [*group_cols, "rule_idx"], "left")
    else:
        counts = counts.withColumn("sample_failures", F.array().cast("array<string>"))
    return _results(counts, dataset, run_id, run_ts, group_cols)


def summary_lines(results: DataFrame) -> DataFrame:
    """Per-rule PASS/FAIL status (the console summary, kept as a DataFrame)."""
    return results.withColumn("status", pass_fail(F.col("fail_count")))


def severity_totals(results: DataFrame) -> DataFrame:
    """Fail totals for CRITICAL, ERROR and WARNING; a severity with no failures shows 0."""
    spark = results.sparkSession
    sev = spark.createDataFrame([(s, i) for i, s in enumerate(SEVERITIES)], "severity string, _ord int")
    sums = results.where(F.col("fail_count") > 0).groupBy("severity").agg(F.sum("fail_count").alias("_s"))
    return (
        sev.join(sums, "severity", "left")
        .select("severity", F.coalesce(F.col("_s"), F.lit(0)).cast("long").alias("fail_total"), "_ord")
        .orderBy("_ord")
        .drop("_ord")
    )


def critical_failures(results: DataFrame) -> DataFrame:
    return results.where((F.col("severity") == "CRITICAL") & (F.col("fail_count") > 0))


def gate_messages(rows, mode: str = "warn") -> list[str]:
    """One line per CRITICAL rule with failures, from result rows; ``fail`` raises."""
    out = []
    for r in rows:
        if r["severity"] == "CRITICAL" and r["fail_count"] > 0:
            shown = ", ".join((r["sample_failures"] or [])[:3]) or "none kept"
            out.append(f"{r['rule_name']}: column {r['column']} of {r['dataset_name']} fails in {r['fail_count']} rows, {r['fail_pct']} percent (such as {shown})")
    if out and mode == "fail":
        raise DataQualityException(f"the gate is closed, {len(out)} critical rule(s) fail\n" + "\n".join(out))
    return out


GATE_COLUMNS = ("dataset_name", "rule_name", "column", "severity", "fail_count", "fail_pct", "sample_failures")


def enforce(results: DataFrame, mode: str = "warn") -> list[str]:
    """Gate on CRITICAL failures: ``warn`` returns messages, ``fail`` raises.

    Collects only the failing-critical result rows (bounded by the rule count).
    """
    return gate_messages(critical_failures(results).select(*GATE_COLUMNS).collect(), mode)
