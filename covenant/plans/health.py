"""Rule health kept up to date run by run, without reading the results history again.

The state has one row per (dataset, rule, severity): how many runs checked it, in
how many it failed, its worst share, and its latest one.  All of these merge, so
a run only adds its own results (one row per rule) to the state.

A run may be repeated, and then replaces what it said before.  A maximum cannot
be taken back, so the state keeps the runs of the last update (``open``) apart
from all earlier ones (``closed``): an update for the same runs replaces the open
part, one for new runs closes it first.  When results of closed runs come again,
the state is built anew from the history, which the caller hands over.

Updates are published as versions: one that fails leaves the former state, and
doing it again gives the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import severity_rank, status_flag
from ..operators.publish import current_version, publish, read_published

KEYS = ("dataset_name", "rule_name", "severity")
_PART = "struct<runs:bigint,failing:bigint,worst:double,latest:struct<run_timestamp:timestamp,run_id:string,fail_pct:double>>"
COLUMNS = ("dataset_name", "rule_name", "severity", "closed", "open", "run_id", "is_open", "kind")
STATE = f"dataset_name string, rule_name string, severity string, closed {_PART}, open {_PART}, run_id string, is_open boolean, kind string"


class ClosedRuns(ValueError):
    """Results of runs that the state has closed; the history is needed to take them in again."""


def _summed(results: DataFrame, name: str) -> DataFrame:
    latest = F.max(F.struct("run_timestamp", "run_id", "fail_pct"))
    part = F.struct(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("fail_count") > 0).alias("failing"), F.max("fail_pct").alias("worst"), latest.alias("latest"))
    return results.groupBy(*KEYS).agg(part.cast(_PART).alias(name))


def _merged(a: Column, b: Column) -> Column:
    both = F.struct(
        (a["runs"] + b["runs"]).alias("runs"), (a["failing"] + b["failing"]).alias("failing"),
        F.greatest(a["worst"], b["worst"]).alias("worst"), F.greatest(a["latest"], b["latest"]).alias("latest"),
    )
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """The state below ``path``; empty before the first update."""
    return read_published(spark, path, schema=STATE) if current_version(spark, path) else spark.createDataFrame([], STATE)


def update_health(spark: SparkSession, path: str, results: DataFrame, history: DataFrame | None = None) -> None:
    """Take the results of one run (or of a few runs that belong together) into the state below ``path``.

    ``history`` (all results, these included) is read only if one of the runs was closed before.
    """
    state = read_health(spark, path)
    new = sorted(r.run_id for r in results.select("run_id").distinct().collect())  # the runs of one update
    known = {r.run_id: r.is_open for r in state.where((F.col("kind") == "run") & F.col("run_id").isin(new)).select("run_id", "is_open").collect()}
    open_ = {r.run_id for r in state.where("kind = 'run' AND is_open").select("run_id").collect()}  # the runs of the last update
    again = set(new) == open_
    if known and not again:
        if history is None:
            raise ClosedRuns(f"runs {sorted(known)} were taken in before; hand over the history to take them in again")
        rules = _summed(history.where(~F.col("run_id").isin(new)), "closed")
        old_runs = history.where(~F.col("run_id").isin(new)).select("run_id").distinct()
    else:
        kept = F.col("closed") if again else _merged(F.col("closed"), F.col("open"))
        rules = state.where("kind = 'rule'").select(*KEYS, kept.alias("closed"))
        old_runs = state.where("kind = 'run'").select("run_id")
        old_runs = old_runs.where(~F.col("run_id").isin(new)) if again else old_runs
    rules = rules.join(_summed(results, "open"), list(KEYS), "full").where("closed IS NOT NULL OR open IS NOT NULL")
    runs = old_runs.withColumn("is_open", F.lit(False)).unionByName(spark.createDataFrame([(r, True) for r in new], "run_id string, is_open boolean"))
    out = rules.withColumn("kind", F.lit("rule")).unionByName(runs.withColumn("kind", F.lit("run")), allowMissingColumns=True)
    publish(out.select(*COLUMNS), path, partition_by=["kind"])


def health_report(state: DataFrame, investigate_pct: float = 5.0) -> DataFrame:
    """The columns of ``marts.rule_health`` from the state."""
    per = state.where("kind = 'rule'").select(*KEYS, _merged(F.col("closed"), F.col("open")).alias("p"))
    out = per.select(
        *KEYS,
        F.col("p.latest.fail_pct").alias("latest_run_fail_pct"),
        F.col("p.runs").alias("total_runs_checked"),
        F.col("p.failing").alias("runs_with_failures"),
        F.col("p.worst").alias("max_fail_pct_ever"),
    )
    status = status_flag(F.col("severity"), F.col("runs_with_failures"), F.col("latest_run_fail_pct"), investigate_pct)
    return out.withColumn("status_flag", status).withColumn("severity_rank", severity_rank(F.col("severity")))
