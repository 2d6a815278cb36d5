"""Routing: bronze expectations (monitor mode) and the clean / quarantine split."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.rules import Rule, as_rules, expectation_condition
from .checks import FAILED_RULES, PASSED


def expectations(rules: Iterable[Rule | Mapping]) -> dict[str, Column]:
    """rule_name -> pass condition, for the CRITICAL rules bronze can monitor."""
    out: dict[str, Column] = {}
    for r in as_rules(rules):
        cond = expectation_condition(r)
        if cond is not None:
            out[r.rule_name] = cond
    return out


def _counters(exp: dict[str, Column]) -> list[Column]:
    return [F.count_if(~c).alias(name) for name, c in exp.items()] or [F.count(F.lit(1)).alias("_rows")]


def observe_expectations(df: DataFrame, rules, observation: "Observation | str" = "expectations") -> DataFrame:
    """Attach failure counters to ``df`` without dropping rows (works on streams too).

    For a stream pass a name and read ``query.lastProgress['observedMetrics']``;
    for a batch pass an ``Observation`` and read ``.get`` after an action.
    """
    exp = expectations(rules)
    return df.observe(observation, *_counters(exp))


def expectation_counts(df: DataFrame, rules) -> DataFrame:
    """Failed-record count per expectation as rows (rule_name, failed_records), one job."""
    exp = expectations(rules)
    if not exp:
        return df.sparkSession.createDataFrame([], "rule_name string, failed_records long")
    agg = df.agg(*[F.count_if(~c).alias(f"_e{i}") for i, c in enumerate(exp.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("rule_name"), F.col(f"_e{i}").cast("long").alias("failed_records")) for i, n in enumerate(exp)])
    return agg.select(F.inline(rows))


def clean(annotated: DataFrame) -> DataFrame:
    """Rows that passed every rule (the silver 'expect or drop')."""
    return annotated.where(F.col(PASSED))


def quarantine_condition(rules=None, severities: Iterable[str] | None = None) -> Column:
    """TRUE for rows to quarantine: any failure by default, or failures of rules
    with the given severities only."""
    if severities is None:
        return ~F.col(PASSED)
    sev = {s.upper() for s in severities}
    names = [r.rule_name for r in as_rules(rules) if r.severity in sev]
    if not names:
        return F.lit(False)
    return F.exists(F.col(FAILED_RULES), lambda n: n.isin(names))


def quarantine(annotated: DataFrame, rules=None, severities: Iterable[str] | None = None) -> DataFrame:
    """Rows that failed.  By default any failing rule quarantines a row; with
    ``severities`` only failures of rules with those severities count."""
    return annotated.where(quarantine_condition(rules, severities))

