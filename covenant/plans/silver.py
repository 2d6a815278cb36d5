"""Silver: transforms, all quality rules, metrics, gate, quarantine, clean rows.

A constant number of jobs whatever the rule count:

1. write the annotated rows once to a staging folder, partitioned by
   ``_dq_passed`` (the only pass over whole rows; a ``unique`` rule reads its key
   and tie-break columns before, and shuffles rows only if its repeated keys are
   too many to broadcast);
2. metrics + samples for every rule from the stored rows, written to the
   results table (one run partition, rerun-safe);
3. the failing rows go to the quarantine table (run partition, rerun-safe;
   when there are none, an earlier attempt's rows are removed);
4. the CRITICAL gate reads the few result rows;
5. only behind the gate the clean rows are published as the silver table's new
   version; the former one can be read until the switch and beyond.

So a run that the gate stops leaves its results and its quarantine, and the
silver table as it was.  Stored intermediates cut the lineage, so a lost
executor only recomputes the step it was running.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import Rule, as_rules
from ..functions.transforms import apply_transforms
from ..operators.checks import FAILED_RULES, PASSED, check
from ..operators.metrics import GATE_COLUMNS, RESULTS_SCHEMA, gate_messages, measure
from ..operators.routing import quarantine_condition
from ..operators.publish import publish, register
from ..operators.sinks import write_quarantine, write_results, write_table
from ..sources.files import read_results_history


@dataclass
class SilverRun:
    run_id: str
    clean: DataFrame
    annotated: DataFrame
    results: DataFrame
    quarantined: bool
    messages: list[str] = field(default_factory=list)


def resolve_run_id(run_id: str | None) -> str:
    """An empty or missing run id gets a fresh uuid (runs never share an id by accident)."""
    return run_id if run_id else str(uuid.uuid4())


def silver_frame(df: DataFrame, transforms, rules: Sequence[Rule], *, as_of=None, order_by=None, stamp: bool = True, staged: bool = False) -> DataFrame:
    """Silver plan: ordered transforms, processing timestamp, rule annotation; lazy but for ``staged``."""
    if stamp and staged:  # one time for all queries of the run
        stamp = F.lit(_dt.datetime.now(_dt.timezone.utc))
    return check(apply_transforms(df, transforms, stamp=stamp), rules, as_of=as_of, order_by=order_by, staged=staged)


def run_silver(
    spark: SparkSession,
    bronze: DataFrame,
    contract: Mapping[str, Any],
    base: str,
    *,
    rules: Sequence[Rule] | None = None,
    run_id: str | None = None,
    run_ts: "_dt.datetime | str | None" = None,
    as_of=None,
    order_by: Sequence[str] | None = None,
    mode: str = "warn",
    fmt: str = "parquet",
    quarantine_severities=None,
    tables: Mapping[str, str] | None = None,
) -> SilverRun:
    """One silver run below ``base``; ``tables`` may name catalog tables for ``silver`` and ``results``."""
    run_id = resolve_run_id(run_id)
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    dataset = contract["dataset"]["name"]
    silver_name = (contract.get("silver") or {}).get("table_name") or f"silver_{dataset}"
    transforms = (contract.get("silver") or {}).get("transforms") or []
    rules = as_rules(rules if rules is not None else contract.get("quality") or [])

    staging = f"{base}/_staging_{silver_name}"
    frame = silver_frame(bronze, transforms, rules, as_of=as_of, order_by=order_by, staged=True)
    write_table(frame, staging, fmt=fmt, partition_by=[PASSED])
    # With its schema an empty feed reads back too; the filter on the partition column prunes.
    stored = spark.read.schema(frame.schema).format(fmt).load(staging)

    results_path = f"{base}/dq_results"
    if rules:
        write_results(measure(stored, rules, dataset=dataset, run_id=run_id, run_ts=run_ts).drop("rule_idx"), results_path, fmt)
        results = read_results_history(spark, results_path, fmt).where((F.col("run_id") == run_id) & (F.col("dataset_name") == dataset))
        # One small read of the run's results (one row per rule) answers both
        # the gate and whether anything needs quarantining.
        summary = results.select(*GATE_COLUMNS).collect()
        sev = None if quarantine_severities is None else {x.upper() for x in quarantine_severities}
        any_bad = any(r.fail_count > 0 and (sev is None or r.severity in sev) for r in summary)
    else:
        results, summary, any_bad = spark.createDataFrame([], RESULTS_SCHEMA), [], False
    # Default: any failing rule quarantines (and the clean side is a pruned
    # partition).  With severities, clean stays the exact complement.
    cond = quarantine_condition(rules, quarantine_severities)
    quarantined = write_quarantine(stored, f"{base}/{dataset}_quarantine", run_id, fmt, cond, known_nonempty=any_bad)
    messages = gate_messages(summary, mode)

    clean_rows = stored.where(F.col(PASSED) if quarantine_severities is None else ~cond).drop(PASSED, FAILED_RULES)
    silver_path = publish(clean_rows, f"{base}/{silver_name}", fmt)
    published = spark.read.schema(clean_rows.schema).format(fmt).load(silver_path)
    tables = tables or {}
    if "silver" in tables:
        said = contract["dataset"].get("description") or dataset
        register(spark, tables["silver"], silver_path, clean_rows.schema, fmt, comment=f"{said}: rows that pass the quality rules", properties={"quality": "silver"})
    if "results" in tables and rules:
        register(spark, tables["results"], results_path, RESULTS_SCHEMA, fmt, ("run_id", "dataset_name"), "Quality results: a row per run, dataset and rule", {"quality": "results"})
    return SilverRun(run_id, published, stored, results, quarantined, messages)
