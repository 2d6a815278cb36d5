"""covenant: contract-driven data quality and table refinement on Spark DataFrames.

Layout:
  functions/  rule predicates, transforms, scalar helpers, deterministic picks
  sources/    contract reading/flattening/lint, delimited and fixed-width readers
  operators/  check (row annotation), measure (metrics + samples), routing,
              anomaly injectors, sinks
  plans/      composed jobs: bronze, silver, marts
  streaming/  incremental file ingestion (availableNow) and per-batch checks
  llm/        training-data operators; nothing else imports them
"""

from .functions.rules import Rule
from .operators.checks import check, pass_all
from .operators.metrics import enforce, measure, measure_rules, severity_totals

__all__ = ["Rule", "check", "pass_all", "measure", "measure_rules", "severity_totals", "enforce"]
