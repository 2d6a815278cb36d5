"""Small scalar building blocks used by the marts and the rule-health report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import as_of_date


# Band by rating, rank by severity, and the bands and ranks of all else.
RISK_BANDS = {1: "LOW", 2: "LOW", 3: "MEDIUM", 4: "HIGH", 5: "HIGH"}
NO_BAND = "UNKNOWN"
SEVERITY_RANKS = {"CRITICAL": 1, "ERROR": 2, "WARNING": 3}
NO_RANK = 4
# Status by severity and the measure that must exceed the limit (None: always).
STATUS = (("CRITICAL", "runs", "ACTION_REQUIRED"), ("ERROR", "latest", "INVESTIGATE"), ("WARNING", None, "MONITOR"))
NO_STATUS = "HEALTHY"


def looked_up(key: Column, values: dict, default) -> Column:
    """The value of ``key`` in a literal map; ``default`` for other keys and NULL."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def risk_band(rating: Column) -> Column:
    return looked_up(rating.cast("int"), RISK_BANDS, NO_BAND)


def flag(cond: Column) -> Column:
    """Boolean flag where NULL counts as false."""
    return F.coalesce(cond, F.lit(False))


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when the denominator is 0 or NULL."""
    return F.when(den != 0, num / den)


def days_since(c: Column, as_of=None) -> Column:
    return F.datediff(as_of_date(as_of), F.to_date(c))


def key_prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def severity_rank(sev: Column) -> Column:
    return looked_up(sev, SEVERITY_RANKS, NO_RANK)


def status_flag(severity: Column, runs_with_failures: Column, latest_fail_pct: Column, investigate_pct: float = 5.0) -> Column:
    """Status of a rule by its severity's row of ``STATUS``; HEALTHY when the measure is within its limit."""
    over = {"runs": runs_with_failures > 0, "latest": latest_fail_pct > investigate_pct, None: F.lit(True)}
    named = [F.when((severity == sev) & over[measure], status) for sev, measure, status in STATUS]
    return F.coalesce(*named, F.lit(NO_STATUS))


def pass_fail(fail_count: Column) -> Column:
    return F.when(fail_count > 0, "FAIL").otherwise("PASS")
