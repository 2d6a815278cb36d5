"""Quality rules as data, and the Catalyst predicate for each rule kind.

Every predicate is TRUE for a *failing* row and is wrapped in
``coalesce(.., false)`` so a NULL comparison never makes a row vanish from
both the clean and the quarantine side.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from decimal import Decimal, InvalidOperation
from hashlib import md5
from typing import Any, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule kinds a contract may name, and the severities the
# summary always reports (in this order).
RULE_TYPES = (
    "not_null",
    "unique",
    "accepted_values",
    "range",
    "regex",
    "not_future_date",
    "date_format",
    "exact_length",
)
SEVERITIES = ("CRITICAL", "ERROR", "WARNING")
# Rule kinds that become bronze expectations (monitor mode).
EXPECTATION_TYPES = ("not_null", "accepted_values", "regex", "exact_length")


@dataclass(frozen=True)
class Rule:
    rule_name: str
    column: str
    rule_type: str
    severity: str = "ERROR"
    params: Mapping[str, Any] = field(default_factory=dict)
    description: str = ""
    order_by: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "severity", str(self.severity or "ERROR").upper())
        object.__setattr__(self, "order_by", tuple(self.order_by or ()))
        object.__setattr__(self, "params", dict(self.params or {}))

    def param(self, name: str, default: Any = None) -> Any:
        value = self.params.get(name) if self.params else None
        return default if value is None else value

    @staticmethod
    def of(obj: "Rule | Mapping[str, Any]") -> "Rule":
        if isinstance(obj, Rule):
            return obj
        d = dict(obj)
        params = d.get("params") or {}
        if hasattr(params, "asDict"):
            params = params.asDict()
        params = {k: v for k, v in dict(params).items() if v is not None}
        order_by = d.get("order_by") or params.pop("order_by", None) or ()
        params.pop("order_by", None)
        return Rule(
            rule_name=d["rule_name"],
            column=d["column"],
            rule_type=d["rule_type"],
            severity=str(d.get("severity") or "ERROR").upper(),
            params=params,
            description=d.get("description") or "",
            order_by=tuple(order_by),
        )


def as_rules(rules: Iterable["Rule | Mapping[str, Any]"] | None) -> list[Rule]:
    return [Rule.of(r) for r in (rules or [])]


def reference_flag(rule: Rule) -> str:
    """The column that ``join_references`` adds for a rule with a reference table."""
    return "_dq_ref_" + md5(rule.rule_name.encode()).hexdigest()[:12]


def as_of_date(as_of: "str | _dt.date | Column | None") -> Column:
    """The reference date for `not_future_date`; a parameter, never the wall clock by default."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def _as_date(c: Column, dtype: str | None) -> Column:
    if dtype == "date":
        return c
    if dtype in (None, "string"):
        return F.try_to_date(c)
    return F.to_date(c)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _is_numeric(dtype: str | None) -> bool:
    return dtype is not None and (dtype in _NUMERIC or dtype.startswith("decimal"))


def _as_number(v: Any) -> float | None:
    if isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        return v
    try:
        return float(str(v))
    except ValueError:
        return None


def bound(v: Any) -> Any:
    """A range bound, without loss of digits: contracts give numbers as text."""
    if not isinstance(v, str):
        return v
    try:
        number = Decimal(v)
    except InvalidOperation:
        raise ValueError(f"a range bound must be a number, not {v!r}") from None
    return int(number) if number == number.to_integral_value() and abs(number) < 2**63 else float(v) if "." in v or "e" in v.lower() else number


def _accepted(c: Column, values: list, dtype: str | None) -> Column:
    """Membership that never raises: contract values are strings, columns may be numbers."""
    if _is_numeric(dtype):
        nums = [_as_number(v) for v in values]
        if all(n is not None for n in nums):
            return c.isin([int(n) if float(n).is_integer() and "." not in str(v) else n for n, v in zip(nums, values)])
        return c.cast("string").isin([str(v) for v in values])
    if dtype == "boolean":
        # Contract values may be JSON booleans or their names; other values accept nothing.
        named = {"true": True, "false": False}
        return c.isin([b for b in (v if isinstance(v, bool) else named.get(str(v).strip().lower()) for v in values) if b is not None])
    if dtype in (None, "string"):
        return c.isin([v if isinstance(v, str) else str(v) for v in values])
    return c.cast("string").isin([str(v) for v in values])


def fail_condition(rule: Rule, as_of=None, dtype: str | None = None) -> Column:
    """Column that is TRUE exactly when ``rule`` fails on the row (never NULL)."""
    c = F.col(rule.column)
    kind = rule.rule_type
    if kind == "not_null":
        cond = c.isNull()
    elif kind == "accepted_values" and rule.param("values_from"):
        cond = F.col(reference_flag(rule))
    elif kind == "accepted_values":
        values = list(rule.param("values", []))
        # An empty list accepts nothing: every non-null value fails.
        cond = c.isNotNull() if not values else ~_accepted(c, values, dtype)
    elif kind == "range":
        lo, hi = bound(rule.param("min")), bound(rule.param("max"))
        # A string column is compared as a number; a malformed value is NULL
        # (and passes, like any NULL) instead of failing the whole job.
        c = c.try_cast("double") if dtype == "string" else c
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (c < F.lit(lo))
        if hi is not None:
            cond = cond | (c > F.lit(hi))
    elif kind == "regex":
        cond = ~c.cast("string").rlike(rule.param("pattern", ".*"))
    elif kind == "not_future_date":
        cond = _as_date(c, dtype) > as_of_date(as_of)
    elif kind == "date_format":
        s = c if dtype in (None, "string") else c.cast("string")
        cond = F.try_to_date(s, rule.param("format", "yyyy-MM-dd")).isNull() & c.isNotNull()
    elif kind == "exact_length":
        n = c.try_cast("bigint") if dtype == "string" else c
        cond = n != F.lit(int(rule.param("length", 0)))
    else:
        # Unknown kinds never fail a row; the contract lint reports them.
        cond = F.lit(False)
    return F.coalesce(cond, F.lit(False))


def expectation_condition(rule: Rule) -> Column | None:
    """Pass condition for the bronze monitor (CRITICAL rules of four kinds only, without a reference table).

    Built with the Column API (no SQL text), so regex backslashes survive and
    NULL passes for every kind except ``not_null``.
    """
    if rule.severity != "CRITICAL" or rule.rule_type not in EXPECTATION_TYPES or rule.param("values_from"):
        return None
    return ~fail_condition(rule)
