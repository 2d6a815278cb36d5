"""``accepted_values`` against a reference table instead of a list in the rule.

A rule names the table by ``params.values_from`` (a path, or the name under
which the caller hands the frame over in ``references``) and ``values_column``
(by default the rule's own column name).  Rows whose value is not among the
reference's values fail; NULL passes, as with a list.

Values travel as the column's own type, texts as 128 bits.  The reference is
reduced to its distinct values, and broadcast only if these are counted and
within BROADCAST_VALUES; beyond that rows join with them by value.  NULL values
match nothing and are spread by a hash of the row; a hot value is split by AQE's
skew handling, as the reference side has one row per value.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, reference_flag

#: Distinct values (16 bytes each for texts) up to which a reference is broadcast.
BROADCAST_VALUES = 1_000_000


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def reference_of(df: DataFrame, rule: Rule, references: Mapping[str, DataFrame] | None) -> DataFrame:
    """The rule's reference frame: handed over by name, or read from a path or catalog table."""
    name = rule.param("values_from")
    if references and name in references:
        return references[name]
    return df.sparkSession.read.parquet(name) if "/" in name else df.sparkSession.read.table(name)


def _keys(column: str, kind: str) -> list[str]:
    return [f"xxhash64({column})", f"xxhash64('key', {column})"] if kind in ("string", "binary") else [column]


def join_references(df: DataFrame, rules: Iterable[Rule], references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``df`` with a flag (TRUE: fails) for each rule that has a reference table."""
    for i, rule in enumerate(rules):
        if rule.rule_type != "accepted_values" or not rule.param("values_from"):
            continue
        kind, column = dict(df.dtypes)[rule.column], _q(rule.column)
        keys = _keys(column, kind)
        names = [f"_dq_v{i}_{j}" for j in range(len(keys))]
        value = _q(rule.param("values_column", rule.column))
        listed = reference_of(df, rule, references).selectExpr(f"try_cast({value} AS {kind}) AS v").where("v IS NOT NULL")
        values = listed.selectExpr(*[f"{k} AS {n}" for k, n in zip(_keys("v", kind), names)]).distinct()
        if values.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES:
            values = F.broadcast(values)
        own = [_q(c) for c in df.columns]
        hashable = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        salted = df.selectExpr("*", f"IF({column} IS NULL, xxhash64({', '.join(map(_q, hashable))}), 0L) AS _dq_salt")
        same = " AND ".join(f"{k} = {n}" for k, n in zip(keys, names))
        # "& 0" is not folded, so the salt stays part of the join key
        side = values.selectExpr("*", f"xxhash64({', '.join(names)}) & 0 AS _dq_listed")
        joined = salted.join(side, F.expr(f"{column} IS NOT NULL AND _dq_salt = _dq_listed AND {same}"), "left")
        df = joined.selectExpr(*own, f"{column} IS NOT NULL AND _dq_listed IS NULL AS {reference_flag(rule)}")
    return df
