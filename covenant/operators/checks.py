"""Row annotation: evaluate every rule and mark each row with the rules it fails.

``check`` is lazy (but for ``staged``): it only adds columns, and joins per
``unique`` rule, to the logical plan.  Expression rules are plain Catalyst predicates inside one
projection, so they stay in whole-stage codegen.

``unique`` ("the first row of each key passes, later ones fail") is computed
without a window over the key, because a window sends every row of a key to
one task and a single hot key (or all NULL keys) can hold a third of the
table.  Instead, per rule:

1. per key, the rows are counted and the smallest tie-break is kept, combined
   before the shuffle, so a hot key is collapsed map-side.  Only keys of more
   than one row go on: of mostly unique keys next to nothing.  A tie-break that
   is wide (text, or many columns) is looked at for repeated keys only, which a
   count of the keys alone has found, and goes on as 128 bits;
2. keys in which several rows have the smallest tie-break are found by counting
   these rows, from the key and tie-break columns alone.  There are none where
   the tie-break identifies a row, and then step 4 falls away at run time;
3. rows join with the repeated keys on ``(key, salt)``.  NULL keys never match;
   their salt is a hash of the whole row, which spreads them over all shuffle
   partitions.  A hot non-NULL key is split by AQE's skew-join handling (the
   right side has one row per key);
4. rows that tie for first go by a 128-bit fingerprint of the whole row.  Rows
   that are equal in every column cannot be told apart: they are counted, and
   written back as one passing and n - 1 failing copies.

Text keys travel as 128 bits.  ``order_by`` orders the rows of a key; without it
all columns do, in schema order.
"""

from __future__ import annotations

import re
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Rule, as_rules, fail_condition, reference_flag
from ..session import scratch_path
from .membership import join_references

#: Expressions whose value changes from one query to the next.
_CHANGING = re.compile(r"current_(timestamp|date|time)|localtimestamp|\bnow\(|\brandn?\(|\buuid\(|shuffle\(|monotonically_increasing_id|spark_partition_id", re.I)

PASSED = "_dq_passed"
FAILED_RULES = "_dq_failed_rules"


def _orderable(field: T.StructField) -> bool:
    def ok(dt: T.DataType) -> bool:
        if isinstance(dt, (T.MapType, T.VariantType)):
            return False
        if isinstance(dt, T.ArrayType):
            return ok(dt.elementType)
        if isinstance(dt, T.StructType):
            return all(ok(f.dataType) for f in dt.fields)
        return True

    return ok(field.dataType)


def _tie_break_columns(df: DataFrame, rule: Rule, order_by: Sequence[str] | None) -> list[str]:
    cols = list(rule.order_by or order_by or [])
    if not cols:
        cols = [f.name for f in df.schema.fields if _orderable(f) and not f.name.startswith("_dq_")]
    return cols


def _hashable(field: T.StructField) -> bool:
    return "map<" not in field.dataType.simpleString() and "variant" not in field.dataType.simpleString()


def _fingerprint(df: DataFrame) -> list[Column]:
    """128 bits of the row: two hashes of all its columns, started differently."""
    cols = [F.col(f"`{f.name}`") if _hashable(f) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema.fields]
    return [F.xxhash64(*cols), F.xxhash64(F.lit("row"), *cols)]


def _fixed_width(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _narrow(types: list[T.DataType]) -> bool:
    return len(types) <= 3 and all(map(_fixed_width, types))


def _bits(types: list[T.DataType], values: list[str]) -> str | None:
    """A wide tie-break as 128 bits, as SQL; None where equal values may have other bits, or other values the same (a collation, nested NULLs)."""
    if not all(_fixed_width(t) or t.simpleString() in ("string", "binary") for t in types):
        return None
    hashed = ", ".join([*values, *[f"{v} IS NULL" for v in values]])  # a hash passes over NULL
    return f"struct(xxhash64({hashed}) AS h1, xxhash64('row', {hashed}) AS h2)"


def _unique_keys(df: DataFrame, rule: Rule) -> list[str]:
    """The key as it travels, as SQL: a text as 128 bits."""
    key = _q(rule.column)
    return [f"xxhash64({key})", f"xxhash64('key', {key})"] if dict(df.dtypes)[rule.column] in ("string", "binary") else [key]


def _firsts(df: DataFrame, keys: list[str], names: list[str], order: list[str], row: str) -> DataFrame:
    """(key, first): the smallest tie-break of each key of more than one row."""
    types = [df.schema[c].dataType for c in order]
    named = [f"{k} AS {n}" for k, n in zip(keys, names)]
    more = F.expr("count(*) AS n")
    if len(order) == 1 and _fixed_width(types[0]):  # hash aggregates; NULL is smallest
        value = _q(order[0])
        per = df.groupBy(*map(F.expr, named)).agg(more, F.expr(f"min({value}) AS m"), F.expr(f"count({value}) AS valued")).where("n > 1")
        return per.selectExpr(*names, "struct(IF(n = valued, m, NULL) AS o0) AS first")
    if _narrow(types):
        return df.groupBy(*map(F.expr, named)).agg(more, F.expr(f"min({row}) AS first")).where("n > 1").drop("n")
    # An inner join: a semi join would go below a union, and its output would be sorted once more.
    same = " AND ".join(f"{n} = {n}r" for n in names)
    right = [f"{n} AS {n}r" for n in names]
    if _fixed_width(types[0]):  # only rows that have the smallest first column are compared in full
        value = _q(order[0])
        per = df.groupBy(*map(F.expr, named)).agg(more, F.expr(f"min({value}) AS m"), F.expr(f"count({value}) AS valued")).where("n > 1")
        repeated, same = per.selectExpr(*right, "IF(n = valued, m, NULL) AS m"), f"{same} AND row.o0 <=> m"
    else:
        repeated = df.groupBy(*map(F.expr, named)).agg(more).where("n > 1").selectExpr(*right)
    firsts = df.selectExpr(*named, f"{row} AS row").join(repeated, F.expr(same)).groupBy(*names).agg(F.expr("min(row) AS first"))
    bits = _bits(types, [f"first.o{j}" for j in range(len(order))])
    return firsts.selectExpr(*names, f"{bits} AS first") if bits else firsts


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A narrow table written to the shared scratch folder, broadcast only if its counted rows are within the bound; and the rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    rows = stored.count()
    return (F.broadcast(stored) if rows <= BROADCAST_KEYS else stored), rows


def _unique_flag(df: DataFrame, rule: Rule, idx: int, order_by: Sequence[str] | None, own: list[str], staged: bool) -> tuple[DataFrame, bool]:
    """``df`` with two flags of the rule (comes after a first row, ties with others for first), and whether any row may tie."""
    key, keys, pre = _q(rule.column), _unique_keys(df, rule), f"_dq_u{idx}_"
    names = [f"{pre}k{j}" for j in range(len(keys))]
    order = _tie_break_columns(df.select(own), rule, order_by)
    row = "struct(" + ", ".join(f"{_q(c)} AS o{j}" for j, c in enumerate(order)) + ")"

    types = [df.schema[c].dataType for c in order]
    value = row if _narrow(types) else _bits(types, list(map(_q, order))) or row

    some = df.where(f"{key} IS NOT NULL")
    firsts = _firsts(some, keys, names, order, row)
    if staged:
        firsts, _ = _staged(firsts, "firsts")
    first = firsts.selectExpr(*[f"{n} AS {n}r" for n in names], "first")
    same = " AND ".join([f"{n} = {n}r" for n in names] + ["row <=> first"])
    ties = some.selectExpr(*[f"{k} AS {n}" for k, n in zip(keys, names)], f"{value} AS row").join(first, F.expr(same))
    ties = ties.groupBy(*names).agg(F.expr("count(*) AS n")).where("n > 1")
    n_ties = None
    if staged:
        ties, n_ties = _staged(ties, "ties")
    out = df.withColumn(f"{pre}salt", F.when(F.col(rule.column).isNull(), _fingerprint(df.select(own))[0]).otherwise(F.lit(0)))
    for side, x, more in ((firsts, "f", [f"first AS {pre}row"]), (ties, "t", []))[: 1 if n_ties == 0 else 2]:
        # "& 0" is not folded: a constant would become a post-join filter, and
        # the NULL-key salt would no longer be part of the shuffle key.
        side = side.selectExpr(*[f"{n} AS {n}{x}" for n in names], f"xxhash64({', '.join(names)}) & 0 AS {pre}{x}", *more)
        same = " AND ".join(f"{k} = {n}{x}" for k, n in zip(keys, names))
        out = out.join(side, F.expr(f"{key} IS NOT NULL AND {pre}salt = {pre}{x} AND {same}"), "left")
    tied = "false" if n_ties == 0 else f"{pre}t IS NOT NULL AND {value} <=> {pre}row"
    flags = f"{pre}f IS NOT NULL AND NOT ({value} <=> {pre}row) AS {pre}flag", f"{tied} AS {pre}tied"
    return out.selectExpr(*map(_q, df.columns), *flags), n_ties != 0


def _settle_ties(tied: DataFrame, rules: dict[int, Rule], own: list[str]) -> DataFrame:
    """Rows that tie for first, equal ones written back as often as they were: of a key the first copy of the smallest fingerprint passes."""
    h1, h2 = HASHES
    rows = tied.select("*", *[h.alias(n) for h, n in zip(_fingerprint(tied.select(own)), HASHES)]).groupBy(*HASHES)
    rows = rows.agg(F.expr("count(*) AS _dq_n"), *[F.expr(f"first({_q(c)}) AS {_q(c)}") for c in tied.columns])
    for i, rule in rules.items():
        keys = _unique_keys(tied, rule)
        names = [f"_dq_s{i}_k{j}" for j in range(len(keys))]
        best = rows.where(f"_dq_u{i}_tied").groupBy(*[F.expr(f"{k} AS {n}") for k, n in zip(keys, names)]).agg(F.expr(f"min(struct({h1}, {h2})) AS _dq_s{i}"))
        same = " AND ".join(f"{k} = {n}" for k, n in zip(keys, names))
        rows = rows.join(best, F.expr(f"_dq_u{i}_tied AND {same}"), "left").drop(*names)
    parts = rows.selectExpr("*", f"explode(sequence(0, CAST((_dq_n - 1) div {COPIES} AS int))) AS _dq_p")
    parts = parts.repartition(*HASHES, "_dq_p")  # very many copies of one row are written by many tasks
    copies = parts.selectExpr("*", f"explode(sequence(1, CAST(least(_dq_n - _dq_p * {COPIES}, {COPIES}) AS int))) AS _dq_i")
    passes = "_dq_p = 0 AND _dq_i = 1 AND struct({0}, {1}) <=> _dq_s{2}".format
    flags = {f"_dq_u{i}_flag": f"IF(_dq_u{i}_tied, NOT ({passes(h1, h2, i)}), _dq_u{i}_flag) AS _dq_u{i}_flag" for i in rules}
    return copies.selectExpr(*[flags.get(c, _q(c)) for c in tied.columns])


HASHES = ("_dq_h1", "_dq_h2")

#: Equal rows that one task writes back in a row.
COPIES = 1 << 16

#: Rows (a key, a tie-break, a count) up to which a stored table of repeated keys is broadcast.
BROADCAST_KEYS = 500_000


def check(
    df: DataFrame,
    rules: Iterable[Rule | Mapping] | None,
    *,
    as_of=None,
    order_by: Sequence[str] | None = None,
    staged: bool = False,
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Return ``df`` plus ``_dq_passed`` (boolean) and ``_dq_failed_rules`` (array<string>, rule order).

    With ``staged``, the repeated keys of each ``unique`` rule are found and stored
    first (two narrow tables): then their size is known, so rows with mostly
    unique keys are not shuffled at all, and a rule without ties needs no more.
    A frame that reads the clock or random numbers would have other values in
    each of these queries; it is checked in one query as without ``staged``.
    ``references`` holds the frames that ``accepted_values`` rules name (see
    ``membership``).
    """
    rules = as_rules(rules)
    if not rules:
        return pass_all(df)
    dtypes = dict(df.dtypes)
    work = df = join_references(df, rules, references)
    unique = [i for i, r in enumerate(rules) if r.rule_type == "unique"]
    staged = staged and bool(unique) and not _CHANGING.search(df._jdf.queryExecution().analyzed().toString())
    if unique:
        may_tie = []
        for i in unique:
            work, ties = _unique_flag(work, rules[i], i, order_by, df.columns, staged)
            may_tie += [i] * ties
        if may_tie:
            tied = " OR ".join(f"_dq_u{i}_tied" for i in may_tie)
            work = work.where(f"NOT ({tied})").unionByName(_settle_ties(work.where(tied), {i: rules[i] for i in may_tie}, df.columns))
    flags = [
        (r.rule_name, F.col(f"_dq_u{i}_flag") if i in unique else fail_condition(r, as_of, dtypes.get(r.column))) for i, r in enumerate(rules)
    ]
    # concat of one-element/empty arrays stays in whole-stage codegen
    # (array_compact is a higher-order function and runs interpreted).
    empty = F.array().cast("array<string>")
    failed = F.concat(*[F.when(f, F.array(F.lit(n))).otherwise(empty) for n, f in flags])
    out = work.withColumn(FAILED_RULES, failed).withColumn(PASSED, F.size(F.col(FAILED_RULES)) == 0)
    return out.drop(*map(reference_flag, rules), *[f"_dq_u{i}_{x}" for i in unique for x in ("flag", "tied")])


def pass_all(df: DataFrame) -> DataFrame:
    """Annotation for a frame with no rules: every row passes, empty failure list."""
    return df.withColumn(FAILED_RULES, F.array().cast("array<string>")).withColumn(PASSED, F.lit(True))


def failed(rule_name: str) -> Column:
    """TRUE for rows of an annotated frame that fail ``rule_name``."""
    return F.array_contains(F.col(FAILED_RULES), rule_name)
