"""Contract transforms: typed casts, date/timestamp parses and SQL expressions.

Transforms apply in order (later ones see earlier results).  ``expr`` wins
over ``type``; an entry with neither is a no-op.  Casts and parses are the
``try_`` forms, so one bad value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Contract type names and the Spark type each one casts to.
# Any other name is passed to the cast as written (decimal(p,s), array<..>).
TYPE_ALIASES = {
    "double": "double",
    "float": "float",
    "integer": "int",
    "int": "int",
    "long": "bigint",
    "boolean": "boolean",
    "string": "string",
    "date": "date",
    "timestamp": "timestamp",
}

PROCESSED_TS = "_silver_processed_ts"


def _get(t: Any, key: str) -> Any:
    if isinstance(t, Mapping):
        return t.get(key)
    return getattr(t, key, None)


def transform_column(t: Mapping[str, Any]) -> Column | None:
    """The Column one transform entry produces, or None for a no-op."""
    name = _get(t, "column")
    expr = _get(t, "expr")
    if expr:
        return F.expr(expr)
    typ = _get(t, "type")
    if not typ:
        return None
    spark_type = TYPE_ALIASES.get(typ, typ)
    fmt = _get(t, "format")
    c = F.col(name)
    if spark_type == "date":
        return F.try_to_date(c.cast("string"), fmt) if fmt else c.try_cast("date")
    if spark_type == "timestamp" and fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt))
    return c.try_cast(spark_type)


def apply_transforms(df: DataFrame, transforms: Iterable[Mapping[str, Any]] | None, stamp: "bool | Column" = False) -> DataFrame:
    """Fold the transforms over ``df``; Catalyst collapses the projections.

    ``stamp`` adds the processing timestamp: the query's, or the column given.
    """
    for t in transforms or []:
        col = transform_column(t)
        if col is not None:
            df = df.withColumn(_get(t, "column"), col)
    if stamp is not False:
        df = df.withColumn(PROCESSED_TS, F.current_timestamp() if stamp is True else stamp)
    return df
