"""Contracts read as data: a folder of ``*_contract.json`` -> DataFrames.

Contracts are nested JSON documents (one per file).  They are read with an
explicit schema by Spark itself (multi-line JSON, glob filter), flattened
with ``posexplode`` into rules / columns / transforms / fixed-width fields,
and linted with plain filters.  Only the small rules table is brought to the
driver, to build Column expressions.
"""

from __future__ import annotations

import json
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import RULE_TYPES, Rule

_S = T.StringType()

PARAMS = T.StructType(
    [
        T.StructField("values", T.ArrayType(_S)),
        T.StructField("values_from", _S),
        T.StructField("values_column", _S),
        T.StructField("min", _S),  # numbers as text: a double would lose digits of large bounds
        T.StructField("max", _S),
        T.StructField("pattern", _S),
        T.StructField("format", _S),
        T.StructField("length", T.IntegerType()),
        T.StructField("order_by", T.ArrayType(_S)),
    ]
)

CONTRACT_SCHEMA = T.StructType(
    [
        T.StructField("apiVersion", _S),
        T.StructField("kind", _S),
        T.StructField("id", _S),
        T.StructField(
            "info",
            T.StructType([T.StructField(n, _S) for n in ("title", "version", "owner", "domain", "description")]),
        ),
        T.StructField(
            "dataset",
            T.StructType(
                [
                    T.StructField("name", _S),
                    T.StructField("description", _S),
                    T.StructField(
                        "columns",
                        T.ArrayType(T.StructType([T.StructField(n, _S) for n in ("name", "type", "description")])),
                    ),
                ]
            ),
        ),
        T.StructField(
            "source",
            T.StructType(
                [
                    T.StructField("path", _S),
                    T.StructField("format", _S),
                    T.StructField("options", T.MapType(_S, _S)),
                    T.StructField("rescue", T.BooleanType()),
                    T.StructField(
                        "fixed_width_columns",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("name", _S),
                                    T.StructField("start", T.IntegerType()),
                                    T.StructField("length", T.IntegerType()),
                                    T.StructField("trim", T.BooleanType()),
                                    T.StructField("cast", _S),
                                ]
                            )
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "silver",
            T.StructType(
                [
                    T.StructField("table_name", _S),
                    T.StructField(
                        "transforms",
                        T.ArrayType(T.StructType([T.StructField(n, _S) for n in ("column", "type", "format", "expr")])),
                    ),
                ]
            ),
        ),
        T.StructField(
            "quality",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("rule_name", _S),
                        T.StructField("column", _S),
                        T.StructField("rule_type", _S),
                        T.StructField("severity", _S),
                        T.StructField("description", _S),
                        T.StructField("params", PARAMS),
                    ]
                )
            ),
        ),
        T.StructField("_corrupt_record", _S),
    ]
)

CONTRACT_GLOB = "*_contract.json"


def read_contracts(spark: SparkSession, path: str, glob: str = CONTRACT_GLOB, recursive: bool = False) -> DataFrame:
    """One row per contract file, with ``_contract_file``."""
    return (
        spark.read.schema(CONTRACT_SCHEMA)
        .option("recursiveFileLookup", recursive)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", glob)
        .json(path)
        .withColumn("_contract_file", F.col("_metadata.file_path"))
    )


WRITTEN_GLOB = "part-*"


def write_contracts(spark: SparkSession, contracts: Mapping[str, Any], path: str) -> str:
    """Write contract documents (name -> dict or JSON text) below ``path``.

    Goes through Spark's writer, so ``path`` can be any shared filesystem.
    Each document is one single-row text file in ``<path>/<name>_contract/``;
    read them back with ``read_contracts(spark, path, WRITTEN_GLOB, recursive=True)``.
    """
    for name, doc in contracts.items():
        text = doc if isinstance(doc, str) else json.dumps(doc, indent=2)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}_contract")
    return path


def rules_table(contracts: DataFrame) -> DataFrame:
    """One row per quality rule: severity upper-cased, params default empty, description default ''."""
    return contracts.select(
        F.col("_contract_file").alias("contract_file"),
        F.col("id").alias("contract_id"),
        F.col("dataset.name").alias("dataset_name"),
        F.posexplode_outer("quality").alias("rule_index", "q"),
    ).where(F.col("q").isNotNull()).select(
        "contract_file",
        "contract_id",
        "dataset_name",
        "rule_index",
        F.col("q.rule_name").alias("rule_name"),
        F.col("q.column").alias("column"),
        F.col("q.rule_type").alias("rule_type"),
        F.upper(F.col("q.severity")).alias("severity"),
        F.coalesce(F.col("q.description"), F.lit("")).alias("description"),
        F.coalesce(F.col("q.params"), F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in PARAMS.fields])).alias("params"),
    )


def columns_table(contracts: DataFrame) -> DataFrame:
    return contracts.select(
        F.col("dataset.name").alias("dataset_name"),
        F.posexplode("dataset.columns").alias("position", "c"),
    ).select(
        "dataset_name",
        "position",
        F.col("c.name").alias("column"),
        F.coalesce(F.col("c.type"), F.lit("string")).alias("type"),
        F.coalesce(F.col("c.description"), F.lit("")).alias("description"),
    )


def transforms_table(contracts: DataFrame) -> DataFrame:
    return contracts.select(
        F.col("dataset.name").alias("dataset_name"),
        F.posexplode("silver.transforms").alias("step", "t"),
    ).select("dataset_name", "step", "t.column", "t.type", "t.format", "t.expr")


def fixed_width_table(contracts: DataFrame) -> DataFrame:
    return contracts.select(
        F.col("dataset.name").alias("dataset_name"),
        F.posexplode("source.fixed_width_columns").alias("position", "f"),
    ).select(
        "dataset_name",
        "position",
        "f.name",
        "f.start",
        "f.length",
        F.coalesce(F.col("f.trim"), F.lit(False)).alias("trim"),
        "f.cast",
    )


# Parameters of which a rule of each kind needs one.
NEEDED_PARAMS = {"accepted_values": ("values", "values_from"), "regex": ("pattern",), "exact_length": ("length",)}
REQUIRED = ("apiVersion", "kind", "dataset", "quality")
REQUIRED_OF_RULE = ("rule_name", "column", "rule_type", "severity")


class ContractError(ValueError):
    """Contracts that must not be run; the message lists every problem."""


def _problems(df: DataFrame, *found) -> DataFrame:
    """One row per problem; each of ``found`` is a text or NULL."""
    return df.select("contract_file", F.col("rule_index").cast("int").alias("rule_index"), F.explode(F.array_compact(F.array(*found))).alias("problem"))


def _said(condition, *parts) -> "F.Column":
    return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def known_columns(contracts: DataFrame) -> DataFrame:
    """(dataset_name, column) of what a contract's rules may refer to: declared, parsed and derived columns."""
    from .files import LINE_LENGTH

    parts = [F.col("dataset.columns.name"), F.col("source.fixed_width_columns.name"), F.col("silver.transforms.column")]
    names = F.concat(F.array(F.lit(LINE_LENGTH)), *[F.coalesce(p, F.array().cast("array<string>")) for p in parts])
    return contracts.select(F.col("dataset.name").alias("dataset_name"), F.explode(names).alias("column")).distinct()


def lint(contracts: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Contract problems as rows (contract_file, rule_index, problem); empty when all are valid.

    A document must be readable with the contract's field types (a value of
    another type is a problem, not a NULL), hold the required parts, be the only
    one of its dataset, and its rules must be of known kinds, complete, with
    parameters that make sense, named once, and about known columns: those of
    ``columns`` (dataset_name, column), by default the contract's own.
    """
    whole = F.to_json(F.struct(*[F.col(f.name) for f in CONTRACT_SCHEMA.fields]))  # every part is read, so every part is checked
    docs = contracts.withColumn("_whole", whole).withColumn("rule_index", F.lit(None).cast("int")).withColumnRenamed("_contract_file", "contract_file")
    readable = F.col("_corrupt_record").isNull() & F.col("_whole").isNotNull()
    top = _problems(
        docs,
        _said(~readable, "not readable as a contract (bad JSON or a value of the wrong type)"),
        *[_said(readable & F.col(k).isNull(), f"required part '{k}' is absent") for k in REQUIRED],
        _said(readable & F.col("dataset").isNotNull() & F.col("dataset.name").isNull(), "dataset has no name"),
        _said(F.col("kind") != "DataContract", "this is a '", F.col("kind"), "', not a DataContract"),
    )

    per = Window.partitionBy("dataset_name")
    named = docs.where("dataset.name IS NOT NULL").select("contract_file", "rule_index", F.col("dataset.name").alias("dataset_name"))
    twice = _problems(
        named.withColumn("n", F.count(F.lit(1)).over(per)), _said(F.col("n") > 1, "dataset '", F.col("dataset_name"), "' has ", F.col("n"), " contracts")
    )

    rules = rules_table(contracts)
    low, high = F.col("params.min"), F.col("params.max")
    number = lambda c: c.try_cast("decimal(38,9)")
    per_rule = _problems(
        rules,
        *[_said(F.col(k).isNull(), f"rule lacks its '{k}'") for k in REQUIRED_OF_RULE],
        _said(~F.col("rule_type").isin(*RULE_TYPES), "rule kind '", F.col("rule_type"), "' is not supported"),
        *[
            _said((F.col("rule_type") == kind) & F.coalesce(*[F.col(f"params.{p}").cast("string") for p in ps]).isNull(), f"a rule of kind {kind} lacks its parameter '{ps[0]}'")
            for kind, ps in NEEDED_PARAMS.items()
        ],
        *[_said((F.col("rule_type") == "range") & b.isNotNull() & number(b).isNull(), "bound ", b, " is not readable as a number") for b in (low, high)],
        _said((F.col("rule_type") == "range") & low.isNull() & high.isNull(), "a rule of kind range has no bound"),
        _said(number(low) > number(high), "lower bound ", low.try_cast("double"), " is above upper bound ", high.try_cast("double")),
    )
    dups = _problems(
        rules.where("rule_name IS NOT NULL").groupBy("contract_file", "rule_name").agg(F.min("rule_index").alias("rule_index"), F.count(F.lit(1)).alias("n")),
        _said(F.col("n") > 1, "duplicate rule_name '", F.col("rule_name"), "'"),
    )
    there = (columns if columns is not None else known_columns(contracts)).select(F.col("dataset_name").alias("_d"), F.col("column").alias("_c"))
    absent = rules.where("column IS NOT NULL AND dataset_name IS NOT NULL").join(there, (F.col("dataset_name") == F.col("_d")) & (F.col("column") == F.col("_c")), "left_anti")
    unknown = _problems(absent, _said(F.lit(True), "rule '", F.col("rule_name"), "' is about unknown column '", F.col("column"), "'"))
    return top.unionByName(twice).unionByName(per_rule).unionByName(dups).unionByName(unknown)


def require_valid(contracts: DataFrame, columns: DataFrame | None = None) -> None:
    """Raise ``ContractError`` if ``lint`` finds anything (a few rows, from a few small documents)."""
    found = lint(contracts, columns).orderBy("contract_file", "rule_index", "problem").collect()
    if found:
        at = lambda r: r.contract_file.rsplit("/", 1)[-1] + ("" if r.rule_index is None else f", rule {r.rule_index}")
        raise ContractError("contracts with problems:\n" + "\n".join(f"{at(r)}: {r.problem}" for r in found))


def collect_rules(rules: DataFrame, dataset_name: str | None = None) -> list[Rule]:
    """Bring the (small) rules table of one dataset to the driver as ``Rule`` objects, in rule order."""
    if dataset_name is not None:
        rules = rules.where(F.col("dataset_name") == dataset_name)
    out = []  # rules of one dataset
    for r in rules.orderBy("dataset_name", "rule_index").collect():
        p = r["params"].asDict() if r["params"] is not None else {}
        order_by = p.pop("order_by", None) or ()
        out.append(
            Rule(r["rule_name"], r["column"], r["rule_type"], r["severity"], {k: v for k, v in p.items() if v is not None}, r["description"], tuple(order_by))
        )
    return out


def contract_doc(contracts: DataFrame, dataset_name: str) -> dict:
    """One contract (small, a few KB) as a plain dict, for building the bronze/silver plans."""
    rows = contracts.where(F.col("dataset.name") == dataset_name).limit(2).collect()
    if not rows:
        raise KeyError(f"no contract for dataset {dataset_name!r}")
    doc = rows[0].asDict(recursive=True)
    if len(rows) > 1 or doc.pop("_corrupt_record", None) is not None:
        raise ContractError(f"dataset {dataset_name!r} needs one readable contract")
    return doc
