"""Quality rules on micro-batches, with ``unique`` across all batches of a stream.

Which keys a stream has had lives in the query's own state store (RocksDB, with
changelog checkpoints), as 128-bit fingerprints: the streaming plan holds the
rows of a batch beside the keys that ``dropDuplicates`` lets through, so a batch
brings along the keys that are new with it.  A row fails ``unique`` if its key is
not among them, or if an earlier row of its own batch has it.

The cost of a batch is that of its own rows: no earlier batch is read again.  A
batch is staged once, so the stateful part of the plan runs once a batch.  A
batch that is replayed after a failure starts from the state as it was before it
and gets the same answer.  The state holds one entry per distinct key.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import Rule, as_rules
from ..operators.checks import FAILED_RULES, PASSED, check
from ..session import remove_path, scratch_path
from .ingest import run_foreach_batch

#: Settings of the state store while a checked stream starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

ROW, RULE, KEY = "_dq_row", "_dq_rule", ("_dq_k1", "_dq_k2")


@contextmanager
def _settings(spark: SparkSession, conf: Mapping[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _key(column: str):
    return F.xxhash64(F.col(column)).alias(KEY[0]), F.xxhash64(F.lit("key"), F.col(column)).alias(KEY[1])


def with_new_keys(stream: DataFrame, unique: list[Rule]) -> DataFrame:
    """The stream's rows (rule -1) and, per ``unique`` rule by its number, the keys that no earlier batch had."""
    none = [F.lit(None).cast("long").alias(k) for k in KEY]
    rows = stream.select(F.lit(-1).alias(RULE), *none, F.struct(*(F.col(f"`{c}`") for c in stream.columns)).alias(ROW))
    if not unique:
        return rows
    no_keys = F.array().cast(f"array<struct<{RULE}:int,{KEY[0]}:bigint,{KEY[1]}:bigint>>")
    each = [F.when(F.col(r.column).isNotNull(), F.array(F.struct(F.lit(i).alias(RULE), *_key(r.column)))).otherwise(no_keys) for i, r in enumerate(unique)]
    keys = stream.select(F.inline(F.concat(*each))).dropDuplicates([RULE, *KEY])
    return rows.unionByName(keys.withColumn(ROW, F.lit(None).cast(rows.schema[ROW].dataType)))


def check_rows(rows: DataFrame, new_keys: DataFrame, rules: Iterable[Rule | Mapping], as_of=None) -> DataFrame:
    """``check`` for one batch; ``unique`` also fails keys that are not among ``new_keys`` (rule number, key)."""
    rules = as_rules(rules)
    out, old = check(rows, rules, as_of=as_of), {}
    for i, r in enumerate(x for x in rules if x.rule_type == "unique"):
        names = [f"{k}_{i}" for k in KEY]
        own = new_keys.where(F.col(RULE) == i).select(*[F.col(k).alias(n) for k, n in zip(KEY, names)])
        on = F.col(r.column).isNotNull()
        for k, n in zip(_key(r.column), names):
            on = on & (k == F.col(n))
        out = out.join(own, on, "left").withColumn(f"_dq_old_{i}", F.col(r.column).isNotNull() & F.col(names[0]).isNull()).drop(*names)
        old[r.rule_name] = F.col(f"_dq_old_{i}")
    none = F.array().cast("array<string>")
    names = [F.when(F.array_contains(FAILED_RULES, r.rule_name) | old.get(r.rule_name, F.lit(False)), F.array(F.lit(r.rule_name))).otherwise(none) for r in rules]
    out = out.withColumn(FAILED_RULES, F.concat(none, *names)).withColumn(PASSED, F.size(FAILED_RULES) == 0)
    return out.drop(*[f"_dq_old_{i}" for i in range(len(old))])


def run_checked(
    stream: DataFrame,
    rules: Iterable[Rule | Mapping],
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    as_of=None,
) -> StreamingQuery:
    """Run ``handler(annotated, batch_id)`` per micro-batch until the available input is processed.

    ``annotated`` has ``check``'s columns; ``unique`` holds over all batches that
    the checkpoint's query has processed.
    """
    rules = as_rules(rules)
    unique = [r for r in rules if r.rule_type == "unique"]

    def work(batch: DataFrame, batch_id: int) -> None:
        session, path = batch.sparkSession, scratch_path(batch.sparkSession, "batch")
        try:
            batch.write.partitionBy(RULE).parquet(path)
            staged = session.read.schema(batch.schema).parquet(path)
            rows = staged.where(F.col(RULE) == -1).select(f"{ROW}.*")
            handler(check_rows(rows, staged.where(F.col(RULE) >= 0), rules, as_of), batch_id)
        finally:
            remove_path(session, path)

    with _settings(stream.sparkSession, STATE_STORE):
        return run_foreach_batch(with_new_keys(stream, unique), work, checkpoint)
