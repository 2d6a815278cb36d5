"""Refine every contract in a folder: bronze stream, then silver, several datasets at a time.

This is the "drop a contract, get the tables" entry point.  Only the contract
documents (a few KB each) come to the driver; each dataset's work is the
bronze and silver plans.  All datasets of one call share ``run_id``; the
results table keeps them apart by its (run_id, dataset_name) partitions.

Each dataset submits its jobs in a scheduler pool of its own, so with
``spark.scheduler.mode`` FAIR a large dataset does not hold up the small ones.
A dataset that fails does not touch the others: they are published, and then
``RefineError`` names the ones that failed, with their errors.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.contracts import CONTRACT_GLOB, contract_doc, read_contracts, require_valid
from ..sources.files import read_results_history
from .bronze import read_bronze, run_bronze
from .silver import resolve_run_id, run_silver


#: Datasets refined at a time.
PARALLEL = 4


class RefineError(RuntimeError):
    """Datasets that could not be refined; ``failed`` maps their names to the errors. All others are published."""

    def __init__(self, failed: dict[str, Exception]):
        self.failed = failed
        super().__init__("not refined:\n" + "\n".join(f"{name}: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}" for name, e in sorted(failed.items())))


def _each_in_its_pool(spark: SparkSession, names: list[str], work: Callable[[str], None], parallel: int) -> dict[str, Exception]:
    """Run ``work`` for each name, its jobs in the scheduler pool of that name; errors by name."""
    sc = spark.sparkContext

    def one(name: str) -> Exception | None:
        sc.setLocalProperty("spark.scheduler.pool", f"refine-{name}")
        try:
            work(name)
        except Exception as e:  # another dataset's failure is reported, not passed on
            return e
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
        return None

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        # a target for each name: it carries a copy of the local properties of its own
        found = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(partial(one, name))) for name in names]]
    return {name: e for name, e in zip(names, found) if e is not None}


def refine_all(
    spark: SparkSession,
    contracts_path: str,
    source_root: str,
    base: str,
    *,
    run_id: str | None = None,
    run_ts=None,
    as_of=None,
    mode: str = "warn",
    glob: str = CONTRACT_GLOB,
    recursive: bool = False,
    parallel: int = PARALLEL,
) -> DataFrame:
    """Bronze + silver for each contract, ``parallel`` at a time; returns this run's results.

    Nothing runs while any contract of the folder has a problem (``ContractError``).
    Datasets that fail are reported by ``RefineError`` when all are done.

    A contract's ``source.path`` is resolved below ``source_root``.  Contracts
    without a ``silver`` section only get a bronze table.
    """
    run_id = resolve_run_id(run_id)
    docs = read_contracts(spark, contracts_path, glob, recursive)
    require_valid(docs)
    names = sorted(r[0] for r in docs.select(F.col("dataset.name")).where(F.col("dataset.name").isNotNull()).collect())

    def refine(name: str) -> None:
        contract = contract_doc(docs, name)
        src = f"{source_root.rstrip('/')}/{contract['source']['path'].strip('/')}"
        bronze_path = f"{base}/bronze_{name}"
        run_bronze(spark, contract, bronze_path, f"{base}/_checkpoints/bronze_{name}", path=src)
        if contract.get("silver"):
            run_silver(spark, read_bronze(spark, contract, bronze_path, src), contract, base, run_id=run_id, run_ts=run_ts, as_of=as_of, mode=mode)

    failed = _each_in_its_pool(spark, names, refine, parallel)
    if failed:
        raise RefineError(failed)
    return read_results_history(spark, f"{base}/dq_results").where(F.col("run_id") == run_id)
