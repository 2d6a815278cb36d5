"""The corpus pipeline: stages over the documents table, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the docs of the next:

* texts without a letter, or far from every learned language, go;
* of each group of linked documents the one with the smallest doc_id stays;
* passages of 35 words and more that repeat leave all texts;
* each document stands as often as the mix takes it (texts left empty go);
* the last stage gives the pieces and their places in sequences of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covenant.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from covenant.llm.common import stage

STAGES = [
    ("language ID", language_id.stage_language),
    ("n-gram Jaccard join", jaccard_join.stage_join),
    ("substring dedup", substring_dedup.stage_substrings),
    ("mixing sources to target weights", mixing.stage_mix),
    ("best-fit packing", packing.stage_pack),
]

#: Language prediction and tokens have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs
