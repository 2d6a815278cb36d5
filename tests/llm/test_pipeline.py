"""The stages, each held against brute force on the rows its predecessor kept."""

import duckdb
import pytest
from helpers import jaccard_components, repeated, words
from test_language_tokens import check_packing

import corpus_pipeline
from covenant.llm import mixing
from covenant.llm.common import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(10_001, "12 34 !!", "en", "src0", 8), (10_002, None, None, None, None)], docs.schema)
    docs = stage(docs.union(junk), "test-docs")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SF), "test-stage"))
    return [x.toPandas() for x in out]


def test_language_stage(outputs):
    before, after = outputs[0], outputs[1]
    assert list(after.columns) == list(before.columns)
    assert set(before.doc_id) - set(after.doc_id) == {10_001, 10_002}


def test_join_stage(outputs):
    comp, _ = jaccard_components(list(zip(outputs[1].doc_id, outputs[1].text)), 5, 80)
    assert sorted(outputs[2].doc_id) == sorted(set(comp.values()))


def test_substring_stage(outputs):
    want = dict(zip(outputs[2].doc_id, repeated(outputs[2].text)))
    before = dict(zip(outputs[2].doc_id, outputs[2].text))
    for i, text, n in zip(outputs[3].doc_id, outputs[3].text, outputs[3].n_chars):
        assert words(text) == want[i] and n == len(text)
        assert text == before[i] or len(want[i]) < len(words(before[i]))
    assert sorted(outputs[3].doc_id) == sorted(outputs[2].doc_id)


def test_mixing_stage(outputs):
    con = duckdb.connect()
    con.register("documents", outputs[3])
    want = {i: taken // size for i, size, taken in con.sql(f"SELECT doc_id, size, taken FROM ({mixing.SQL}) WHERE taken > 0").fetchall()}
    assert outputs[4].doc_id.value_counts().to_dict() == want


def test_packing_stage(outputs):
    check_packing(list(zip(outputs[4].doc_id, outputs[4].text)), list(outputs[5].itertuples()), 1024)


def test_run_reads_the_documents(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100
