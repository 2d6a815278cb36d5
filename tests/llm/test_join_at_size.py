"""The join on inputs whose keys, blocks or families are too large for one task."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, jaccard_components
from pyspark.sql import functions as F

from covenant.llm import common
from covenant.llm import jaccard_join as J


def test_many_keys_shuffle_only_rows_that_may_find_one(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("IF(id % 100 = 7, NULL, id) AS k", "repeat('x', 50) AS text")
    keys = spark.range(0, 20_000, 11).selectExpr("id AS k", "id * 2 AS v")
    n = keys.count()
    want = {how: sorted(map(str, rows.join(keys if how == "left" else keys.select("k"), "k", how).collect())) for how in ("left_semi", "left_anti", "left")}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    for how, found in want.items():
        assert sorted(map(str, common.join_keys(rows, keys if how == "left" else keys.select("k"), n, "k", how).collect())) == found
    near = rows.where(common.perhaps_among(keys, "k", n))
    assert n - n // 100 - 20 <= near.count() < 1.5 * n
    assert near.join(keys, "k", "left_semi").count() == rows.join(keys, "k", "left_semi").count()


def test_stage_keeps_the_same_rows_when_no_keys_are_broadcast(spark, monkeypatch):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    base = [[r.choice(vocab) for _ in range(60)] for _ in range(40)]
    rows = []
    for i in range(300):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 6])):
            w[r.randrange(60)] = r.choice(vocab)
        rows.append((r.choice([i, i, i, i - 1, None]), " ".join(w), i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int").repartition(5).cache()
    kept = lambda: sorted((str(x.doc_id), x.text) for x in J.stage_join(spark, docs, "").collect())
    want = kept()
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert kept() == want and len(want) < 250


@pytest.mark.parametrize("weights", [None, np.ones(J.SLOTS, np.uint8)])
def test_an_empty_part_is_no_signature_and_linked_sets_share_one(weights):
    r = np.random.default_rng(2)
    made = lambda n: np.sort(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
    tops, parts = J.size_bands(90)
    band = int(np.searchsorted(tops, 300))
    p = int(parts[band])
    step = np.uint64((1 << 64) // p)
    for _ in range(20):
        a, b = ([x for x in made(300) if x // step not in (3, 4, 5, 6)] for _ in range(2))  # no element in common, the same parts empty
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        assert not set(J.signatures(a, band, p, weights).tolist()) & set(J.signatures(b, band, p, weights).tolist())
        near = np.sort(np.concatenate([np.delete(a, r.choice(len(a), p // 2, replace=False)), made(p - 1 - p // 2)]))  # p - 1 elements differ
        for salt in (0, 3):
            x, y = (set(J.signatures(J._salted(s, salt), band, p, weights).tolist()) for s in (a, near))
            assert x & y and len(x) == p


def test_two_sides_are_compared_with_each_other_only():
    r = np.random.default_rng(6)
    base = [r.choice(1 << 40, 100, replace=False).astype(np.uint64) for _ in range(12)]
    noisy = lambda s, n: np.sort(np.concatenate([s[r.permutation(len(s))[n:]], r.choice(1 << 40, n).astype(np.uint64)]))
    sets = [noisy(base[i % 12], int(r.integers(0, 9))) for i in range(150)]
    as_sets = [set(s.tolist()) for s in sets]
    links = {(a, b) for b in range(150) for a in range(b) if 100 * len(as_sets[a] & as_sets[b]) >= 90 * len(as_sets[a] | as_sets[b])}
    for first in (1, 70, 149):
        across = {(a, b) for a, b in links if a < first <= b}
        found = J.tree_links(sets, 90, first)
        assert set(found) <= across and components(range(150), found) == components(range(150), across)
    none = J.tree_links([base[0], base[1], base[2]], 90, 1)
    assert none == [] and J.tree_links([base[0], base[0][:50]], 90) == []


def test_a_family_is_dealt_to_few_cells_each_pair_of_sets_once(spark, monkeypatch):
    """Members too noisy to link leave a large block, copies take part once, cells of two sub-blocks hold no other pairs."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(240):
        w = list(base)
        for j in r.sample(range(150), [0, 1, 2, 40][i % 4]):
            w[j] = f"n{i}x{j}"
        docs.append((1000 - i, " ".join(w)))
    seen = []

    def stage(df, name, write=common.stage):
        seen.append((name, out := write(df, name)))
        return out

    monkeypatch.setattr(J, "stage", stage)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {x.doc_id: (x.component_id, x.n_shingles) for x in J.join_groups(df, block_sets=20).collect()}
    want, size = jaccard_components(docs, 3, 90)
    assert got == {i: (want[i], size[i]) for i, _ in docs}
    last = [out for name, out in seen if name == "blocks"][-1]
    assert last.count() == 121  # of 240 documents 60 cannot link and 59 are copies


def test_rows_count_for_the_documents_of_their_block(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(1, text, 1), (2, text + " b", 1), (3, text + " c", 2), (4, "d e f g", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block long").withColumn("text", F.col("text").cast("binary"))
    assert {r.doc_id for r in J.repeated_share(df, 100, 3, 90).collect()} == {1, 2}
    assert {r.doc_id for r in J.repeated_share(df.drop("block"), 100, 3, 90).collect()} == {1, 2, 3}


def test_names_of_a_batch_differ_by_block():
    b = pa.record_batch([pa.array([1, 2], pa.int64()), pa.array([b"a b c d"] * 2), pa.array([-5, 7], pa.int64())], names=["doc_id", "text", "block"])
    (own, docs), = J._signed([b], 3, 50, None, 1)
    assert len(set(own.tolist())) == len(own) and set(docs.tolist()) == {1, 2}
