import random

import numpy as np
import pytest
from helpers import jaccard_components

from covenant.llm import jaccard_join as J


def near_texts(seed=1, n=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 12, 40, 90, 200]))] for _ in range(n // 4)]
    docs = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.2:
            w = w[: len(w) - r.randrange(1, 3)]
        docs.append((i + 10, " ".join(w).upper() if r.random() < 0.2 else "\t".join(w)))
    return docs


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "two one"), (8, "ÀB c d"), (9, "àb c d")]


@pytest.mark.parametrize("n,percent,near,sets", [(3, 90, "parts", 512), (5, 80, "rare", 512), (3, 80, "parts", 2), (3, 90, "rare", 2)])
def test_groups_equal_brute_force(spark, n, percent, near, sets):
    docs = EDGES + near_texts() + [(500, "x " * 5000 + "y"), (501, "x " * 5000 + "y")]
    got = J.join_groups(spark.createDataFrame(docs, "doc_id long, text string"), n, percent, near, sets, 200 if sets == 2 else J.BLOCK_ITEMS)
    want, size = jaccard_components(docs, n, percent)
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got.collect()} == {i: (want[i], size[i]) for i, _ in docs}
    assert len(set(want.values())) < len(docs) - 10


def test_repeated_rows_null_ids_and_other_columns(spark):
    text = "a b c d e f g h i j k l m n"
    rows = [(1, text, "x", 1), (1, text, "y", 2), (None, text, "z", 3), (2, text + " o", "n", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, sig int")
    got = sorted(map(tuple, J.join_groups(docs).collect()), key=str)
    assert got == [(1, 12, 1), (1, 12, 1), (2, 13, 1), (None, 12, None)]
    kept = J.stage_join(spark, docs, "")
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.join_groups(docs).collect() == [] and J.join_groups(docs, near="rare").collect() == []


def test_tree_prunes_but_loses_nothing():
    r = np.random.default_rng(3)
    base = np.sort(r.choice(1 << 40, 300, replace=False)).astype(np.uint64)
    sets = [np.sort(np.unique(np.concatenate([base[r.random(300) > 0.04], r.choice(1 << 40, 5).astype(np.uint64)]))) for _ in range(60)]
    sets += [np.sort(r.choice(1 << 40, 280, replace=False)).astype(np.uint64) for _ in range(20)]
    as_sets = [set(s.tolist()) for s in sets]
    want = [(a, b) for a in range(80) for b in range(a) if 100 * len(as_sets[a] & as_sets[b]) >= 90 * len(as_sets[a] | as_sets[b])]
    from helpers import components

    found = J.tree_links(sets, 90)
    assert components(range(80), found) == components(range(80), want)
    assert all((max(x), min(x)) in set(want) for x in found)


def test_rows_of_one_id_are_judged_each_for_itself(spark):
    words_ = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    rows = [(1, words_("a", 40), 0), (5, words_("a", 40), 1), (5, words_("b", 40), 2), (5, words_("b", 40), 2), (7, words_("b", 39), 3), (9, words_("c", 3), 4), (9, None, 5), (9, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int").repartition(3)
    kept = sorted((r.doc_id, (r.text or "")[:2]) for r in J.stage_join(spark, docs, "").collect())
    # 5 loses its copy of 1; its other text stands for itself, and one of it and 7's stays; null and empty are one text
    assert [x for x in kept if x[1] != "b0"] == [(1, "a0"), (9, ""), (9, "c0")]
    assert sum(x[1] == "b0" for x in kept) == 1


def test_stage_on_thousands_of_documents_with_shared_passages(spark):
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    passages = [[r.choice(vocab) for _ in range(40)] for _ in range(12)]
    docs, base = [], [[r.choice(vocab) for _ in range(r.randint(60, 160))] for _ in range(500)]
    for i in range(3000):
        w = list(r.choice(base)) if r.random() < 0.5 else [r.choice(vocab) for _ in range(r.randint(2, 150))]
        if r.random() < 0.5:
            at = r.randrange(len(w))
            w[at:at] = r.choice(passages)
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            w[r.randrange(len(w))] = r.choice(vocab)
        docs.append((i, " ".join(w)))
    from helpers import components, shingle_set

    sets = {i: shingle_set(t, 5) for i, t in docs}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for i, s in sets.items() for x in sorted(s, key=lambda x: (len(holders[x]), x))[: len(s) // 5 + 1] for a in holders[x] for b in [i] if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {x.doc_id for x in J.stage_join(spark, df, "").select("doc_id").collect()}
    assert got == set(want.values()) and len(links) > 300
    text, known = df.select("doc_id", "text"), spark.createDataFrame([(i, len(s), str(hash(s)).encode()) for i, s in sets.items() if s], "doc_id long, n long, fp binary")
    able = {x.doc_id for x in J.may_link(text, known, 5, 80).collect()}
    first = {}
    for i, s in sets.items():
        first.setdefault(s, i)
    assert {first[sets[i]] for p in links if sets[p[0]] != sets[p[1]] for i in p} <= able
    assert len(able) < 0.8 * len(docs)  # a shared passage alone does not let a document through
