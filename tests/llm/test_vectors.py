import math

import numpy as np
import pytest
from helpers import components, rows, sql

from covenant.llm import embedding_dedup as D
from covenant.llm import exact_search as X

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def vectors(seed=0, n=230, dim=8):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centre[r.integers(12)] + r.normal(size=dim) * r.choice([0, 0.05, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(3)), "s"))
    rows += [(1000, None, 1, ""), (1001, [1.0, None], 1, ""), (1002, [math.nan] * dim, 1, ""), (1003, [math.inf] * dim, 1, ""), (1004, [0.0] * dim, 1, "")]
    rows += [(1005, rows[0][1], None, ""), (1006, rows[0][1], None, ""), (1007, [1.0, 2.0], 1, ""), (1008, [2.0, 4.0], 1, ""), (1050, [], 1, ""), (1100, [], 2, "")]
    return rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def best(rows, k=5):
    ints = {i: [math.floor(256 * x) for x in v] for i, v, *_ in rows if usable(v)}
    out = set()
    for q, x in ints.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ints.items() if i != q and len(y) == len(x))[:k]
            out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("blocks", [(1024, 4096), (2, 7)])
def test_search_equals_brute_force(spark, monkeypatch, blocks):
    from pyspark.sql import functions as F

    monkeypatch.setattr(X, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(X, "BLOCK", blocks[1])
    rows = vectors()
    rows += [(2000 + i, rows[50][1], 0, "") for i in range(9)] + [(2100, [3e9] * 8, 0, ""), (2101, [-3e9] * 8, 0, ""), (2150, [4e9] * 8, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = X.search(df, F.pmod(F.col("id"), F.lit(50)) == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    limit = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    assert set(map(tuple, got.collect())) == {(q, r, i, limit(s)) for q, r, i, s in best(rows)}


def test_search_repeated_rows_and_empty_table(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.25, 0.0]), (None, [9.0, 9.0])]
    got = X.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 256 * 128), (0, 2, 1, 256 * 64)]
    rows = [(50, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.1, 0.9]), (2, [0.5, 0.5]), (50, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in X.search(df, F.col("id") == 50).collect())
    scores = lambda q: sorted((-int(np.floor(256 * np.array(q)) @ np.floor(256 * np.array(v))), i) for i, v in rows if v != q)
    assert got == sorted((50, k + 1, i, -s) for q in ([1.0, 0.0], [0.5, 0.25]) for k, (s, i) in enumerate(scores(q)))
    assert max(r[3] for r in got) == 256 * 230
    assert X.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") == 0).collect() == []


def test_elimination_skips_candidates(monkeypatch):
    import pandas as pd

    r = np.random.default_rng(1)
    x = np.floor(256 * np.concatenate([r.normal(size=(2000, 4)) * 0.01 + c for c in np.eye(4)]))
    p = X.choose_pivots(x[::50], 16)
    far = np.sqrt(((x[:, None] - p) ** 2).sum(2))
    table = pd.DataFrame({"id": range(len(x)), "key": range(len(x)), "x": list(x), "norm": (x**2).sum(1), "far": list(far)})
    seen = []
    monkeypatch.setattr(X.np, "lexsort", lambda keys, f=np.lexsort: (seen.append(1), f(keys))[1])
    X.best_of_block(table[:20], table, 5)
    assert len(seen) * X.STEP < 20 * len(x) / 3  # most candidates are never computed


@pytest.mark.parametrize("tile", [1024, 9])
def test_near_duplicates_equal_brute_force(spark, tile):
    rows = vectors(4)
    rows += [(3000 + i, rows[3][1], rows[3][2], "") for i in range(4)]
    got = D.near_duplicates(spark.createDataFrame(rows, SCHEMA), tile=tile).collect()
    ok = {i: (np.array(v, float), lab) for i, v, lab, _ in rows if usable(v) and lab is not None and any(v)}
    links = []
    for a, (x, la) in ok.items():
        for b, (y, lb) in ok.items():
            if a < b and la == lb and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.93:
                links.append((a, b))
    comp = components([r[0] for r in rows], links)
    n = {i: sum(i in link for link in links) for i in comp}
    assert {tuple(r) for r in got} == {(i, n[i], comp[i], comp[i] == i) for i in comp}
    assert len(links) > 100


def test_near_duplicates_null_ids_and_empty_table(spark):
    got = D.near_duplicates(spark.createDataFrame([(None, [1.0], 1), (7, [1.0], 1)], "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(map(str, map(tuple, got))) == ["(7, 0, 7, True)", "(None, 0, None, True)"]
    assert D.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_int8_bound_is_rigorous():
    r = np.random.default_rng(0)
    for dim in (3, 64, 2000):
        a, b = r.normal(size=(50, dim)), r.normal(size=(60, dim)) ** 3
        b[:50] = a + r.normal(size=a.shape) * 0.3
        a, b = (x / np.sqrt((x * x).sum(1, keepdims=True)) for x in (a, b))
        i, j = np.nonzero(a @ b.T >= 0.5)
        assert set(zip(i, j)) <= set(zip(*D.may_link(a, b, 0.5)))


def test_rows_of_one_vec_id_have_their_own_links(spark):

    near = [1.0, 0.05]
    vectors = [(1, [1.0, 0.0], "a"), (2, near, "a"), (3, [1.0, 0.01], "a"), (3, [0.0, 1.0], "a"), (5, [0.0, -1.0], "a"), (3, [0.0, -1.0], "b"), (6, [1.0, 0.0], "a"), (9, None, "a"), (3, [1.0, 0.0], None)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label string")
    got = sorted(tuple(r) for r in D.near_duplicates(df).collect())
    linked = [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (6, 3, 1, False)]
    # of id 3's other rows, two stand alone but belong to its component, and one takes no part
    assert got == sorted([*linked, (3, 0, 1, False), (3, 0, 1, False), (3, 0, 3, True), (5, 0, 5, True), (9, 0, 9, True)])
    import pandas as pd

    frame = pd.DataFrame(vectors, columns=["vec_id", "embedding", "label"])
    assert rows(D.near_duplicates(df)) == sql(D.SQL, embeddings=frame)
    twins = spark.createDataFrame([(7, [1.0, 0.0], "a"), (7, [0.0, 1.0], "a"), (8, [0.0, 1.0], "a")], "vec_id long, embedding array<double>, label string")
    assert sorted(tuple(r) for r in D.near_duplicates(twins).collect()) == [(7, 0, 7, True), (7, 1, 7, True), (8, 1, 7, False)]


def test_search_takes_products_of_many_queries_at_once(monkeypatch):
    """Pivots that rule out little: a query costs a share of one product of blocks, not a loop over its candidates."""
    import pandas as pd

    r = np.random.default_rng(3)
    x = np.floor(r.normal(size=(1500, 24)) * 256)
    x[700:720] = x[5]  # ties
    ids = r.permutation(1500)
    table = pd.DataFrame({"id": ids, "key": np.arange(1500), "x": list(x), "norm": (x**2).sum(1), "far": list(np.sqrt(((x[:, None] - x[:4]) ** 2).sum(2)))})
    calls, taken = [], X._best_together
    monkeypatch.setattr(X, "_best_together", lambda *a: calls.append(len(a[0])) or taken(*a))
    got = X.best_of_block(table[:130], table, 5)
    assert calls == [64, 64, 2]
    for i in range(130):
        want = sorted((-int(s), v) for s, v, k in zip(x @ x[i], ids, range(1500)) if k != i)[:5]
        mine = got[got.key == i]
        assert [(-s, v) for s, v in zip(mine.score, mine.vec_id)] == want
    assert X.best_of_block(table[:3], table[:3], 5).groupby("key").size().tolist() == [2, 2, 2]
    assert len(X.best_of_block(table[:3], table[:0], 5)) == len(X.best_of_block(table[:0], table, 5)) == 0


def test_elimination_leaves_few_candidates_to_a_block_of_queries():
    r = np.random.default_rng(1)
    x = np.floor(256 * np.concatenate([r.normal(size=(1000, 4)) * 0.01 + c for c in np.eye(4)]))
    p = X.choose_pivots(x[::50], 16)
    far = np.sqrt(((x[:, None] - p) ** 2).sum(2))
    bound = X._bounds(far[:20], (x[:20] ** 2).sum(1), far, (x**2).sum(1))
    scores = x[:20] @ x.T
    assert (bound >= scores).all()
    left = X._left(x[:20], x, bound, 5)
    assert left.any(0).sum() < len(x) / 3
    assert all(set(np.argsort(-s, kind="stable")[:5]) <= set(np.flatnonzero(m)) for s, m in zip(scores, left))
