"""Operator 11 against a brute-force scan of every period."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from helpers import words

from covenant.llm import periodic_runs as P


def brute(w, fewest=24):
    """Every (start, length, period), found by walking each period over the whole sequence."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(fewest, 3 * q):
                found.setdefault((s, i - s + q), q)
            i = max(i, s + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        + (sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    )


def test_difference_cover_meets_for_every_pair_of_remainders():
    assert {(a - b) % P.COVER for a in P.COVER_SET for b in P.COVER_SET} == set(range(P.COVER))
    assert P.MEET.shape == (P.COVER, P.COVER) and P.MEET.max() < P.COVER


def test_runs_of_many_small_documents_against_every_period():
    r = np.random.default_rng(11)
    for _ in range(120):
        docs = []
        for _ in range(int(r.integers(1, 8))):
            n = int(r.integers(0, 220))
            d = r.integers(1, int(r.integers(2, 6)), n)
            if n and r.random() < 0.6:
                a = int(r.integers(0, n))
                p = 1 + (n - a) // int(r.integers(3, 11))
                d = np.array([d[i] if i < a else d[a + (i - a) % p] for i in range(n)])
            docs.append(d.astype(np.int64))
        got = [[] for _ in docs]
        for k, *run in zip(*(x.tolist() for x in P.runs_of(docs))):
            got[k].append(tuple(run))
        assert got == [brute(d.tolist()) for d in docs]


def test_grid_in_pieces_and_long_periods(monkeypatch):
    monkeypatch.setattr(P, "CHUNK_PAIRS", 50)
    r = np.random.default_rng(3)
    d = r.integers(1, 400, 1500)
    d = np.array([d[i] if i < 200 else d[200 + (i - 200) % 310] for i in range(1500)])
    d[1100:1160] = d[1100]
    assert list(zip(*(x.tolist() for x in P.runs_of([d])[1:]))) == brute(d.tolist())


def test_query_on_null_empty_long_repeated_and_clashing(spark, tmp_path):
    r = np.random.default_rng(5)
    ten = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(ten) > 20
    text = lambda n, k: " ".join(f"w{x}" for x in r.integers(0, k, n))
    docs = [(i, text(int(r.integers(0, 90)), 3)) for i in range(60)] + [(i, text(150, 40)) for i in ten]
    docs += [(900, None), (901, ""), (902, " \t\n"), (903, "na " * 23), (904, "na\x0bna\n" * 12), (904, "na\x0bna\n" * 12), (905, "é  " * 40)]
    docs += [(ten[0], None), (ten[1], " "), (906, text(6000, 2)), (907, "x " * 5000), (908, text(20, 300) + " a b c" * 700 + text(20, 300))]
    spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, doc int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = P.op11(spark, str(tmp_path))
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert out.columns == cols
    assert sorted(map(tuple, out.collect()), key=str) == sorted((expected(*d) for d in docs), key=str)


def test_operator_keeps_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([("k", "a b " * 20 + "c", 7)], "runs string, text string, best int")
    row = P.find_runs(df).first()
    assert row.doc.runs == "k" and row.doc.best == 7
    assert row.n_words == 41 and [tuple(x) for x in row.runs] == [(0, 40, 2)] and tuple(row.best) == (0, 40, 2)
    assert row.collapsed == "a b c"
    assert P.find_runs(df.limit(0)).collect() == []
