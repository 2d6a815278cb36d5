import math
import random

import pandas as pd
import pytest
from helpers import rows, sql, words

from covenant.llm import lm_scoring as L
from covenant.llm import mixing as M
from covenant.llm import url_filters as U


def documents(seed=3, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        src = r.choice(["a", "b", "B", "é", None, "z"] + ["hot"] * 4)
        out.append((i, " ".join(f"w{r.randrange(30)}" for _ in range(r.choice([0, 1, 5, 40, 300]))), src))
    return out + [(1000, None, "a"), (1001, "", "nothing"), (None, "one two", "a"), (7, "same row", "b"), (7, "same row", "b"), (8, "other", "b")]


def test_mix_equals_sql_and_meets_targets(spark, tmp_path):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    df.withColumn("size", df.source).withColumn("u", df.text).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op10(spark, str(tmp_path))
    pdf = pd.DataFrame(docs, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    assert rows(got) == sql(M.SQL, documents=pdf)
    by = {}
    for (i, t, s), r in zip(sorted(docs, key=str), sorted(got.collect(), key=lambda r: str((r.doc_id,)))):
        by.setdefault((r.source_size, r.target), []).append(r)
        assert 0 <= r.taken <= 3 * r.size
    total = sum(len(words(t)) for _, t, _ in docs)
    assert math.isclose(sum(t for _, t in by), total, rel_tol=1e-9)
    for (size, target), rs in by.items():
        assert target <= 3 * size and abs(sum(r.taken for r in rs) - target) <= max(r.size for r in rs)


def test_targets_stop_at_three_times_and_are_shared_anew(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1), (None, 889)], "source string, size long")
    got = {r.source: r.target for r in M.targets(sizes).collect()}
    assert got["b"] == 30 and got["c"] == 3 and math.isclose(got["a"], 300) and math.isclose(got[None], 667)


def test_mix_of_empty_table_and_stage(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(empty).collect() == []
    docs = spark.createDataFrame([(1, "a b c", "s", 5), (2, "", "s", 6)], "doc_id long, text string, source string, copies int")
    assert [tuple(r) for r in M.stage_mix(spark, docs, "").collect()] == [(1, "a b c", "s", 5)]


URLS = [
    ("http://Example.NET/en/x?q#f", "example.net", "/en/x", "example.net/en/", "allow"),
    ("http://a.example.net/de/x", "a.example.net", "/de/x", "net/", "block"),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None, None),
    ("ftp://x.org/fr/1", "x.org", "/fr/1", "org/fr/", "allow"),
    ("http://x.net", "x.net", "", None, None),
    ("http://x.net?p=://y", "x.net", "", None, None),
    ("http://é.com/ÀB", "é.com", "/ÀB", None, None),
    ("://h/p://q", "h", "/p://q", None, None),
    ("no scheme/x", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http:///p\nq#r", "", "/p\nq", None, None),
    ("https://u@bad.co.uk:80/", "u@bad.co.uk:80", "/", None, None),
]


def pages_and_labels():
    r = random.Random(4)
    pages = [(i, u) for i, (u, *_) in enumerate(URLS)]
    pages += [(100 + i, f"http://h{i % 7}.site{i % 3}.com/p{i}") for i in range(400)] + [(2, URLS[2][0]), (None, "http://x.com/")]
    labels = [(100 + i, None if r.random() < 0.1 else int(i % 7 != 1), None if r.random() < 0.5 else 0) for i in range(400)]
    return pages, labels + [(101, 1, 0), (None, 0, 1), (5, None, None)]


def test_urls_equal_sql_and_rules(spark):
    pages, labels = pages_and_labels()
    p = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "url AS host", "1 AS bad")
    got = U.judge(p, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    frames = dict(pages=pd.DataFrame(pages, columns=["page_id", "url"]).astype({"page_id": "Int64"}), labels=pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    assert rows(got) == sql(U.SQL, **frames)
    by = {r.page_id: r for r in got.collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = by[i]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
    assert by[101].verdict == "block" and by[100].verdict == "allow"


def test_reputation_blocks_and_allows_hosts_without_labels_as_in_sql(spark):
    r = random.Random(6)
    hosts = [f"h{i % 40}.{d}" for i in range(900) for d in [r.choice(["spam.com", "good.com", "mixed.org", "bad.co.uk", "fine.co.uk", "alone.de"])]]
    rate = {"spam.com": 0.95, "good.com": 0.02, "mixed.org": 0.45, "bad.co.uk": 0.9, "fine.co.uk": 0.03, "alone.de": 0.5}
    pages = [(i, f"https://{h}/p{i}") for i, h in enumerate(hosts)]
    labels = [(i, int(r.random() > rate[h.split(".", 1)[1]]), 0) for i, h in enumerate(hosts) if r.random() < 0.6]
    new = ["new.spam.com", "new.good.com", "x.bad.co.uk", "x.fine.co.uk", "other.co.uk", "else.com", "z.museum"]
    pages += [(2000 + i, f"http://{h}/") for i, h in enumerate(new)]
    got = U.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    frames = dict(pages=pd.DataFrame(pages, columns=["page_id", "url"]), labels=pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]))
    assert rows(got) == sql(U.SQL, **frames)
    by = {x.page_id: x.verdict for x in got.collect()}
    assert [by[2000 + i] for i in range(4)] == ["block", "allow", "block", "allow"]
    assert {"block", "allow"} == {by[i] for i in range(900)}


def test_urls_without_labels_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.verdict for r in U.judge(pages, labels).collect()] == ["allow"]
    none = dict(pages=pd.DataFrame([(1, "http://a.b/c")], columns=["page_id", "url"]), labels=pd.DataFrame([(1, None, None)], columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    assert rows(U.judge(pages, labels)) == sql(U.SQL, **none)
    assert U.judge(pages.limit(0), labels).collect() == []


def naive_scores(docs, backoff=0.4):
    from collections import Counter

    seqs = [words(t, lower=True) for _, t in docs]
    c1 = Counter(w for s in seqs for w in s)
    total = sum(c1.values())
    c2 = Counter(p for s in seqs for p in zip(s, s[1:]))
    out = []
    for s in seqs:
        own = Counter(zip(s, s[1:]))
        x = math.log(c1[s[0]] / total) if s else 0.0
        for v, w in zip(s, s[1:]):
            k = c2[v, w] - own[v, w]
            x += math.log(k / c1[v]) if k else math.log(backoff * c1[w] / total)
        out.append((len(s), x))
    return out


@pytest.mark.parametrize("bucket,task", [(2_000_000, 8_000_000), (300, 500)])
def test_scores_equal_brute_force(spark, monkeypatch, bucket, task):
    monkeypatch.setattr(L, "CHUNK_WORDS", 900 if bucket == 300 else L.CHUNK_WORDS)
    docs = [(i, t) for i, t, _ in documents()] + [(2000, "HOT pair " * 3000), (2001, "hot pair\u00a0x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS words").repartition(3)
    got = sorted(((str(r.doc_id), r.n_words, r.score) for r in L.score(df, bucket, task).collect()))
    want = sorted((str(i), *x) for (i, _), x in zip(docs, naive_scores(docs)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def test_scores_of_empty_table(spark):
    assert L.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
