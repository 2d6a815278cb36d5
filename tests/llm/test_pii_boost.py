"""Operator 12: base spans against plain patterns, added spans on formats that the strict patterns miss."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from covenant.llm import pii_boost as P

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sums_to_ten(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    """The contract's base spans, by its patterns as they are written."""
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"\D", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(d) <= 19 and sums_to_ten(d),
                "phone": lambda: 10 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def card(r):
    d = "".join(r.choice("0123456789") for _ in range(15))
    return next(d + c for c in "0123456789" if sums_to_ten(d + c))


def datum(r, kind):
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    return {
        "email": lambda: f"{r.choice(['ana', 'li.wu', 'x9'])}{n(2)}@mail{n(1)}.example.{r.choice(['com', 'org'])}",
        "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        "card": lambda: card(r),
        "phone": lambda: f"+1 ({n(3)}) {n(3)}-{n(4)}",
    }[kind]()


def prose(r, n):
    return " ".join(r.choice("the of,and on,12,3.5,room,2024-01-07 room,line,at noon. later".split(",")) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    r = random.Random(12)
    out = [(i, f"{prose(r, 20)} {datum(r, r.choice(P.KINDS))} {prose(r, 9)}") for i in range(1500)]
    return out + [(i, prose(r, 60)) for i in range(1500, 2000)]


@pytest.fixture(scope="module")
def model(spark, docs):
    return P.fit(spark.createDataFrame(docs, "doc_id long, text string"))


def test_base_spans_on_random_signs():
    r = random.Random(7)
    pieces = ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "+1", "(", ")", " ", "-", "4111111111111111", "12", "x_y", "é", "0" * 30, "+49 30 901820", "--", "\n", "a.b@c", "٣"]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert P.base_spans(text) == plain(text), text


def test_scans_are_linear_in_long_texts():
    start = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "1 " * 150_000, "+1" + " " * 300_000, " at " * 70_000, "a.b" * 100_000 + "@"):
        P.base_spans(text)
        P.proposed(text, P._islands(text))
    assert time.time() - start < 60
    assert P.base_spans("1.1.1." + "0" * 5000 + "1") == [(0, 1, 5007)]


def test_boosting_learns_what_one_cut_cannot_and_threshold_needs_evidence():
    r = np.random.default_rng(1)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = P.boost(x, y, np.ones(len(y)))
    assert ((m.score(x) > 0.5) == (y > 0.5)).mean() > 0.95
    score = np.linspace(1, 0, 1000)
    truth = (np.arange(1000) < 300).astype(float)
    t = P.calibrate(score, truth, np.ones(1000))
    assert (score >= t).sum() == 300
    assert np.allclose(P.isotonic(np.array([0.1, 0.2, 0.3, 0.3]), np.array([1.0, 0, 1, 1]), np.ones(4)), [0.5, 0.5, 1, 1])
    assert P.calibrate(score[:10], np.ones(10), np.ones(10)) == float("inf")


def test_added_spans_find_other_formats_and_leave_clean_texts_alone(docs, model):
    assert all(m.threshold < 1 for m in model.values()) and set(model) == {0, 1, 2, 3}

    def added(text):
        islands = P._islands(text)
        return [(P.KINDS[k], text[s:e]) for s, k, e, _ in P.added_spans(text, P.base_spans(text, islands), islands, model)]

    r = random.Random(3)
    hits = {k: 0 for k in P.KINDS}
    for _ in range(200):
        c, d = card(r), datum(r, "phone")
        odd = {"email": datum(r, "email").replace("@", " at ").replace(".", " dot "), "ip": datum(r, "ip").replace(".", " . "), "card": f"{c} {c}", "phone": d[4:7] + "-" + d[9:]}
        for k, x in odd.items():
            hits[k] += bool([1 for kind, _ in added(f"{prose(r, 12)} {x} {prose(r, 7)}") if kind == k])
    assert min(hits.values()) > 120, hits
    d = datum(r, "phone")
    assert ("phone", d) in added(f"of {d} 190.137.223.20 the")
    clean = [added(t) for i, t in docs if i >= 1500]
    assert sum(map(bool, clean)) <= 5


def test_query_columns_and_edges(spark, tmp_path, docs):
    edge = [(3000, None), (3001, ""), (3002, "é🙂 a@b.co +1 (609) 555-6973"), (3002, "é🙂 a@b.co +1 (609) 555-6973"), (3003, "+1 (609) 555-6973 10.0.0.1"), (3004, "0" * 20_000)]
    spark.createDataFrame([(*d, "x") for d in docs[:400] + edge], "doc_id long, text string, spans string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = P.op12(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = sorted(map(tuple, out.collect()), key=str)
    want = []
    for i, t in docs[:400] + edge:
        base = plain(t)
        line = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base)
        want.append((i, *(sum(b[1] == k for b in base) for k in range(4)), hashlib.sha256(line.encode()).hexdigest()))
        spans = [x for x in next(g[6] for g in got if g[0] == i).split(",") if x]
        assert {x for x in line.split(",") if x} <= set(spans)
        assert spans == sorted(spans, key=lambda x: (int(x.split(":")[1]), P.KINDS.index(x.split(":")[0])))
    assert [g[:6] for g in got] == sorted(want, key=str)


def test_operator_redacts_keeps_columns_and_takes_empty_tables(spark, model):
    df = spark.createDataFrame([("k", "mail a@b.co now", 5), ("n", None, 6), ("c", "nothing", 7)], "spans string, text string, base int")
    got = {r.doc.spans: r for r in P.find_pii(df, model).collect()}
    assert got["k"].redacted == "mail [EMAIL] now" and got["k"].doc.base == 5 and got["k"].spans[0].score == 1.0
    assert got["n"].spans == [] and got["n"].redacted is None and got["c"].redacted is None
    empty = df.limit(0)
    assert P.find_pii(empty, P.fit(empty.select(F.lit(1).alias("doc_id"), "text"))).collect() == []


def test_models_and_thresholds_come_from_every_document(spark):
    """More documents than any bounded sample took: the fit equals one over all examples at hand, whatever the partitions."""
    r = random.Random(5)
    texts = [f"{r.choice(['call', 'room', 'of'])} {r.choice([datum(r, 'phone'), f'{r.randint(100, 999)}-{r.randint(1000, 9999)}', datum(r, 'ip')])} {i}" for i in range(24_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    split = df.select("text", (F.pmod(F.xxhash64(F.lit(2), "text"), F.lit(1 << 30)) < 1 << 29).alias("held")).collect()
    rows = [(*e, x.held) for x in split for e in P.examples(x.text)]
    got = P.fit(df.repartition(5))
    assert set(got) == {1, 3}
    for k, m in got.items():
        x, y, w, held = (np.array([v[i] for v in rows if v[0] == k]) for i in (3, 1, 2, 4))
        want = P.boost(x[~held].astype(float), y[~held], w[~held])
        assert (m.start, m.feature, m.cut, m.value) == (want.start, want.feature, want.cut, want.value)
        score = want.score(x[held].astype(float))
        assert m.threshold == P.calibrate(np.floor(score * P.LEVELS) / P.LEVELS, y[held], w[held]) < 1
