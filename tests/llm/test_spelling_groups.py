"""Operator 13 against pairwise edit distances."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from covenant.llm import spelling_groups as S
from covenant.llm.queries import ORACLE
from helpers import rows, sql, frame


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    best = {w: min(x, key=lambda v: (-counts[v], v), default=None) for w, x in near.items()}
    form = {w: b if b and counts[b] >= ratio * counts[w] else None for w, b in best.items()}
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def vocabulary(r, size, alphabet, lengths):
    words = set()
    while len(words) < size:
        w = "".join(r.choice(alphabet) for _ in range(r.choice(lengths)))
        for _ in range(r.randint(1, 4)):
            words.add(w)
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice(alphabet) + w[i:], w[:i] + r.choice(alphabet) + w[i + 1 :], w]) or w
    return {w: r.choice([2, 3, 25, 300, 4000]) for w in words}


def result(spark, counts, **how):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return set(map(tuple, S.spelling_forms(df, **how).collect()))


@pytest.mark.parametrize("alphabet,cell_words", [("ab", 10), ("abcdeé", 30), ("abcdefghijklmnopqrst", 25), ("xyжशü🙂", 10_000)])
def test_forms_against_all_pairs(spark, alphabet, cell_words):
    counts = vocabulary(random.Random(len(alphabet)), 500, alphabet, [4, 5, 6, 7, 9])
    assert result(spark, counts, cell_words=cell_words) == brute(counts)


def test_pruned_search_finds_every_near_word(monkeypatch):
    monkeypatch.setattr(S, "LEAF", 4)
    monkeypatch.setattr(S, "COMPARED", 50)
    r = random.Random(2)
    words = list(vocabulary(r, 900, "abcdef", [6, 7]))
    own, short = [w for w in words if len(w) == 7], [w for w in words if len(w) == 6]
    a, b = S.cell_links(own[: len(own) // 2], own[len(own) // 2 :], short)
    every = own + short
    half = len(own) // 2
    want = {frozenset((i, j)) for i in range(len(every)) for j in range(half) if one_edit(every[i], every[j])}
    got = [frozenset(p) for p in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want


def test_anagrams_and_very_long_words():
    r = random.Random(4)
    base = list("abcdefg")
    words = list({"".join(r.sample(base, 7)) for _ in range(800)})
    a, _ = S.cell_links(words, [], [])
    assert len(a) == 0
    long_ = ["a" * 5000, "a" * 2500 + "b" + "a" * 2499]
    a, b = S.cell_links(long_, [], ["a" * 4999])
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {frozenset((0, 1)), frozenset((0, 2)), frozenset((1, 2))}
    assert S.points(["a" * 5000])[1][0, 0] == 5000


def test_chains_of_forms_end_at_the_root(spark):
    counts = {"aaaaaaa": 10**6, "aaaaaab": 10**5, "aaaaabb": 10**4, "aaaabbb": 10**3, "aaabbbb": 100, "aabbbbb": 10, "zzzzzzz": 5}
    got = {w: (f, root) for w, f, root, *_ in result(spark, counts)}
    assert got["aabbbbb"] == ("aaabbbb", "aaaaaaa") and got["aaaaaaa"] == (None, "aaaaaaa") and got["zzzzzzz"] == (None, "zzzzzzz")
    ties = {"bbbbbbb": 2, "bbbbbbc": 20, "bbbbbba": 20, "ébbbbbb": 20}
    assert {w: f for w, f, *_ in result(spark, ties)}["bbbbbbb"] == "bbbbbba"


def test_query_and_sql_on_small_documents(spark, tmp_path):
    r = random.Random(9)
    words = list(vocabulary(r, 60, "abÀé", [7, 8]))
    docs = [(i, " ".join(r.choice(words[:20] if r.random() < 0.7 else words) + r.choice(["", ".", "ß", "İ"]) for _ in range(80))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "Ωabcdefgh7abcdefgh ABCDEFGH É" + "x" * 3000), (102, "abcdefgh×÷abc")]
    table = frame([(*d, 1, 2) for d in docs], ["doc_id", "text", "n", "word"])
    spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n int, word int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out = S.op13(spark, str(tmp_path))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert set(map(tuple, out.collect())) == brute(counts)
    assert rows(out) == sql(ORACLE["op13_spelling_groups"], documents=table)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_forms(S.word_counts(S.slipped(S.letter_runs(docs)))).collect() == []
    assert S.Tree(np.zeros((0, S.AXES), np.uint8), 4).members[0].size == 0
