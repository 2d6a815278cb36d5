import hashlib
import random

import numpy as np
import pytest
from helpers import repeated, words

from covenant.llm import substring_dedup as S


def texts(seed=5):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(200)}"
    passage = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 200)]
    out = []
    for _ in range(40):
        t = [word() for _ in range(r.randrange(5, 120))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(t))
            t[at:at] = r.choice(passage)
        out.append(r.choice([" ", "\n", "  \t"]).join(t))
    out += [out[0], out[0], "a " * 300, "b " * 36, "a b " * 100, "c d e " * 50 + "tail", " ".join(passage[3]), "", " \n ", None, "é" * 50]
    out.append("x " + "a " * 60 + "y")
    return out


@pytest.mark.parametrize("hot", [0, 3, 1_000])
def test_kept_words_equal_brute_force(spark, hot):
    docs = list(enumerate(texts()))
    got = S.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), hot=hot).collect()
    want = repeated([t for _, t in docs])
    assert len(got) == len(docs)
    for r in got:
        w = want[r.doc.doc_id]
        assert r.kept == " ".join(w), r.doc.doc_id
        assert (r.n_words, r.n_removed) == (len(words(r.doc.text)), len(words(r.doc.text)) - len(w))


def test_equal_windows_are_named_alike():
    r = np.random.default_rng(2)
    body = r.integers(0, 50, 400).astype(np.uint64)
    body[100:180] = 7
    name, own = S.windows(np.concatenate([r.integers(0, 50, 37).astype(np.uint64), body]))
    name2, own2 = S.windows(np.concatenate([r.integers(0, 50, 91).astype(np.uint64), body, r.integers(0, 50, 20).astype(np.uint64)]))
    n = 400 - 34
    assert (name[37 : 37 + n] == name2[91 : 91 + n]).all() and (own[37 : 37 + n] == own2[91 : 91 + n]).all()


def test_stage_keeps_columns_and_clean_texts(spark):
    clean = "un  touched\ttext"
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, clean, "k", 16), (2, f"start {passage}", "l", 9), (3, f"{passage} end", "m", 9), (3, clean + " too", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n_chars long")
    got = sorted(map(tuple, S.stage_substrings(spark, docs, "").collect()))
    assert got == [(1, clean, "k", 16), (2, "start", "l", 5), (3, "end", "m", 3), (3, clean + " too", None, None)]


def test_empty_table_and_digest(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.dedup(empty).collect() == []
    spark.createDataFrame([(1, "a  b"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in S.op8(spark, str(tmp_path)).collect()}
    assert got == {1: (2, 0, hashlib.sha256(b"a b").hexdigest()), 2: (0, 0, hashlib.sha256(b"").hexdigest())}
