"""Brute-force versions and fixtures for the training-data operators."""

import re
import string

import duckdb
import pandas as pd

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def sql(query, **tables):
    """Rows of a DuckDB query over pandas tables, as sorted tuples by column name."""
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t)
    rel = con.sql(query)
    cols = sorted(rel.columns)
    return cols, sorted((tuple(r) for r in rel.project(", ".join(cols)).fetchall()), key=str)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def shingle_set(text, n):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    k = min(n, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(ids, links):
    """{id: smallest id reachable}"""
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard_components(docs, n, percent):
    sets = {i: shingle_set(t, n) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return components(sets, links), {i: len(s) for i, s in sets.items()}


def repeated(texts, window=35):
    """Kept words of each text after repeated windows are removed."""
    seqs = [words(t) for t in texts]
    count = {}
    for s in seqs:
        for i in range(len(s) - window + 1):
            k = tuple(s[i : i + window])
            count[k] = count.get(k, 0) + 1
    out = []
    for s in seqs:
        gone = set()
        for i in range(len(s) - window + 1):
            if count[tuple(s[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([w for i, w in enumerate(s) if i not in gone])
    return out


def frame(rows_, columns):
    return pd.DataFrame(rows_, columns=columns)
