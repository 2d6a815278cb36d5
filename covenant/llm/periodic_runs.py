"""Operator 11: periodic runs of words, found by a difference-cover LCE index on a harmonic grid.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least max(MIN_WORDS, 3 * q) words that no neighbouring
word extends keeping period q.  Words that any run holds after its first q
words are dropped from the collapsed text.

Per document (documents are worked on many at a time, each ends in a word of
its own, so nothing crosses from one to the next):

* grid: a run with period q has at least max(2 * q, MIN_WORDS - q) consecutive
  places whose word returns q words later, so the multiples of that number hold
  one of them.  Over all q this is a harmonic sum, n log n pairs (i, i + q);
* each pair is extended to both sides by its longest common extension (LCE).
  Positions whose remainder modulo COVER is in a difference cover are samples;
  two positions reach samples together within COVER words.  These words are
  compared directly; pairs that are still equal there are answered by the
  samples: sorted suffixes, common prefixes of neighbours, and a sparse table
  for range minima.  Only samples are sorted, and only of documents in which a
  pair got that far;
* of the stretches with the same ends the smallest period stays.

Defined results: null, empty and blank texts have no words, no runs and an
empty collapsed text.  Repeated rows are worked on each for itself.  Very long
texts are whole; the pairs of the grid are made in bounded pieces.  An empty
table gives an empty result.  Other columns, whatever their names, come back in
the struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD

#: Fewest words of a run.
MIN_WORDS = 24

#: A perfect difference set, every remainder modulo 31 is a difference of two of them.
COVER, COVER_SET = 31, (1, 5, 11, 24, 25, 27)

#: Words that are worked on together, and grid pairs made at a time.
CHUNK_WORDS, CHUNK_PAIRS = 100_000, 500_000

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _meeting() -> np.ndarray:
    """meet[a, b]: fewest words after which positions of remainders a and b are both samples."""
    inside = np.isin(np.arange(COVER), COVER_SET)
    r, k = np.arange(COVER), np.arange(COVER)
    both = inside[(r[:, None, None] + k) % COVER] & inside[(r[None, :, None] + k) % COVER]
    return both.argmax(axis=2)


MEET = _meeting()


class Extensions:
    """LCE of positions of a word sequence in which each document ends in a word of its own."""

    def __init__(self, seq: np.ndarray, owner: np.ndarray):
        self.seq, self.owner = seq, owner

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from i and j on (i < j in one document)."""
        out = MEET[i % COVER, j % COVER].astype(np.int64)
        live = np.arange(len(i))
        for t in range(COVER):
            live = live[out[live] > t]
            if not len(live):
                break
            same = self.seq[i[live] + t] == self.seq[j[live] + t]
            out[live[~same]] = t
            live = live[same]
        far = np.flatnonzero((out == MEET[i % COVER, j % COVER]))
        if len(far):
            out[far] += self._sampled(i[far] + out[far], j[far] + out[far])
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        order, low = self._index(np.unique(self.owner[i]))
        a, b = order[i], order[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp(b - a)[1] - 1
        return np.minimum(low[k, a], low[k, b - (1 << k)])

    def _index(self, owners: np.ndarray):
        """(place of each sample among the sorted suffixes, sparse table of neighbours' common prefixes)."""
        seq, n = self.seq, len(self.seq)
        at = np.flatnonzero(np.isin(np.arange(n) % COVER, COVER_SET) & np.isin(self.owner, owners))
        padded = np.concatenate([seq, np.zeros(COVER, seq.dtype)])
        blocks = np.lib.stride_tricks.sliding_window_view(padded, COVER)[at]
        blocks = np.ascontiguousarray(blocks.astype(">u4")).view(f"S{4 * COVER}").ravel()
        names = [self._named(at, np.unique(blocks, return_inverse=True)[1])]
        while names[-1].max() < len(at):  # a name for every pair of names, until all suffixes differ
            step = COVER << (len(names) - 1)
            after = np.where(at + step < n, names[-1][np.minimum(at + step, n - 1)], 0)
            key = names[-1][at] * np.int64(len(at) + 1) + after
            names.append(self._named(at, np.unique(key, return_inverse=True)[1]))
        rank = names[-1] - 1
        sorted_at = np.empty(len(at), np.int64)
        sorted_at[rank[at]] = at
        a, b = sorted_at[:-1].copy(), sorted_at[1:].copy()
        start = a.copy()
        for k in range(len(names) - 2, -1, -1):  # common prefix of neighbours, in blocks and then in words
            same = (np.maximum(a, b) < n) & (names[k][np.minimum(a, n - 1)] == names[k][np.minimum(b, n - 1)])
            same &= names[k][np.minimum(a, n - 1)] > 0
            a, b = a + same * (COVER << k), b + same * (COVER << k)
        live = np.arange(len(a))
        for _ in range(COVER):
            live = live[np.maximum(a[live], b[live]) < n]
            live = live[seq[a[live]] == seq[b[live]]]
            if not len(live):
                break
            a[live] += 1
            b[live] += 1
        levels = [a - start]
        while len(levels[-1]) > 1 << (len(levels) - 1):
            half = 1 << (len(levels) - 1)
            levels.append(np.concatenate([np.minimum(levels[-1][:-half], levels[-1][half:]), levels[-1][-half:]]))
        return rank, np.stack(levels)

    def _named(self, at: np.ndarray, name: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.seq), np.int64)
        out[at] = name.ravel() + 1
        return out


def _grid(first: np.ndarray, n: np.ndarray, min_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, q) pairs, in bounded pieces: for each period the multiples of the step within the document."""
    periods = np.where(n >= min_words, n // 3, 0)
    doc = np.repeat(np.arange(len(n)), periods)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(2 * q, min_words - q)
    points = -(-(n[doc] - q) // step)
    ends = np.cumsum(points)
    a = 0
    while a < len(doc):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK_PAIRS, "right")))
        c = points[a:b]
        k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        yield first[np.repeat(doc[a:b], c)] + k * np.repeat(step[a:b], c), np.repeat(q[a:b], c)
        a = b


def runs_of(docs: list[np.ndarray], min_words: int = MIN_WORDS) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs, by document, start and period; a document is its word ids, from 1."""
    n = np.array([len(d) for d in docs], np.int64)
    top = max((int(d.max()) for d in docs if len(d)), default=0)
    own = [np.array([top + 1 + k], np.int64) for k in range(len(docs) + 1)]
    seq = np.concatenate([x for k, d in enumerate(docs) for x in (own[k], d)] + [own[-1]])
    first = np.cumsum(n + 1) - n
    each = np.repeat(np.arange(len(docs)), n + 1)
    owner = np.concatenate([[-1], each])  # a document owns the word that ends it, read either way
    ahead, back, size = Extensions(seq, owner), Extensions(seq[::-1], np.concatenate([each, [-1]])[::-1]), len(seq)
    found = []
    for i, q in _grid(first, n, min_words):
        keep = seq[i] == seq[i + q]
        i, q = i[keep], q[keep]
        more = ahead.of(i, i + q)
        less = back.of(size - i - q, size - i)
        keep = more + less >= np.maximum(2 * q, min_words - q)
        i, q, more, less = i[keep], q[keep], more[keep], less[keep]
        found.append(np.stack([i - less, more + less + q, q]))
    start, length, q = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort([q, length, start])
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort([q, start])
    start, length, q = start[order], length[order], q[order]
    doc = owner[start]
    return doc, start - first[doc], length, q


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self) + 1
        return i


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _collapse(texts: list[list[bytes]], min_words: int):
    """(runs, best run, kept words joined) of each document of a chunk."""
    ids = _Ids()
    seqs = [np.fromiter(map(ids.__getitem__, w), np.int64, len(w)) for w in texts]
    doc, start, length, period = runs_of(seqs, min_words)
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    for k, words in enumerate(texts):
        part = slice(cuts[k], cuts[k + 1])
        runs = list(zip(start[part].tolist(), length[part].tolist(), period[part].tolist()))
        if runs:
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, start[part] + period[part], 1)
            np.add.at(cover, start[part] + length[part], -1)
            words = [w for w, c in zip(words, np.cumsum(cover).tolist()) if not c]
        yield runs, _best(runs), b" ".join(words)


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of the texts, in lists of documents that hold about CHUNK_WORDS words."""
    held, n = [], 0
    for text in texts.cast(pa.binary()):
        words = (text.as_py() or b"").split()
        if held and n + len(words) > CHUNK_WORDS:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def _work(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    as_run = lambda r: dict(zip(("start", "length", "period"), r)) if r else None
    for b in batches:
        at = 0
        for chunk in _chunks(b.column("text")):
            n = [len(w) for w in chunk]
            runs, best, kept = zip(*_collapse(chunk, min_words))
            yield pa.record_batch(
                {
                    "doc": b.column("doc").slice(at, len(chunk)),
                    "n_words": pa.array(n, pa.int64()),
                    "runs": pa.array([[as_run(r) for r in rs] for rs in runs], pa.list_(run)),
                    "best": pa.array([as_run(r) for r in best], run),
                    "collapsed": pa.array(kept, pa.binary()),
                }
            )
            at += len(chunk)


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, n_words, runs, best, collapsed) per row of ``docs``.

    ``doc`` holds the row's columns but ``text``; ``runs`` is the list of
    (start, length, period) by start and period; ``best`` is the run of greatest
    exact length / period (ties: smallest start, then period), null without a
    run; ``collapsed`` is the text of the kept words joined by one space.
    """
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("doc")
    rows = docs.select(doc, "text")
    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(
        lambda b: _work(b, min_words), f"doc {kind}, n_words bigint, runs array<{RUN}>, best {RUN}, collapsed binary"
    )
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """The query's input: (doc_id, text), every tenth document by crc32 with its tail turned into a repetition."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h"), (h / 10).cast("long").alias("g"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    hit = d.where("h % 10 = 0").withColumn("w", words).withColumn("n", F.size("w").cast("long"))
    hit = hit.withColumn("a", F.expr("IF(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("flatten(array_repeat(slice(w, CAST(a AS int) + 1, CAST(p AS int)), CAST((n - a) div p + 1 AS int)))")
    tail = F.array_join(F.slice(F.concat(F.expr("slice(w, 1, CAST(a AS int))"), again), F.lit(1), F.col("n").cast("int")), " ")
    hit = hit.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))
    return d.where("h IS NULL OR h % 10 <> 0").select("doc_id", "text").union(hit)


def op11(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_runs(repeated_tails(docs))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select(
        "doc.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o,
                  list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                              lambda x, y: list_reduce([xor(x, y)] || range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))) AS c
           FROM documents),
e AS (SELECT r, doc_id, o, len(o) AS n, xor(c, 4294967295) AS h, xor(c, 4294967295) // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM e),
w AS (SELECT r, doc_id, CASE WHEN h % 10 = 0 AND n > 0
          THEN list_transform(range(n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
          ELSE o END AS w, n FROM f),
p AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS t FROM w WHERE n >= 24),
m AS (SELECT x.r, x.i, y.i - x.i AS q FROM p x JOIN p y ON x.r = y.r AND x.t = y.t AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM m),
t AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY r, q, isle HAVING count(*) + q >= greatest(24, 3 * q)),
u AS (SELECT r, start, length, min(q) AS period FROM t GROUP BY r, start, length),
b AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
             list(struct_pack(start := start, length := length, period := period)) AS runs FROM u GROUP BY r),
z AS (SELECT u.*, row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) AS k FROM u),
gone AS (SELECT r, list(DISTINCT i) AS gone FROM (SELECT r, unnest(range(start + period, start + length)) AS i FROM u) GROUP BY r)
SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, z.start::BIGINT AS start, z.length::BIGINT AS length, z.period::BIGINT AS period,
       (1000 * z.length // z.period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)) END, ' ')) AS collapsed_sha256
FROM w LEFT JOIN b USING (r) LEFT JOIN z ON z.r = w.r AND z.k = 1 LEFT JOIN gone ON gone.r = w.r
"""
