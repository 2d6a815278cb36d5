"""Stupid-backoff scores of every document from word pairs counted over all documents.

    S(w | v) = (c(v w) - own(v w)) / c(v)    if that is above 0
             = BACKOFF * c(w) / N            else;      S(first word) = c(w) / N

own() counts the scored document's own pairs, so a text is judged by the others.
The score of a text is the sum of the logarithms; the query gives it as it is, and
per word, by which texts of any length compare.
Words are lower-cased (A-Z).  Words are named by 64-bit hashes and pairs by a hash
of both; every word has a count of its own.  Documents are packed in chunks.  A
chunk sends the names of its distinct words and pairs to hash buckets, where they
are added up over all chunks, and gets the sums back; so a word or pair that all
documents share is one entry for each chunk.

Cases: null text and text without words score 0 with 0 words; repeated rows are
other documents to each other; null and repeated doc_ids do not matter, as
results are made by row; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, WordIds, grouped, mix, stage, texts_of

BACKOFF = 0.4
#: Words of the texts packed together.
CHUNK_WORDS = 800_000
#: Pairs of a bucket, and pairs of documents that one task joins to a bucket's counts.
BUCKET_PAIRS, TASK_PAIRS = 2_000_000, 8_000_000


CHUNK = ["chunk", "ids", "size", "lens", "n_words", "words", "tokens"]
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _squeeze(x: np.ndarray) -> bytes:
    """Integers, compressed as the byte planes of their differences."""
    x = np.diff(x.astype(np.uint64), prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True) if len(x) else b""


def _spread(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(raw, n * 8, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of documents: doc ids, numbers of words, distinct names of words and the texts as places among these."""
    serial = TaskContext.get().partitionId() << 32
    names = WordIds()

    def packed(ids: list, seqs: list[np.ndarray]) -> pa.RecordBatch:
        n = np.array([len(x) for x in seqs], np.int64)
        words, tokens = np.unique(np.concatenate(seqs), return_inverse=True)
        tokens = pa.compress(np.ascontiguousarray(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True) if n.sum() else b""
        row = [[serial], [ids], [int(n.sum())], [n.tobytes()], [len(words)], [_squeeze(words)], [tokens]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array(x, t) for x, t in zip(row, types)], names=CHUNK)

    ids, seqs, size = [], [], 0
    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text"))):
            x = names.of(words_of(text))
            ids.append(doc_id)
            seqs.append(x)
            size += len(x)
            if size >= CHUNK_WORDS:
                yield packed(ids, seqs)
                serial, ids, seqs, size = serial + 1, [], [], 0
    if ids:
        yield packed(ids, seqs)


class Chunk:
    """A packed chunk with the names of its words and pairs, in the order of (bucket, name)."""

    def __init__(self, row: dict, buckets: int):
        self.ids, self.n = row["ids"], np.frombuffer(row["lens"], np.int64)
        size, words = row["size"], _spread(row["words"], row["n_words"])
        planes = pa.decompress(row["tokens"], size * 4, "zstd", asbytes=True) if size else b""
        self.tokens = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, size).T).view("<u4").ravel().astype(np.int64)
        self.of = np.repeat(np.arange(len(self.n)), self.n)
        joint = self.of[1:] == self.of[:-1]
        self.pair_of = self.of[1:][joint]
        both, self.pair, n = np.unique(self.tokens[:-1][joint] << 32 | self.tokens[1:][joint], return_inverse=True, return_counts=True)
        self.v, self.w, self.words = both >> 32, both & 0xFFFFFFFF, len(words)
        self.key = np.concatenate([mix(words + _B), mix(mix(words[self.v] + _A) + words[self.w])])
        self.count = np.concatenate([np.bincount(self.tokens, minlength=len(words)), n])
        self.order = np.argsort(self.key)  # a bucket is a range of names, which makes their differences small
        bucket = (self.key[self.order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1).astype(np.uint64))

    def scores(self, count: np.ndarray, total: int) -> np.ndarray:
        """Scores of the documents from the counts over all documents, in the order of names."""
        log = np.log(count[: self.words])
        term = log[self.tokens] - np.log(total)
        term[1:][self.of[1:] == self.of[:-1]] += np.log(BACKOFF)
        base = np.bincount(self.of, term, minlength=len(self.n))
        key, own = np.unique(self.pair_of << 32 | self.pair, return_counts=True)
        place, pair = key >> 32, key & 0xFFFFFFFF
        others = count[self.words :][pair] - own
        seen = others > 0
        place, pair, own = place[seen], pair[seen], own[seen]
        gain = own * (np.log(others[seen]) - log[self.v[pair]] - np.log(BACKOFF) - log[self.w[pair]] + np.log(total))
        return base + np.bincount(place, gain, minlength=len(self.n))


def _ask(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, chunk, n, names, counts): the names of a chunk's words and pairs, each once, with their counts in the chunk."""
    for b in batches:
        for row in b.to_pylist():
            c = Chunk(row, buckets)
            rows = []
            for k in np.flatnonzero(np.diff(c.cuts)):
                at = c.order[c.cuts[k] : c.cuts[k + 1]]
                rows.append((int(k), row["chunk"], len(at), _squeeze(c.key[at]), pa.compress(c.count[at].astype("<i8").tobytes(), "zstd", asbytes=True)))
            if rows:
                types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["bucket", "chunk", "n", "names", "counts"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, bucket, totals): for each row of a bucket the counts of its names over all documents; rows sorted by bucket."""
    for t in grouped(batches, ["bucket"]):
        n = t.column("n").to_pylist()
        names = [_spread(x, k) for x, k in zip(t.column("names").to_pylist(), n)]
        counts = [np.frombuffer(pa.decompress(x, k * 8, "zstd", asbytes=True), "<i8") for x, k in zip(t.column("counts").to_pylist(), n)]
        key, at = np.unique(np.concatenate(names), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, at, np.concatenate(counts))
        cuts = np.cumsum([0, *n])
        out = [pa.compress(total[at[a:b]].tobytes(), "zstd", asbytes=True) for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.record_batch([pa.array(t.column("chunk").to_pylist(), pa.int64()), pa.array(t.column("bucket").to_pylist(), pa.int32()), pa.array(out, pa.binary())], names=["chunk", "bucket", "totals"])


def _scores(batches: Iterator[pa.RecordBatch], buckets: int, total: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, score) of a chunk's documents, whose own row comes first among its rows."""
    now, count = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array(now.ids, pa.int64()), pa.array(now.n), pa.array(now.scores(count, max(1, total)))], names=["doc_id", "n_words", "score"])

    for b in batches:
        for row in b.to_pylist():
            if row["totals"] is None:
                if now is not None:
                    yield done()
                now = Chunk(row, buckets)
                count = np.zeros(len(now.key), np.int64)
            else:
                x, y = now.cuts[row["bucket"]], now.cuts[row["bucket"] + 1]
                count[now.order[x:y]] = np.frombuffer(pa.decompress(row["totals"], int(y - x) * 8, "zstd", asbytes=True), np.int64)
    if now is not None:
        yield done()


def score(docs: DataFrame, bucket_pairs: int = BUCKET_PAIRS, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(doc_id, n_words, score) for every row of (doc_id, text): the natural logarithm of the text's score."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))

    schema = "chunk long, ids array<long>, size long, lens binary, n_words long, words binary, tokens binary"
    chunks = stage(rows.mapInArrow(_pack, schema), "chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // min(bucket_pairs, task_pairs)))

    asked = chunks.mapInArrow(lambda b: _ask(b, buckets), "bucket int, chunk long, n long, names binary, counts binary")
    asked = asked.repartition("bucket").sortWithinPartitions("bucket")
    found = asked.mapInArrow(_totals, "chunk long, bucket int, totals binary")
    each = chunks.unionByName(found, allowMissingColumns=True)
    each = each.repartition("chunk").sortWithinPartitions("chunk", F.col("totals").isNotNull())
    return each.mapInArrow(lambda b: _scores(b, buckets, total), "doc_id long, n_words long, score double")


def op7(spark, sf_dir: str) -> DataFrame:
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    per_word = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).otherwise(0.0)
    return out.select("doc_id", "n_words", F.round(per_word, 4).alias("score"), F.round("score", 3).alias("log_score"))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
t AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
c AS (SELECT word, count(*) AS n FROM t GROUP BY word),
u AS (SELECT word AS id, n FROM c),
s AS (SELECT r, i, word AS id, lag(word) OVER (PARTITION BY r ORDER BY i) AS prev FROM t),
own AS (SELECT r, prev, id, count(*) AS own FROM s WHERE prev IS NOT NULL GROUP BY ALL),
a AS (SELECT prev, id, sum(own) AS n FROM own GROUP BY ALL),
x AS (SELECT sum(n) AS total FROM u),
p AS (
  SELECT r, own * CASE WHEN a.n > own THEN ln((a.n - own) / up.n::DOUBLE) ELSE ln({BACKOFF} * ui.n / total) END AS s
  FROM own JOIN a USING (prev, id) JOIN u up ON up.id = own.prev JOIN u ui ON ui.id = own.id, x
  UNION ALL SELECT r, ln(u.n / total) FROM s JOIN u USING (id), x WHERE prev IS NULL),
q AS (SELECT r, sum(s) AS s FROM p GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, round(CASE WHEN len(w) > 0 THEN s / len(w) ELSE 0 END, 4) AS score,
       round(coalesce(s, 0), 3) AS log_score
FROM d LEFT JOIN q USING (r)
"""
