"""Remove long repeated word runs, found by recompression.

Words are named by 64-bit hashes.  Rounds then name what stands together: first
runs of one word, then, round after round, pairs whose left symbol falls in one
half of the alphabet and whose right symbol in the other.  Halves and names come
from hashes, so every task gives equal strings equal symbols and a round needs
no exchange of a dictionary.  Each symbol knows its context, the words that
decided its rounds: wherever those words stand, the same symbol stands there.

A window of W words names itself by one of the symbols whose context lies within
it (the longest, ties by hash), which equal windows choose alike; a window with
no such symbol names itself by its own words.  Spark counts the names; only
windows under a name that occurs twice can repeat, and those are compared by the
hashes of all their words.  Words under a repeated window are removed.

Cases: null text has no words; texts shorter than a window lose nothing; a text
that stands in several rows is worked on once and loses all its words if it has
a window; repeated and null ids do not matter, as rows meet by text; an empty
table gives an empty result; other columns, whatever their names, are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.session import small_batches

from .common import WordIds, mix, sliced, stage, text_key, texts_of, tidied, whole_groups

WINDOW, ROUNDS, LONGEST = 35, 4, 8
#: Names with more occurrences are compared window by window in shuffles that split and pre-aggregate.
HOT = 20_000

_SEED = np.uint64(0x9E3779B97F4A7C15)
_FAR = 1 << 40


def symbols(words: np.ndarray, rounds: int = ROUNDS, longest: int = LONGEST) -> tuple[np.ndarray, ...]:
    """(name, length, context start, context end) of the last round's symbols, in text order."""
    n = len(words)
    # runs of one word up to ``longest``; whether a run ends shows only in its neighbours
    edge = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    size = np.diff(np.append(edge, n))
    whole = size <= longest
    lo = np.where(edge > 0, edge - 1, -_FAR)
    hi = np.where(edge + size < n, edge + size + 1, _FAR)
    count = np.where(whole, 1, size)
    of = np.repeat(np.arange(len(edge)), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    start = edge[of] + k
    end = np.where(whole[of], start + size[of], start + 1)
    # a word of a longer run: longest + 1 equal words around it decide that it stays single
    first = np.minimum(np.maximum(k - longest, 0), size[of] - longest - 1) + edge[of]
    cl = np.where(whole[of], lo[of], first)
    cr = np.where(whole[of], hi[of], first + longest + 1)
    name = mix(words[start] + (end - start).astype(np.uint64) * _SEED)
    for r in range(rounds):
        if len(name) < 2:
            break
        right = (mix(name ^ np.uint64(r + 1)) & np.uint64(1)).astype(bool)
        pair = ~right[:-1] & right[1:] & (end[1:] - start[:-1] <= longest)
        head, tail = np.append(pair, False), np.insert(pair, 0, False)
        ncl, ncr = cl.copy(), cr.copy()
        # what stays single is decided by one neighbour, a pair by itself
        nl, nr = np.append(-_FAR, cl[:-1]), np.append(cr[1:], _FAR)
        ncl = np.where(right & ~tail, np.minimum(cl, nl), cl)
        ncr = np.where(~right & ~head, np.maximum(cr, nr), cr)
        at = np.flatnonzero(head)
        ncl[at] = np.minimum(cl[at], cl[at + 1])
        ncr[at] = np.maximum(cr[at], cr[at + 1])
        named = name.copy()
        named[at] = mix(mix(name[at] + _SEED) + name[at + 1])
        end = end.copy()
        end[at] = end[at + 1]
        keep = ~tail
        name, start, end, cl, cr = named[keep], start[keep], end[keep], ncl[keep], ncr[keep]
    return name, end - start, cl, cr


class Spans:
    """Hashes of word ranges lo..hi-1 from one running sum; equal ranges have equal hashes wherever they stand."""

    BASE = 0x9E3779B97F4A7C15
    POWER, INVERSE = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        if len(Spans.POWER) < n:
            for name, x in (("POWER", self.BASE), ("INVERSE", pow(self.BASE, -1, 1 << 64))):
                p = np.full(max(n, 1 << 18), x, np.uint64)
                p[0] = 1
                setattr(Spans, name, np.multiply.accumulate(p))
        self.sum = np.zeros(n, np.uint64)
        np.cumsum(mix(words) * Spans.POWER[: n - 1], out=self.sum[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix(mix((self.sum[hi] - self.sum[lo]) * Spans.INVERSE[lo]) + (hi - lo).astype(np.uint64) * _SEED)


def range_max(m: int, first: np.ndarray, last: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each of m places the largest value of the ranges first..last over it, -1 without one.

    A range is two overlapping spans whose width is a power of two; spans are
    handed down to their halves, widest first.
    """
    level = np.frexp((last - first + 1).astype(float))[1] - 1
    best = np.full(m, -1, np.int64)
    for b in range(int(level.max(initial=0)), -1, -1):
        half = 1 << b
        if m > half:
            wide = best.copy()
            np.maximum(best[half:], wide[: m - half], out=best[half:])
        at = level == b
        np.maximum.at(best, first[at], value[at])
        np.maximum.at(best, last[at] - half + 1, value[at])
    return best


def windows(words: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(name, hash) of all windows, by start; equal windows have equal names and equal hashes."""
    m = len(words) - window + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    spans, p = Spans(words), np.arange(m)
    own = spans.of(p, p + window)
    name, length, cl, cr = symbols(words)
    # a symbol is seen by the windows that start from cr - window to cl
    first, last = np.maximum(cr - window, 0), np.minimum(cl, m - 1)
    seen = (cl >= 0) & (cr <= len(words)) & (first <= last)
    name, length, cl, cr, first, last = (x[seen] for x in (name, length, cl, cr, first, last))
    rank = np.lexsort((mix(name), length))
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    best = range_max(m, first, last, place)
    has = best >= 0
    by = rank[best[has]]
    named = own.copy()
    named[has] = spans.of(cl[by], cr[by])
    return named, own


#: Words worked on at once; texts are put in a row with a separator of their own between them.
CHUNK = 200_000


def _chunks(rows: Iterator[tuple], ids: WordIds, window: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(rows, start of each text, words) for runs of texts that have a window; rows are (text, ...)."""
    held, words, size, serial = [], [], 0, 0
    for row in rows:
        seq = row[0].split()
        if len(seq) < window:
            continue
        serial += 1
        held.append(row)
        words.append(np.append(ids.of(seq), mix(np.array([serial], np.uint64) * _SEED)))
        size += len(seq) + 1
        if size >= CHUNK:
            yield held, np.cumsum([0, *map(len, words)]), np.concatenate(words)
            held, words, size = [], [], 0
    if held:
        yield held, np.cumsum([0, *map(len, words)]), np.concatenate(words)


def _named(held: list, at: np.ndarray, words: np.ndarray, window: int) -> Iterator[tuple]:
    """(row, first window, name and hash of each window) of every text of a chunk."""
    with np.errstate(over="ignore"):
        name, own = windows(words, window)
    for k, row in enumerate(held):
        lo, hi = at[k], at[k + 1] - window
        yield row, name[lo:hi], own[lo:hi]


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _names_of(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(name, k8) for each run of windows of one name, and once more if the text repeats a window under that name.

    Equal texts of a task are named once.
    """
    ids, seen = WordIds(), set()

    def rows():
        for b in batches:
            for text, k8 in zip(texts_of(b.column("text")), b.column("k8").to_pylist()):
                if k8 not in seen:
                    seen.add(k8)
                    yield text, k8

    for chunk in _chunks(rows(), ids, window):
        names, keys = [], []
        for (_, k8), name, own in _named(*chunk, window):
            got, in_order = name[_starts(name)], np.sort(own)
            again = in_order[1:][in_order[1:] == in_order[:-1]]
            if len(again):
                got = np.append(got, np.unique(name[np.isin(own, again)]))
            names.append(got)
            keys.append(np.full(len(got), k8, np.int64))
        yield pa.record_batch([pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(keys))], names=["name", "k8"])


def _candidates(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(name, hot, key, lo, hashes) for each run of windows under a name that occurs elsewhere too."""
    ids = WordIds()

    def rows():
        for b in batches:
            yield from zip(texts_of(b.column("text")), b.column("key").to_pylist(), b.column("names"), b.column("hot"))

    schema = pa.schema([("name", pa.int64()), ("hot", pa.bool_()), ("key", pa.binary()), ("lo", pa.int32()), ("hashes", pa.list_(pa.int64()))])
    for chunk in _chunks(rows(), ids, window):
        parts, hots, keys, los, ends, hashes, total = [], [], [], [], [0], [], 0
        for (_, key, shared, hot), name, own in _named(*chunk, window):
            shared, hot = shared.values.to_numpy(), hot.values.to_numpy(zero_copy_only=False)
            order = np.argsort(shared)
            shared, hot = shared[order], hot[order]
            lo = _starts(name)
            hi = np.append(lo[1:], len(name))
            run = name[lo].view(np.int64)
            at = np.minimum(np.searchsorted(shared, run), len(shared) - 1)
            hit = shared[at] == run
            for a, b in zip(lo[hit], hi[hit]):
                hashes.append(own[a:b].view(np.int64))
                total += b - a
                ends.append(total)
            parts.append(run[hit])
            hots.append(hot[at[hit]])
            keys.extend([key] * int(hit.sum()))
            los.append(lo[hit])
        if total:
            arrays = [pa.array(np.concatenate(parts)), pa.array(np.concatenate(hots)), pa.array(keys, pa.binary()), pa.array(np.concatenate(los).astype(np.int32))]
            arrays.append(pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.concatenate(hashes))))
            yield pa.record_batch(arrays, schema=schema)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, lo, hi) of windows lo..hi-1 whose name and hash occur at least twice; rows sorted by name."""
    for t in whole_groups(batches, "name"):
        t = t.combine_chunks()
        lists = t.column("hashes").chunk(0) if t.num_rows else None
        if lists is None:
            continue
        n = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(n)), n)
        h = lists.flatten().to_numpy()
        name = t.column("name").to_numpy()[row]
        order = np.lexsort((h, name))
        same = (h[order][1:] == h[order][:-1]) & (name[order][1:] == name[order][:-1])
        twice = np.zeros(len(h), bool)
        twice[order] = np.append(same, False) | np.insert(same, 0, False)
        at = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n) + t.column("lo").to_numpy()[row]
        at, row = at[twice], row[twice]
        if len(at):
            cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)]))
            last = np.append(cut[1:], len(at)) - 1
            yield pa.record_batch(
                [t.column("key").take(pa.array(row[cut])).combine_chunks(), pa.array(at[cut].astype(np.int32)), pa.array((at[last] + 1).astype(np.int32))],
                names=["key", "lo", "hi"],
            )


def repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(key, copies, ranges) for texts that stand in several rows or hold windows that start elsewhere too.

    ``key`` names a text; ``ranges`` are the starts lo..hi-1 of its repeated windows.
    """
    rows = docs.select(text_key(F.col("text")).alias("key"), F.col("text")).withColumn("k8", F.xxhash64("key"))
    names = stage(rows.select("k8", F.col("text").cast("binary")).mapInArrow(tidied(_names_of, window), "name long, k8 long"), "names")
    counts = names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name", (F.col("n") > hot).alias("hot"))
    shared = names.join(counts, "name").distinct().groupBy("k8").agg(F.collect_list("name").alias("names"), F.collect_list("hot").alias("hot"))
    texts = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = texts.join(shared.join(rows.select("k8", "key").distinct(), "k8").drop("k8"), "key")
    found = texts.select("key", F.col("text").cast("binary"), "names", "hot").mapInArrow(
        tidied(_candidates, window), "name long, hot boolean, key binary, lo int, hashes array<long>"
    )
    found = stage(found, "windows")
    cold = found.where("NOT hot").select("name", "key", "lo", "hashes").repartition("name").sortWithinPartitions("name")
    marks = cold.mapInArrow(tidied(_repeated), "key binary, lo int, hi int")
    each = found.where("hot").select("name", "key", "lo", F.posexplode("hashes").alias("k", "hash"))
    twice = each.groupBy("name", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    at = F.col("lo") + F.col("k")
    marks = marks.union(each.join(twice, ["name", "hash"]).select("key", at.alias("lo"), (at + 1).alias("hi")))
    ranges = marks.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    copies = rows.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
    return copies.join(ranges, "key", "full")


def _keep(batches: Iterator[pa.RecordBatch], window: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches, lambda b: b.column("doc").field("text")):
        n_words, n_removed, kept = [], [], []
        copies, ranges = b.column("copies").to_pylist(), b.column("ranges")
        for i, text in enumerate(texts_of(b.column("doc").field("text"))):
            words = text.split()
            cover = np.zeros(len(words) + 1, np.int64)
            if copies[i] and len(words) >= window:
                cover[0] = 1
            elif ranges[i].is_valid:
                lo, hi = (ranges[i].values.field(k).to_numpy() for k in ("lo", "hi"))
                np.add.at(cover, lo, 1)
                np.add.at(cover, hi - 1 + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(words, gone) if not g) if n_removed[-1] else b" ".join(words))
        yield pa.record_batch([b.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], schema=schema(b))


def dedup(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(doc, n_words, n_removed, kept): ``doc`` holds all columns of the row, ``kept`` the words left, joined by one space."""
    small_batches(docs.sparkSession)
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(own, text_key(F.col("text")).alias("key")).join(repeats(docs, window, hot), "key", "left").select("doc", "copies", "ranges")
    kind = rows.schema["doc"].dataType.simpleString()
    schema = lambda b: pa.schema([("doc", b.column("doc").type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
    out = rows.mapInArrow(tidied(_keep, window, schema), f"doc {kind}, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup(docs).select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def stage_substrings(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages leave the texts; a text that loses nothing stays as it is."""
    out = dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc.text"))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("doc.n_chars"))}
    return out.select(*(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT p.r, p.i, md5(array_to_string(w[p.i : p.i + 34], ' ')) AS h FROM p JOIN d USING (r)),
t AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
m AS (SELECT DISTINCT r, i + k AS i FROM h JOIN t USING (h), (SELECT unnest(range(0, 35)) AS k)),
g AS (SELECT r, list(i) AS gone FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""
