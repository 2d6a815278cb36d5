"""Pack documents into as few fixed-length sequences as possible: best-fit planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens.  The histogram of piece
lengths (at most ``capacity`` rows) is all that the plan needs: longest first,
each length goes to the open sequences with the least room that holds it, whole
ranges of sequences at a time.  The plan says, for each length, which ranks go to
which sequences at which offset.  Pieces are numbered within their length and
take the slot of their rank.

A length that many pieces share is numbered in hash buckets whose counts are
summed first, so no task sees all of it.

Cases: null or empty text is the end token alone; a text longer than a sequence
is cut so that only its first piece is shorter; repeated rows are packed each;
ranks among equal pieces go by doc_id, piece and checksum, and pieces that agree
in all are alike; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covenant.session import small_batches

from .common import sliced, stage, tidied
from .tokens import VOCABULARY, encoding

CAPACITY, END = 1024, 2
#: Pieces numbered together.
BUCKET_ROWS = 50_000


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than ``capacity`` if there are several."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids and the end token."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], "<u4").tobytes()
        with encoding(vocabulary) as made:
            for b in sliced(batches):
                row, out = [], []
                for i, text in enumerate(b.column("text").to_pylist()):
                    ids = made.encode(text or "") + last
                    for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * s : 4 * (s + n)]
                        row.append(i)
                        out.append((k, s, n, zlib.crc32(part), part if with_ids else None))
                cols = list(zip(*out)) or [()] * 5
                arrays = [b.column("doc_id").take(pa.array(row, pa.int64()))]
                arrays += [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))][: 5 if with_ids else 4]
                yield pa.record_batch(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidied(tokenise), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) of best-fit decreasing over counts.

    Open sequences are kept as ranges of numbers by their room; what they hold
    no longer matters.  A length moves ranges to less room and splits one at most.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    opened, runs = 0, []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            r = next((r for r in range(length, capacity + 1) if room.get(r)), capacity)
            if not room[r]:
                n = max(1, left // (capacity // length))
                room[r].append((opened, n))
                opened += n
            first, n = room[r].pop()
            each = r // length  # a sequence takes all it can before the next one
            take = min(n, left // each)
            if not take:
                take, each = 1, left
            if take < n:
                room[r].append((first + take, n - take))
            for i in range(each):
                runs.append((length, rank, take, first, capacity - r + i * length))
                rank, left = rank + take, left - take
            rest = room[r - each * length]
            if rest and rest[-1][0] + rest[-1][1] == first:
                rest[-1] = (rest[-1][0], rest[-1][1] + take)
            else:
                rest.append((first, take))
    return runs


def pack(parts: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of ``parts`` (from ``pieces``) with sequence_id and offset."""
    parts = stage(parts, "pieces")
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    runs = np.array(plan(histogram, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]

    buckets = max(1, -(-sum(histogram.values()) // bucket_rows))
    rows = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("k", F.row_number().over(within) - 1).join(counts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("k"))

    # a run's (length, first rank) as one sortable number: ranks stay below 2**50, lengths below 2**13
    step = np.int64(1) << 50
    keys = runs[:, 0] * step + runs[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, length.to_numpy() * step + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": runs[at, 3] + rank.to_numpy() - runs[at, 1], "offset": runs[at, 4]})

    return ranked.withColumn("slot", slot("length", "rank")).select(*parts.columns, "slot.sequence_id", "slot.offset")


def op2(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def stage_pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents with their places in the training sequences."""
    small_batches(spark)
    return pack(pieces(docs))
