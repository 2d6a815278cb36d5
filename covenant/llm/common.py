"""Helpers shared by the operators: staged tables, word ids, small-side broadcast, text columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.session import scratch_path

#: A word: a longest run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a table of a few narrow columns may be broadcast.
BROADCAST_ROWS = 100_000

#: Bits that a key takes in a filter of keys, most bits of a filter (32 MB), and bits of a row while it is made.
KEY_BITS, FILTER_BITS, ROW_BITS = 32, 1 << 28, 1 << 15

#: Entries of the per-worker word cache; it is emptied when full.
CACHE_WORDS = 65_536

#: Bytes of text that a task turns into Python strings at once.
SLICE_BYTES = 4 << 20

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there, lost tasks reread it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a narrow table only if its counted ``rows`` are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def perhaps_among(keys: DataFrame, key: str, rows: int) -> Column:
    """A condition on a column ``key`` that holds for all ``rows`` values of ``keys`` and for few others.

    One bit for the hash of each value, in an array of a bounded size that every
    task reads: beyond that size it lets more of the others through.
    """
    spark, bits = keys.sparkSession, min(FILTER_BITS, max(ROW_BITS, 1 << (KEY_BITS * rows).bit_length()))
    place = F.xxhash64(F.col(key).cast("long")).bitwiseAND(F.lit(bits - 1))
    made = keys.select(place.alias("p")).groupBy(F.expr(f"p div {ROW_BITS}").alias("k")).agg(F.bitmap_construct_agg(F.expr(f"p % {ROW_BITS}")).alias("n"))
    held = np.zeros((bits // ROW_BITS, ROW_BITS // 8), np.uint8)
    for r in made.collect():  # bits // ROW_BITS rows
        held[r.k] = np.frombuffer(r.n, np.uint8)
    shared = spark.sparkContext.broadcast(held.ravel())

    @F.pandas_udf("boolean")
    def among(p: pd.Series) -> pd.Series:
        at = p.to_numpy(np.int64)
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return among(place)


def join_keys(df: DataFrame, keys: DataFrame, rows: int, key: str, how: str) -> DataFrame:
    """``df`` joined (left_semi, left_anti or left) to ``keys``, of whose ``rows`` each has another ``key``.

    Keys within the bound are broadcast.  Of more, a filter tells which rows of
    ``df`` may find one; only these are shuffled, however wide the others are.
    """
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(keys), key, how)
    near = perhaps_among(keys.select(key), key, rows)
    found = df.where(near).join(keys, key, how)
    return found if how == "left_semi" else df.where(~near).unionByName(found, allowMissingColumns=True)


def text_key(text: Column) -> Column:
    """128-bit name of a text, so that equal texts are worked on as one and rows need no unique id."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class WordIds(dict):
    """Word (bytes) -> 64-bit id; equal words have equal ids in every task and run."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = i = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return i

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling, so that sums of scrambled values behave as random names."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links a-b, for each of n nodes of one bounded block."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def grouped(batches, keys: list[str]):
    """Arrow tables of one key each, from batches sorted by key; a table holds no more than its key's rows."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.zeros(batch.num_rows - 1, bool)
        for c in keys:
            x = batch.column(c).to_numpy(zero_copy_only=False)
            k |= x[1:] != x[:-1]
        cuts = [0, *(np.flatnonzero(k) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(batch.column(c)[a].as_py() for c in keys)
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches, key: str):
    """Arrow tables of many whole keys each, from batches sorted by key; only the last key of a batch is held over."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(x, x[-1]))
        if cut or held and held[-1].column(key)[-1].as_py() != x[0]:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return freed memory to the machine: a worker process lives on beside the next stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(work: Callable[..., Iterator], *args) -> Callable[[Iterator], Iterator]:
    """``work(batches, *args)`` as a task's function that gives its memory back when it ends."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches, *args)
        finally:
            give_back()

    return run


def bounded(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of a text column's values with at most ``most`` bytes together, or of one value."""
    end = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, before + most, side="right")))
        yield start, stop - start
        start = stop


def sliced(batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array] = lambda b: b.column("text")) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in batches of a bounded amount of text."""
    for b in batches:
        for start, n in bounded(text(b)):
            yield b.slice(start, n)


def values_of(column: pa.Array) -> Iterator:
    """A text column's values, a bounded amount of text as Python objects at once."""
    for start, n in bounded(column):
        yield from column.slice(start, n).to_pylist()


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """A text column's values as UTF-8, null as empty."""
    return ((x if isinstance(x, bytes) else x.encode()) if x is not None else b"" for x in values_of(column))
