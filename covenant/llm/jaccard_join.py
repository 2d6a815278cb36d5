"""Groups of documents whose sets of word n-grams have a Jaccard similarity of at least t percent.

Sets that may link are brought together by signatures: hash ranges split a set
into more parts than two linked sets of its size may differ in elements, so linked
sets agree on whole parts, and on one of the heaviest few of each.  By ``parts``
the heaviest are the largest; that suits high thresholds, whose parts are large.
By ``rare`` elements they are those of the most and rarest n-grams, by counts of
hash slots over all documents; that suits lower thresholds with longer n-grams, and
takes only sets that may link at all: those of which the threshold's share of
elements stands in other sets too, which is counted over all documents first.
Chains of signatures in common make candidate blocks.  Blocks too large for a task
are taken again by themselves: sets that may not link within their block leave it,
and the others are signed with parts of another split, so that a block that hangs
together by chance comes apart.  In a block the sets, ordered by how common their
elements are there, share a prefix tree.  A probe walks the tree once, keeping the
overlap of every path, and leaves a subtree when even all remaining elements could
not reach the threshold.  Blocks that stay too large are dealt as pairs of
sub-blocks.  Links found are joined to components; copies of a set are linked to
its smallest doc_id and take part by it alone.

Cases: a text without words, or null, has an empty set and links with nothing;
fewer than n words make one n-gram of all words; rows that share a doc_id are one
document for the components; a row without a doc_id is linked with nothing and
its component is null; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.session import small_batches

from .common import WordIds, broadcast_checked, grouped, join_keys, mix, perhaps_among, sliced, stage, text_key, texts_of, tidied
from .components import connected

SHINGLE, PERCENT = 3, 90
#: Near copies in the pipeline: five words, 0.8.
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
#: Hash slots in which n-grams are counted for their order (the upper bits of their names), and pieces they are added in.
SLOTS, SLOT_SHIFT, SLOT_PIECES = 1 << 22, np.uint64(42), 64
#: Sets and elements of a sub-block; a task holds two of them.
BLOCK_SETS, BLOCK_ITEMS = 512, 1_000_000
#: Signatures compared in one bucket; a bucket's task holds them as arrays.
BUCKET_SIGS = 2_000_000
#: Times that the sets of blocks too large for a task are signed anew.
ROUNDS = 4
#: Documents of a chunk whose repeated n-grams are counted together (places fit 16 bits).
CHUNK_DOCS = 1024

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit names of the word n-grams of a sequence of word ids."""
    if not len(words):
        return words
    k = min(n, len(words))
    m = len(words) - k + 1
    x = np.full(m, k, np.uint64) * _B
    for i in range(k):
        x = mix(x + _A) + words[i : i + m]
    return np.unique(mix(x))


def words_of(text: bytes) -> list[bytes]:
    """Words by ASCII white space, A-Z lower-cased; other characters stay as they are."""
    return text.lower().split()


def size_bands(percent: int = PERCENT, most: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """(largest size, number of parts) of each band: a set links only within its band and the next.

    With |A and B| * 100 >= percent * |A or B| the sets differ in at most
    (100 - percent) * (|A| + |B|) / (100 + percent) elements; one part more
    leaves a part in which they agree.
    """
    top = [1]
    while top[-1] < most:
        top.append(max(top[-1] + 1, 100 * top[-1] // percent))
    return np.array(top), np.array([(100 - percent) * 2 * t // (100 + percent) + 1 for t in top])


def signatures(items: np.ndarray, band: int, parts: int, rarity: np.ndarray | None = None) -> np.ndarray:
    """Names of the ``parts`` heaviest parts of a set: its elements (sorted hashes) split by ranges of their upper 32 bits.

    Half as many parts more are made.  Sets that differ in fewer than ``parts``
    elements agree on all but fewer than ``parts`` of them, so that the heaviest
    one on which they agree is signed by both: parts go by weight and place, of
    which each is that of the part's own elements.  The weight is the number of
    elements, or the sum of what ``rarity`` gives each.
    """
    made = parts * 3 // 2
    edges = (np.arange(1, made, dtype=np.uint64) << np.uint64(32)) // np.uint64(made) << np.uint64(32)
    cuts = np.concatenate([[0], np.searchsorted(items, edges), [len(items)]])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(items + _B), dtype=np.uint64)])
    weight = cuts if rarity is None else np.concatenate([[0], np.cumsum(rarity[(items >> SLOT_SHIFT).astype(np.int64)], dtype=np.int64)])[cuts]
    heavy = np.sort(np.argsort(weight[:-1] - weight[1:], kind="stable")[:parts])
    part = heavy.astype(np.uint64) + np.uint64(band) * np.uint64(1 << 40)
    return mix(total[cuts[heavy + 1]] - total[cuts[heavy]] + mix(part + _A))


def slot_counts(text: DataFrame, shingle: int) -> np.ndarray:
    """How many sets hold an n-gram of each of SLOTS hash slots, over all documents.

    Tasks add up an array of their own; pieces of the arrays are added by slot
    range.  The result has a fixed size and comes to the driver.
    """

    size = SLOTS // SLOT_PIECES
    names, schema = ["k", "n"], "k int, n binary"

    def row(k: int, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([k], pa.int32()), pa.array([pa.compress(n.tobytes(), "zstd", asbytes=True)], pa.binary())], names=names)

    def read(n: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(n, size * 4, "zstd", asbytes=True), np.uint32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, total = WordIds(), np.zeros(SLOTS, np.uint32)
        for b in batches:
            for t in texts_of(b.column("text")):
                np.add.at(total, (shingles(ids.of(words_of(t)), shingle) >> SLOT_SHIFT).astype(np.int64), 1)
        for k, n in enumerate(total.reshape(SLOT_PIECES, size)):
            if n.any():
                yield row(k, n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, n in zip(b.column("k").to_pylist(), b.column("n").to_pylist()):
                x = held.setdefault(k, np.zeros(size, np.uint32))
                x += np.minimum(read(n), ~x)  # stays at the largest count that fits
        for k, n in held.items():
            yield row(k, n)

    total = np.zeros((SLOT_PIECES, size), np.uint32)
    for r in text.select("text").mapInArrow(tidied(count), schema).repartition("k").mapInArrow(tidied(add), schema).collect():  # SLOT_PIECES rows
        total[r.k] = read(r.n)
    return total.ravel()


def rarity(counts: np.ndarray) -> np.ndarray:
    """Weight of the n-grams of each slot: 64 less four times the bits of its count, 1 at least."""
    return np.maximum(64 - 4 * np.ceil(np.log2(counts + 1.0)), 1).astype(np.uint8)


def _salted(names: np.ndarray, salt: int) -> np.ndarray:
    """Other names for n-grams, sorted; equal ones for an equal salt."""
    return np.sort(mix(names + np.full(1, salt, np.uint64) * _B)) if salt else names


def _blocks(b: pa.RecordBatch) -> np.ndarray | list[None]:
    """A name of each row's block, or None for each."""
    return mix(b.column("block").to_numpy().view(np.uint64)) if "block" in b.schema.names else [None] * b.num_rows


def _named(batches: Iterator[pa.RecordBatch], shingle: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The n-grams of a chunk of documents, dealt to buckets as (32 bits of the name, place of the document in the chunk).

    One more row per chunk holds the ids and set sizes of its documents.  Where
    rows have a block, an n-gram has another name in each block.
    """
    ids, names = WordIds(), ["bucket", "chunk", "names", "at", "docs", "sizes"]
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 4
    for whole in batches:
        for x in range(0, whole.num_rows, CHUNK_DOCS):
            b = whole.slice(x, CHUNK_DOCS)
            docs, sets = [], []
            for doc, block, text in zip(b.column("doc_id").to_pylist(), _blocks(b), texts_of(b.column("text"))):
                items = shingles(ids.of(words_of(text)), shingle)
                if doc is not None and len(items):
                    docs.append(doc)
                    sets.append(items if block is None else mix(items + block))
            if not docs:
                continue
            own, sizes, name = np.array(docs, np.int64), np.array(list(map(len, sets)), np.int64), np.concatenate(sets)
            chunk = int.from_bytes(blake2b(own.tobytes() + name[: 1 << 16].tobytes(), digest_size=8).digest(), "little", signed=True)
            at, bucket = np.repeat(np.arange(len(docs), dtype=np.uint16), sizes), (name % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((name, bucket))
            high, at, bucket = (name >> np.uint64(32)).astype(np.uint32)[order], at[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            rows = [(int(bucket[i]), chunk, high[i:j].tobytes(), at[i:j].tobytes(), b"", b"") for i, j in zip(cuts[:-1], cuts[1:])]
            rows.append((chunk % buckets, chunk, b"", b"", own.tobytes(), sizes.tobytes()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk, the places whose n-gram is in the bucket more than once; rows sorted by bucket."""
    for t in grouped(batches, ["bucket"]):
        raw = t.column("names").to_pylist()
        name = np.sort(np.frombuffer(b"".join(raw), np.uint32))
        twice = np.unique(name[1:][name[1:] == name[:-1]])
        del name
        kept = []
        for x, at in zip(raw, t.column("at").to_pylist()):
            own = np.frombuffer(x, np.uint32)
            hit = twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own if len(twice) else np.zeros(len(own), bool)
            kept.append(np.frombuffer(at, np.uint16)[hit].tobytes())
        columns = [t.column(c).combine_chunks() for c in ("chunk", "docs", "sizes")]
        yield pa.record_batch([columns[0], pa.array(kept, pa.binary()), *columns[1:]], names=["chunk", "at", "docs", "sizes"])


def _able(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Documents of each chunk of whose set the threshold's share is repeated; rows sorted by chunk."""
    for t in grouped(batches, ["chunk"]):
        joined = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind)
        docs, sizes = joined("docs", np.int64), joined("sizes", np.int64)
        n = np.bincount(joined("at", np.uint16), minlength=len(docs))
        yield pa.record_batch([pa.array(docs[100 * n >= percent * sizes])], names=["doc_id"])


def without_copies(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` without the documents whose sets are all sets of smaller doc_ids."""
    first = known.groupBy("fp").agg(F.min("doc_id").alias("first"))
    own = known.join(first, "fp").groupBy("doc_id").agg(F.min(F.col("doc_id") > F.col("first")).alias("copy"))
    copies = stage(own.where("copy").select("doc_id"), "copies")
    return join_keys(rows, copies, copies.count(), "doc_id", "left_anti")


def may_link(text: DataFrame, known: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id of the documents that may link with a different set.

    A set that links shares at least ``percent`` of its elements with one other
    set, so as many of its elements stand in two sets or more.  Equal sets count
    once (as that of their smallest doc_id).  Two elements are taken as one by 32
    bits of their name and their bucket, which only lets more documents through.
    """
    return repeated_share(without_copies(text, known).select("doc_id", "text"), known.agg(F.sum("n")).first()[0], shingle, percent)


def repeated_share(text: DataFrame, items: int | None, shingle: int, percent: int) -> DataFrame:
    """doc_id of the rows that have ``percent`` of their n-grams in other rows too (of their block, where they have one)."""
    buckets = max(1, int((items or 0) / BUCKET_SIGS))
    named = text.mapInArrow(tidied(_named, shingle, buckets), "bucket int, chunk long, names binary, at binary, docs binary, sizes binary")
    twice = named.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_repeated), "chunk long, at binary, docs binary, sizes binary")
    return twice.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(tidied(_able, percent), "doc_id long").distinct()


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, fp) per row: the size of its set and a 128-bit name of it, null if empty."""
    ids = WordIds()
    for b in sliced(batches):
        sets = [shingles(ids.of(words_of(t)), shingle) for t in texts_of(b.column("text"))]
        fps = [blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
        yield pa.record_batch([b.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(fps, pa.binary())], names=["doc_id", "n", "fp"])


def _signed(batches: Iterator[pa.RecordBatch], shingle: int, percent: int, rare: np.ndarray | None, salt: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(signatures, their doc_id) of the documents of a batch, in their block if they have one; equal sets of a task carry theirs once."""
    ids, seen = WordIds(), set()
    tops, parts = size_bands(percent)
    for b in batches:
        sigs, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for doc, block, text in zip(b.column("doc_id").to_pylist(), _blocks(b), texts_of(b.column("text"))):
            items = shingles(ids.of(words_of(text)), shingle)
            fp = blake2b(items.tobytes(), digest_size=16).digest()
            if doc is None or not len(items) or (fp, block) in seen:
                continue
            seen.add((fp, block))
            band, items = int(np.searchsorted(tops, len(items))), _salted(items, salt)
            own = [signatures(items, k, int(parts[k]), rare) for k in (band, band + 1) if parts[k] > 1]
            sigs.extend(own if block is None else [mix(x + block) for x in own])
            docs.append(np.full(sum(map(len, own)), doc))
        yield np.concatenate(sigs).view(np.int64), np.concatenate(docs)


def _parts(signed: Iterator[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed signatures by bucket, one (its smallest doc_id) of those that agree in a batch; the others as links (a, b)."""
    for sig, doc in signed:
        if not len(sig):
            continue
        a, b, first = _agreeing(sig, doc)
        sig, doc = sig[first], doc[first]
        bucket = (sig.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
        rows = [(int(bucket[order[x]]), sig[order[x:y]].tobytes(), doc[order[x:y]].tobytes(), b"", b"") for x, y in zip(cuts[:-1], cuts[1:])]
        rows[0] = (*rows[0][:3], a.tobytes(), b.tobytes())
        types = [pa.int32()] + [pa.binary()] * 4
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["bucket", "sigs", "docs", "a", "b"])


def _agreeing(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, smallest doc with the same signature), each pair once, and the index of that smallest one per signature."""
    order = np.lexsort((doc, sig))
    new = np.concatenate([[True], sig[order][1:] != sig[order][:-1]])
    low = doc[order][new][np.cumsum(new) - 1]
    pair = np.stack([doc[order], low])[:, doc[order] != low]
    pair = np.unique(pair, axis=1) if pair.size else pair
    return pair[0], pair[1], order[new]


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (doc_id, low) between documents with a signature in common; rows sorted by bucket."""
    for t in grouped(batches, ["bucket"]):
        arrays = lambda c: np.frombuffer(b"".join(t.column(c).to_pylist()), np.int64)
        a, b, _ = _agreeing(arrays("sigs"), arrays("docs"))
        yield pa.record_batch([pa.array(np.append(arrays("a"), a)), pa.array(np.append(arrays("b"), b))], names=["doc_id", "low"])


def _items(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    ids = WordIds()
    for b in sliced(batches):
        items = [shingles(ids.of(words_of(t)), shingle).tobytes() for t in texts_of(b.column("text"))]
        yield pa.record_batch([*(b.column(c) for c in ("block", "doc_id", "m")), pa.array(items, pa.binary())], names=["block", "doc_id", "m", "items"])


class PrefixTree:
    """Sorted sets as a tree: a set adds the nodes below the prefix it shares with the set before it."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.shared = [0] * len(sets)
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared[i] = int(differ[0]) if len(differ) else m
        new = [s[k:] for s, k in zip(sets, self.shared)]
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in new])])
        self.nodes = np.concatenate(new) if new else np.zeros(0, np.int64)
        self.sizes = np.array([len(s) for s in sets])

    def links(self, probes: list[np.ndarray], width: int) -> list[tuple[int, int]]:
        """(probe, set) index pairs that link; the probes walk the tree side by side, elements are below ``width``."""
        t, m = self.percent, len(probes)
        low, high = int(self.sizes.min()), int(self.sizes.max())
        size = np.array([len(p) for p in probes])
        member = np.zeros((m, width), np.int32)
        for row, p in zip(member, probes):
            row[p] = 1
        run = np.zeros((m, len(self.nodes) + 1), np.int32)
        np.cumsum(member[:, self.nodes], axis=1, out=run[:, 1:])
        after = size[:, None] - np.cumsum(member, axis=1, dtype=np.int32)[:, self.nodes]  # probe elements behind each node
        overlap = np.zeros((m, high + 1), np.int32)
        need = -(-t * (size + low) // (100 + t))  # the least overlap any set here needs
        out, dead = [], -1
        for i, k in enumerate(self.shared):
            if 0 <= dead <= k:
                continue
            dead = -1
            a, b, n = self.at[i], self.at[i + 1], int(self.sizes[i])
            path = overlap[:, k : k + 1] + run[:, a + 1 : b + 1] - run[:, a : a + 1]
            overlap[:, k + 1 : n + 1] = path
            both = overlap[:, n]
            hits = np.flatnonzero(100 * both >= t * (size + n - both))
            out.extend((int(j), i) for j in hits)
            if b - a > 1 and not len(hits):
                # what a set of this subtree can still gain: probe elements behind the node, and its own
                left = np.minimum(after[:, a:b], high - np.arange(k + 1, n + 1))
                lost = (path + left < need[:, None]).all(0)
                if lost.any():
                    dead = k + 1 + int(np.argmax(lost))
        return out


#: Cells of the arrays with which probes walk together.
WALK_CELLS = 8_000_000


def _linkable(code: np.ndarray, cuts: np.ndarray, percent: int, first: int) -> np.ndarray:
    """Which sets (runs of ``code`` between ``cuts``) have ``percent`` of their elements in others: of the other side of ``first``, unless it is 0."""
    size, width = np.diff(cuts), int(code.max()) + 1
    stay, side = np.ones(len(size), bool), np.arange(len(size)) >= first
    while True:
        ones = [np.bincount(code[np.repeat(stay & (side == k), size)], minlength=width) for k in (False, True)]
        # those of the other side; without sides all but the set itself
        held = np.where(np.repeat(side, size), ones[0][code] > 0, ones[1][code] > 0) if first else ones[1][code] > 1
        again = stay & (100 * np.add.reduceat(held, cuts[:-1], dtype=np.int64) >= percent * size)
        if (again == stay).all():
            return stay
        stay = again


def tree_links(items: list[np.ndarray], percent: int, first: int = 0) -> list[tuple[int, int]]:
    """Links that keep the linked sets of one block connected.

    Sets whose elements are not in enough others to link stay out.  Every other set
    probes all sets that have not probed before it, many together, so each link
    is seen by the first of its two sets; of the links seen those stay that join
    two parts.  Sets of the smallest parts probe first, and when all sets left are
    of one part there is nothing more to join.  The tree is built anew whenever
    half of its sets have probed.  With ``first``, so many sets probe the others and
    no set is compared with one of its own side.
    """
    values, code, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    order = np.empty(len(values), np.int64)
    order[np.lexsort((values, -count))] = np.arange(len(values))  # one order for the block: common elements first
    cuts = np.cumsum([0, *map(len, items)])
    sets = [np.sort(order[code[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    todo = sorted(np.flatnonzero(_linkable(code, cuts, percent, first)).tolist(), key=lambda i: sets[i].astype(">u4").tobytes())
    out, part, tree = [], list(range(len(sets))), None
    left, held = dict.fromkeys(i for i in todo if not first or i < first), [i for i in todo if i >= first] if first else []

    def root(i: int) -> int:
        while part[i] != i:
            part[i] = i = part[part[i]]
        return i

    while left and len(size := Counter(map(root, [*left, *held] if first else left))) > 1:
        if not first and (tree is None or 2 * len(left) <= len(held)):
            held, tree = list(left), None
        tree = tree or PrefixTree([sets[i] for i in held], percent)
        m = max(1, min(64, WALK_CELLS // max(len(values), len(tree.nodes))))
        probes = sorted(left, key=lambda i: size[root(i)])[:m]
        for p, j in tree.links([sets[i] for i in probes], len(values)):
            a, b = root(probes[p]), root(held[j])
            if a != b:
                part[a] = b
                out.append((probes[p], held[j]))
        for i in probes:
            del left[i]
    return out


def _cells(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each cell: within a sub-block, or between two; rows sorted by block, i and j."""
    for t in grouped(batches, ["block", "i", "j"]):
        ids, raw = t.column("doc_id").to_pylist(), t.column("items").to_pylist()
        other = t.column("own").to_numpy() != t.column("i").to_numpy()
        # equal sets of a sub-block are one
        low: list[dict[bytes, int]] = [{}, {}]
        for d, x, k in zip(ids, raw, other.tolist()):
            low[k][x] = min(d, low[k].get(x, d))
        own, across = [*low[0].values(), *low[1].values()], t.column("i")[0].as_py() != t.column("j")[0].as_py()
        some = all(low) if across else len(own) > 1
        found = tree_links([np.frombuffer(x, np.uint64) for k in low for x in k], percent, len(low[0]) if across else 0) if some else []
        yield pa.record_batch([pa.array([own[a] for a, _ in found], pa.int64()), pa.array([own[b] for _, b in found], pa.int64())], names=["a", "b"])


def blocks_of(text: DataFrame, items: int | None, shingle: int, percent: int, rare: Broadcast, salt: int = 0) -> DataFrame:
    """(doc_id, block) of the documents whose signatures chain them to others (of their block, where rows have one)."""
    share = 4 * (100 - percent) / (100 + percent)  # signatures per element, about
    buckets = max(1, int((items or 0) * share / BUCKET_SIGS))
    parts = text.mapInArrow(tidied(lambda b: _parts(_signed(b, shingle, percent, rare.value, salt), buckets)), "bucket int, sigs binary, docs binary, a binary, b binary")
    near = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_agree), "doc_id long, low long")
    return stage(connected(near, "doc_id", "low").select(F.col("node").alias("doc_id"), F.col("label").alias("block")), "blocks")


def join_groups(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, near: str = "parts", block_sets: int = BLOCK_SETS, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of (doc_id, text); ``near`` is "parts" or "rare"."""
    small_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    sets = stage(text.mapInArrow(tidied(_sets, shingle), "doc_id long, n long, fp binary"), "sets")
    known = sets.where("doc_id IS NOT NULL AND n > 0")
    if near == "rare":
        able = stage(may_link(text, known, shingle, percent), "able")
        text = join_keys(text, able, able.count(), "doc_id", "left_semi").select("doc_id", "text")
    else:
        text = without_copies(text, known).select("doc_id", "text")
    rare = docs.sparkSession.sparkContext.broadcast({"parts": lambda: None, "rare": lambda: rarity(slot_counts(text, shingle))}[near]())  # SLOTS numbers

    def measured(block: DataFrame) -> DataFrame:
        per = known.select("doc_id", "n").join(block, "doc_id").groupBy("block").agg(F.count("*").alias("sets"), F.sum("n").alias("items"))
        return per.select("block", "items", F.greatest(F.ceil(F.col("sets") / block_sets), F.ceil(F.col("items") / block_items)).cast("int").alias("m"))

    block, before = blocks_of(text, known.agg(F.sum("n")).first()[0], shingle, percent, rare), None
    # the texts of all blocks are read once, by the same plan at every size, whatever share of the documents has neighbours
    own = text.where(perhaps_among(block.select("doc_id"), "doc_id", block.count()))
    text = stage(own.join(block.select("doc_id").hint("merge"), "doc_id", "left_semi").select("doc_id", "text"), "texts")
    for salt in range(1, ROUNDS + 1):
        per = stage(measured(block).where("m > 1"), "per")
        blocks, items, cells = per.agg(F.count("*"), F.sum("items"), F.sum(F.col("items") * F.col("m"))).first()
        if not blocks or before is not None and cells > 0.9 * before:
            break
        before = cells
        large = stage(join_keys(block, per.select("block"), blocks, "block", "left_semi").select("doc_id", "block"), "large")
        own = text.join(broadcast_checked(large, large.count()), "doc_id").select("doc_id", "text", "block")
        able = stage(repeated_share(own, items, shingle, percent), "able")
        own = own.join(broadcast_checked(able, able.count()), "doc_id", "left_semi").select("doc_id", "text", "block")
        finer = blocks_of(own, items, shingle, percent, rare, salt)
        block = stage(join_keys(block, per.select("block"), blocks, "block", "left_anti").select("doc_id", "block").union(finer), "blocks")

    items = text.join(block.join(measured(block), "block").hint("merge"), "doc_id").select("block", "doc_id", "m", "text")
    cells = items.mapInArrow(tidied(_items, shingle), "block long, doc_id long, m int, items binary")
    cells = cells.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("m")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    cells = cells.select("block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "items")
    cells = cells.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
    links = cells.mapInArrow(tidied(_cells, percent), "a long, b long")

    same = known.groupBy("fp").agg(F.min("doc_id").alias("b"))
    copies = known.join(same, "fp").where("doc_id > b").select(F.col("doc_id").alias("a"), "b")
    label = connected(links.union(copies), "a", "b")
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def op5(spark, sf_dir: str) -> DataFrame:
    return join_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def stage_join(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of linked texts the row with the smallest doc_id stays.

    Rows that share a doc_id and a text are one (the one with the smallest hash
    of all columns stays); rows that share a doc_id but not the text are judged
    each for itself.  Rows without a doc_id stay.
    """
    row = docs.select("*", text_key(F.col("text")).alias("_key"))
    shared = row.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("_key").alias("_first")).where("n > 1").drop("n")
    shared = stage(shared, "shared")
    row = join_keys(row, shared, shared.count(), "doc_id", "left")
    # of several texts under one id, one keeps the id and the others get names beyond all ids
    other = F.xxhash64("doc_id", "_key").bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    row = row.withColumn("_id", F.when(F.col("_first").isNull() | (F.col("_first") == F.col("_key")), F.col("doc_id").cast("long")).otherwise(other))
    groups = join_groups(row.select(F.col("_id").alias("doc_id"), "text"), STAGE_SHINGLE, STAGE_PERCENT, "rare")
    gone = stage(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct(), "gone")
    left = join_keys(row, gone, gone.count(), "_id", "left_anti")
    own = [F.col(f"`{c}`") for c in docs.columns]
    single = left.where("_first IS NULL").select(*own)
    same = left.where("_first IS NOT NULL").groupBy("_id").agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("row")).select("row.*")
    return single.unionByName(same)


SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT r, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) END) AS s FROM d),
n AS (SELECT r, len(s) AS n FROM s),
x AS (SELECT r, hash(unnest(s)) AS g FROM s),
rare AS (SELECT x.r, g, row_number() OVER (PARTITION BY x.r ORDER BY c, g) AS k FROM x JOIN (SELECT g, count(*) AS c FROM x GROUP BY g) USING (g)),
pre AS (SELECT rare.r, g FROM rare JOIN n USING (r) WHERE k <= n - ceil(0.9 * n) + 1),
cand AS (
  SELECT DISTINCT a.r AS a, b.r AS b FROM pre a JOIN pre b ON a.g = b.g AND a.r < b.r
  JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r WHERE 100 * least(na.n, nb.n) >= 90 * greatest(na.n, nb.n)),
both_ AS (SELECT a, b, na.n + nb.n AS n, len(list_intersect(sa.s, sb.s)) AS i FROM cand JOIN s sa ON sa.r = a JOIN s sb ON sb.r = b JOIN n na ON na.r = a JOIN n nb ON nb.r = b),
l AS (SELECT a, b FROM both_ WHERE 100 * i >= 90 * (n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT doc_id, n::BIGINT AS n_shingles, component_id FROM d JOIN n USING (r) JOIN c USING (r)
"""
