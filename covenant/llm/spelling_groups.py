"""Operator 13: spelling variants of words, by k-d trees over letter counts.

A word is a point whose coordinates count its letters.  One inserted or deleted
letter moves it by 1 in one coordinate, one replaced letter by 1 up in one and 1
down in another, so near words lie within L1 distance 2.  For each pair of
lengths (equal, or one apart):

1. a k-d tree per length, built on a bounded sample of its words, deals all its
   words into cells.  A word also visits the cells that it can reach: a branch is
   taken if the steps it needs are left (a search among words of equal length has
   one step up and one down, a search among longer ones one step up), all other
   boxes are pruned.  Of two cells of one length only the lower one's words visit;
2. a cell is one unit of work: its words make a k-d tree with small leaves, its
   own words and the visitors descend with the same pruning, and whatever meets
   in a leaf is compared letter by letter in order;
3. each cell hands on, per word, the number of near words and the most frequent
   of them; these are combined over the cells.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least RATIO times its own.  Counts grow along forms
by that factor, so following them ends; roots come by doubling the steps.

The shapes of the trees come from the sample and change only the balance of the
work, never the result.

Defined results: null and empty texts have no words.  Repeated rows of a
document count again.  Words of any length are whole.  An empty table gives an
empty result.  Clashing columns of the documents play no part: words come from
``text`` alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, whole_groups

#: Letters of a run, fewest code points and occurrences of a word, and how much more frequent a form is.
LETTERS, MIN_LETTERS, MIN_COUNT, RATIO = r"A-Za-zÀ-ÿ", 7, 2, 10

#: Words of a cell aimed at, words of a length that shape its tree, candidates in a leaf.
CELL_WORDS, SAMPLE, LEAF = 16_384, 16_384, 24

#: Coordinates: a letter each for a-z and U+00C0..U+00FF, eight shared by all others.
AXES = 26 + 64 + 8

#: Cells of one length have numbers below this.
CELLS = 1 << 20

#: Letters compared at once.
COMPARED = 4_000_000


def points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, letter counts) of words of one length, a row each."""
    size = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size)
    axis = np.where(codes < 0x80, codes - 97, codes - 0xC0 + 26).astype(np.int64)
    known = ((codes >= 97) & (codes < 123)) | ((codes >= 0xC0) & (codes < 0x100))
    axis = np.where(known, axis, 90 + codes % 8)
    at = axis + AXES * np.arange(len(words))[:, None]
    counts = np.bincount(at.ravel(), minlength=AXES * len(words)).reshape(len(words), AXES)
    return codes, counts.astype(np.min_scalar_type(size))


class Tree:
    """Nodes (axis, cut, left, right), a leaf is (-1, its number, 0, 0); ``members`` are the rows of each leaf."""

    def __init__(self, x: np.ndarray, size: float):
        self.nodes: list[tuple[int, int, int, int]] = [(-1, 0, 0, 0)]
        self.members: list[np.ndarray] = []
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            axis, cut = self._split(x[rows]) if len(rows) > size else (-1, 0)
            if axis < 0:
                self.nodes[at] = (-1, len(self.members), 0, 0)
                self.members.append(rows)
                continue
            n = len(self.nodes)
            self.nodes[at] = (axis, cut, n, n + 1)
            self.nodes += [(-1, 0, 0, 0)] * 2
            low = x[rows, axis] <= cut
            todo += [(n, rows[low]), (n + 1, rows[~low])]

    @staticmethod
    def _split(x: np.ndarray) -> tuple[int, int]:
        """The cut that halves the points best; axis -1 if all are one point."""
        best, found = 0, (-1, 0)
        for cut in np.unique(np.linspace(0, max(0, int(x.max()) - 1), 8).astype(int)):
            low = (x <= cut).sum(axis=0)
            even = np.minimum(low, len(x) - low)
            if even.max() > best:
                best, found = even.max(), (int(even.argmax()), int(cut))
        return found

    def reach(self, x: np.ndarray, rows: np.ndarray, down: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows) that a step up and, if ``down``, a step down may reach; a row may reach a leaf by several ways."""
        free = np.full(len(rows), -1, np.int16)
        todo = [(0, rows, free, free if down else free - 1)]
        while todo:
            at, rows, plus, minus = todo.pop()
            axis, cut, left, right = self.nodes[at]
            if axis < 0:
                yield cut, rows
                continue
            v = x[rows, axis].astype(np.int64) + (plus == axis) - (minus == axis)
            low = v <= cut
            up = low & (v == cut) & (plus == -1) & (minus != axis)
            dn = ~low & (v == cut + 1) & (minus == -1) & (plus != axis)
            for child, stay, cross, p, m in ((left, low, dn, plus, np.full(len(rows), axis, np.int16)), (right, ~low, up, np.full(len(rows), axis, np.int16), minus)):
                a, b = np.flatnonzero(stay), np.flatnonzero(cross)
                if len(a) + len(b):
                    ab = np.concatenate([a, b])
                    todo.append((child, rows[ab], np.concatenate([plus[a], p[b]]), np.concatenate([minus[a], m[b]])))


def _near(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Which rows of q are one edit from the same row of c, which has as many letters, or one more."""
    if q.shape[1] == c.shape[1]:
        return (q != c).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(q == c[:, :-1], axis=1)
    behind = np.logical_and.accumulate((q == c[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    yes = np.ones((len(q), 1), bool)
    return (np.hstack([yes, ahead]) & np.hstack([behind, yes])).any(axis=1)


def meetings(tree: Tree, x: np.ndarray, q: np.ndarray, c: np.ndarray, down: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row of q, row of c) of all near words: q with points x searches the tree of c."""
    out = [np.zeros((2, 0), np.int64)]
    ends_q, ends_c = (np.ascontiguousarray(w[:, [0, -1]].T) for w in (q, c))
    for leaf, rows in tree.reach(x, np.arange(len(x)), down):
        members = tree.members[leaf]
        (c0, c1), step = ends_c[:, members], max(1, COMPARED // (len(members) * c.shape[1]))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            q0, q1 = ends_q[:, part, None]
            a, b = np.nonzero((q0 == c0) | (q1 == c1))  # one edit leaves the first or the last letter in place
            a, b = part[a], members[b]
            hit = np.flatnonzero(_near(q[a], c[b]))
            out.append(np.stack([a[hit], b[hit]]))
    a, b = np.unique(np.concatenate(out, axis=1), axis=1)
    return a, b


def cell_links(own: list[str], guests: list[str], shorter: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of a cell as rows of own + guests + shorter: each pair with a word of the cell once."""
    if not own:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c, x = points(own)
    tree, links = Tree(x, LEAF), []
    for at, words, down in ((0, own, True), (len(own), guests, True), (len(own) + len(guests), shorter, False)):
        if words:
            q, xq = (c, x) if at == 0 else points(words)
            a, b = meetings(tree, xq, q, c, down)
            if at == 0:
                a, b = a[a < b], b[a < b]
            links.append(np.stack([a + at, b]))
    a, b = np.concatenate(links, axis=1)
    return a, b


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, n, form) of each cell: near words of a word there, and the most frequent of them."""
    for t in whole_groups(batches, "cell"):
        cell = t.column("cell").to_numpy()
        cuts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1, append=cell[-1] + 1))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = t.slice(lo, hi - lo)
            words, n = part.column("word").to_pylist(), part.column("n").to_numpy()
            guest, size = part.column("guest").to_numpy(zero_copy_only=False), int(cell[lo]) // CELLS
            sizes = np.array([len(w) for w in words])
            groups = [np.flatnonzero(~guest), np.flatnonzero(guest & (sizes == size)), np.flatnonzero(guest & (sizes < size))]
            order = np.concatenate(groups)
            a, b = cell_links(*([words[i] for i in g] for g in groups))
            if not len(a):
                continue
            a, b = order[np.concatenate([a, b])], order[np.concatenate([b, a])]
            by = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])))
            place = np.empty(len(words), np.int64)
            place[by] = np.arange(len(words))
            best = np.full(len(words), len(words))
            np.minimum.at(best, a, place[b])
            near = np.bincount(a, minlength=len(words))
            rows = np.flatnonzero(near)
            form = by[best[rows]]
            yield pa.record_batch(
                {
                    "word": pa.array([words[i] for i in rows], pa.string()),
                    "near": pa.array(near[rows], pa.int64()),
                    "n": pa.array(n[form], pa.int64()),
                    "form": pa.array([words[i] for i in form], pa.string()),
                }
            )


def _visits(batches: Iterator[pa.RecordBatch], trees: dict[int, Tree], sizes: frozenset[int]) -> Iterator[pa.RecordBatch]:
    """(cell, guest, word, n): each word in its own cell, and as a guest in every other cell where near words may be."""
    for b in batches:
        if not b.num_rows:
            continue
        words, n = np.array(b.column("word").to_pylist(), object), b.column("n").to_numpy()
        length = np.array([len(w) for w in words])
        for size in np.unique(length).tolist():
            at = np.flatnonzero(length == size)
            _, x = points(words[at].tolist())
            own = np.zeros(len(at), np.int64)
            pairs = []
            for target in (size, size + 1):
                if target not in sizes:
                    continue
                tree = trees.get(target)
                if tree is None:
                    pairs.append(np.stack([np.arange(len(at)), np.zeros(len(at), np.int64) + target * CELLS]))
                    continue
                if target == size:
                    own = _home(tree, x)
                met = [np.stack([rows, np.full(len(rows), leaf)]) for leaf, rows in tree.reach(x, np.arange(len(at)), target == size)]
                r, leaf = np.unique(np.concatenate(met, axis=1), axis=1)
                keep = (leaf >= own[r]) if target == size else slice(None)
                pairs.append(np.stack([r[keep], leaf[keep] + target * CELLS]))
            r, cell = np.concatenate(pairs, axis=1)
            yield pa.record_batch(
                {
                    "cell": pa.array(cell, pa.int64()),
                    "guest": pa.array(cell != own[r] + size * CELLS, pa.bool_()),
                    "word": pa.array(words[at][r], pa.string()),
                    "n": pa.array(n[at][r], pa.int64()),
                }
            )


def _home(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf that each point lies in."""
    out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        axis, cut, left, right = tree.nodes[at]
        if axis < 0:
            out[rows] = cut
        else:
            low = x[rows, axis] <= cut
            todo += [(left, rows[low]), (right, rows[~low])]
    return out


def _shapes(words: DataFrame, cell_words: int) -> tuple[dict[int, Tree], frozenset[int]]:
    """Trees of the lengths that need more than one cell, from SAMPLE words each by hash, and all lengths."""
    sizes = {r.size: r["count"] for r in words.groupBy(F.length("word").alias("size")).count().collect()}
    large = {k: c for k, c in sizes.items() if c > cell_words}
    if not large:
        return {}, frozenset(sizes)
    share = F.coalesce(*(F.when(F.length("word") == k, F.lit(SAMPLE / c)) for k, c in large.items()), F.lit(0.0))
    u = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) / float(1 << 30)
    some: dict[int, list[str]] = {k: [] for k in large}
    for r in words.where(u < share).select("word").collect():
        some[len(r.word)].append(r.word)
    trees = {k: Tree(points(w)[1], max(2, len(w) * cell_words / large[k])) for k, w in some.items() if w}
    for tree in trees.values():
        tree.members = []  # only the boxes travel
    return trees, frozenset(sizes)


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n_near, near_n, near) of the words (word, n; each word once) that have near words."""
    trees, sizes = _shapes(words, cell_words)
    met = words.select("word", "n").mapInArrow(lambda b: _visits(b, trees, sizes), "cell bigint, guest boolean, word string, n bigint")
    cells = met.repartition("cell").sortWithinPartitions("cell")
    found = cells.mapInArrow(_summaries, "word string, near bigint, n bigint, form string")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.form").alias("near"))


def spelling_forms(words: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n)."""
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "words")
    all_ = stage(words.join(near_words(words, cell_words), "word", "left"), "near")
    steps = stage(all_.where(F.col("near_n") >= ratio * F.col("n")).select("word", F.col("near").alias("root")), "steps")
    forms = steps
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    ends = forms.select("word", F.col("root").alias("form")).join(steps, "word")
    out = all_.join(ends, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("near_n")).alias("form_n"),
    )


def _lower(run: Column) -> Column:
    return F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): maximal runs of at least MIN_LETTERS letters of every text, A-Z lower-cased."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{MIN_LETTERS},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", _lower(F.col("run")).alias("run"))


def slipped(runs: DataFrame) -> DataFrame:
    """The query's input: some runs lose a letter, by crc32 of document and run."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    cut = "IF(h % 31 = 0, concat(substring(run, 1, CAST(h % length(run) AS int)), substring(run, CAST(h % length(run) AS int) + 2)), run)"
    return runs.select("run", h.alias("h")).select(F.expr(cut).alias("word"))


def word_counts(words: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counts = words.where(F.length("word") >= MIN_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def op13(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spelling_forms(word_counts(slipped(letter_runs(docs))))


SQL = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([i] || range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1))) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
tally AS (SELECT doc_id, w, count(*) AS m, encode(coalesce(doc_id::VARCHAR, '') || ':' || w)::BLOB AS b FROM runs GROUP BY doc_id, w),
crc AS (SELECT w, m, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(b)),
                lambda i: ('0x' || substr(hex(b), 2 * i + 1, 2))::BIGINT),
                lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]))) AS h FROM tally, tab),
cut AS (SELECT m, CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word FROM crc),
v AS (SELECT word, sum(m)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
less AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
gap AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM less),
pair AS (SELECT a.word AS a, b.word AS b FROM gap a JOIN gap b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT g.word, v.word FROM gap g JOIN v ON g.rest = v.word
         UNION SELECT v.word, g.word FROM gap g JOIN v ON g.rest = v.word),
best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS near, max(n) AS near_n FROM (SELECT DISTINCT a, b FROM pair) p JOIN v ON v.word = p.b GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
             CASE WHEN near_n >= 10 * v.n THEN near_n END::BIGINT AS form_n FROM v LEFT JOIN best USING (word)),
go AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT go.word, f.form, k + 1 FROM go JOIN f ON f.word = go.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, k) AS root FROM go GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""
