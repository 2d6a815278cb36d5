"""Operator 12: personal data by proposed spans, boosted trees and calibrated thresholds.

1. Generators propose spans of high recall that may overlap: addresses with the
   signs spelled out, quads with spread dots, and every window of digit groups
   whose number of digits may be a card or a phone number.  They also run inside
   stretches that a strict pattern swallowed whole and then dropped.
2. Each span is described by its format (digits, groups, signs, checksum) and
   its context (neighbouring characters, cue words, digits around).
3. One model per kind, trees boosted on the logistic loss, is trained here.  The
   examples of a kind are its strict spans; each is also written in other formats
   (without the plus, other separators, signs spelled out) in the same context.
   Counter-examples are the proposed spans that touch no span whose own text
   passes a strict pattern.
4. The texts of a held-out half calibrate the scores (isotonic fit) and set a
   threshold per kind: the lowest score whose calibrated probability, and the
   lower confidence bound of the precision from it on, are PRECISION or more.
   Scores are counted in LEVELS equal steps, and a threshold is the start of one.
   Without enough evidence there is none, and the method adds nothing.

Strict (base) spans always stay; proposed spans over the threshold that touch no
base span are added, longest first, none touching another.

Models and thresholds come from the examples of every whole text.  Bins of a
feature are exact quantiles; a level of the trees of all kinds is one aggregation
of the gradients by node, feature and bin, summed in whole steps of 1 / UNIT, so
that neither partitions nor reruns change a model.  The driver gets these sums,
whose number depends on the constants only.  All scans are linear in the text,
whatever it holds.

Defined results: null and empty texts have no spans.  Repeated rows are worked
on each for itself.  An empty table gives an empty result.  Other columns,
whatever their names, come back in the struct ``doc``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: The kinds, in the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone")

#: Examples that a task hands on at once, and that a task of the training holds on average.
EXAMPLES, TASK_EXAMPLES = 10_000, 16_384

#: Trees of a model, their depth, the step of each, bins a feature, least curvature of the loss in a leaf.
TREES, DEPTH, RATE, BINS, LEAF = 40, 3, 0.2, 32, 0.25

#: Sums are of whole steps of 1 / UNIT; scores are counted in LEVELS steps (powers of two).
UNIT, LEVELS = 1 << 24, 1 << 16

#: Held-out precision that a threshold has to reach by its lower bound, at this many standard deviations.
PRECISION, SIGMAS = 0.95, 1.64

#: Characters of context on each side, and the longest local part of a proposed address.
CONTEXT, LOCAL = 40, 64

#: Cue words before a span, by kind (fixed values, several languages).
CUES = {
    "email": "email e-mail mail contact write correo courriel kontakt",
    "ip": "ip host server address addr adresse direccion",
    "card": "card visa mastercard credit debit carte tarjeta karte",
    "phone": "phone tel call mobile fax telephone telefon telefono appel",
}
_CUE = {w: k for k, kind in enumerate(KINDS) for w in CUES[kind].split()}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ISLAND = re.compile(r"[0-9+][0-9 ().+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r" ?(?:@|[(\[{]at[)\]}]) ?| at ")
_SPELT = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|[(\[{](?:dot|\.)[)\]}]) ?[A-Za-z0-9-]++| dot [A-Za-z0-9-]++)++")
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[(\[]?\.[)\]]? ?[0-9]{1,3}){3}(?![0-9])")
_WORD = re.compile(r"[^\W\d_][^\W_]*-?[^\W_]*")

_STRICT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": re.compile(r"[0-9]++(?:\.[0-9]++){3}"),
    "card": _CARD,
    "phone": _PHONE,
}


def luhn(digits: str) -> bool:
    """Check digit of a card number: every second digit from the right doubled, digit sums add to a multiple of ten."""
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += sum(divmod(2 * int(d), 10))
    return total % 10 == 0


def passes(kind: str, text: str) -> bool:
    """The check of a strict match."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))
    digits = "".join(_DIGITS.findall(text))
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def _emails(text: str, at: int = 0) -> Iterator[tuple[int, int]]:
    """Strict addresses, from each @ outwards: what ends before it decides, so one pass is enough."""
    done = 0
    at = text.find("@", at)
    while at >= 0:
        s = at
        while s > done and _LOCAL.match(text[s - 1]):
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def _islands(text: str) -> list[tuple[int, str]]:
    """Stretches of digits and the signs between them, where every number lies in."""
    return [(m.start(), m.group()) for m in _ISLAND.finditer(text) if m.end() - m.start() >= 7]


def base_spans(text: str, islands: list[tuple[int, str]] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strict spans, sorted: per kind leftmost matches that do not overlap and pass the check."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for at, island in _islands(text) if islands is None else islands:
        for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            found += [(at + m.start(), k, at + m.end()) for m in pattern.finditer(island) if passes(KINDS[k], m.group())]
    return sorted(found)


def _windows(island: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of every window of digit groups with as many digits as a card or a phone number."""
    groups = [m.span() for m in _DIGITS.finditer(island)]
    for i, (s, _) in enumerate(groups):
        n = 0
        for a, b in groups[i : i + 19]:
            n += b - a
            if n > 19:
                break
            if 13 <= n:
                yield 2, s, b
            if 7 <= n <= 15:
                yield 3, s, b
                if s and island[s - 1] in "+(":
                    yield 3, s - 1 - (s > 1 and island[s - 2] == "+"), b


def proposed(text: str, islands: list[tuple[int, str]]) -> set[tuple[int, int, int]]:
    """(start, kind number, end) of all spans that may be personal data; they overlap."""
    found = {(s, 0, e) for s, e in _emails(text)}
    if "dot" in text or "@" in text or "at)" in text or "at]" in text or "at}" in text:
        for m in _AT.finditer(text):
            d = _SPELT.match(text, m.end())
            s = m.start()
            while s > max(0, m.start() - LOCAL) and _LOCAL.match(text[s - 1]):
                s -= 1
            if d and s < m.start():
                found.add((s, 0, d.end()))
    if "[." in text:
        found |= {(m.start(), 1, m.end()) for m in _QUAD.finditer(text)}
    for at, island in islands:
        found |= {(at + m.start(), 1, at + m.end()) for p in (_IP, _QUAD) for m in p.finditer(island)}
        found |= {(at + s, k, at + e) for k, s, e in _windows(island)}
    return found


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, start: int, end: int) -> list[float]:
    """Format and context of one span."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = _DIGITS.findall(span)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    words = _WORD.findall(before)[-3:]
    cues = [0.0] * len(KINDS)
    for w in words:
        if (k := _CUE.get(w.lower())) is not None:
            cues[k] = 1.0
    tail = re.split(r"[^A-Za-z0-9-]+", span)[-1]
    around = before + after
    return [
        len(span), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        span[0] == "+", span.count("("), span.count(" "), span.count("-"), span.count("."), span.count("@"),
        len(digits) > 1 and luhn(digits), max((min(int(g[:7]), 10**6) for g in groups), default=0), len(set(digits)),
        sum(c.isalpha() for c in span), len(tail), tail.isalpha(), bool(re.search(r"\bat\b", span)), bool(re.search(r"\bdot\b", span)),
        _side(before[-1:]), _side(after[:1]), _side(before[-2:-1]), _side(after[1:2]),
        len(words[-1]) if words else 0, *cues, sum(c.isdigit() for c in around), len(around),
    ]


def _other_formats(kind: int, span: str, seed: int) -> list[str]:
    """The same datum as people write it to get past a strict pattern."""
    digits = "".join(_DIGITS.findall(span))
    if kind == 0:
        return [span.replace("@", a).replace(".", d) for a, d in ((" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), (" @ ", "."))]
    if kind == 1:
        return [span.replace(".", d) for d in (" . ", "(.)", "[.]")]
    if kind == 2:
        return ["".join(c + ("-- "[seed % 3] if i % 4 == 3 and i + 1 < len(digits) else "") for i, c in enumerate(digits))]
    local = digits[-10:]
    return [f"({local[:3]}) {local[3:6]}-{local[6:]}", *(d.join((local[:3], local[3:6], local[6:])) for d in "-. ")]


def examples(text: str) -> Iterator[tuple[int, float, float, list[float]]]:
    """(kind number, label, weight, features): spans that pass strictly, other formats of these, and proposed spans apart from them."""
    islands = _islands(text)
    spans = proposed(text, islands)
    good = [(s, k, e) for s, k, e in spans if _STRICT[KINDS[k]].fullmatch(text, s, e) and passes(KINDS[k], text[s:e])]
    taken = np.zeros(len(text) + 1, bool)
    for s, _, e in good:
        taken[s:e] = True
    for s, k, e in base_spans(text, islands):
        yield k, 1.0, 1.0, features(text, s, e)
        others = _other_formats(k, text[s:e], s)
        for other in others:
            near = text[max(0, s - CONTEXT) : s]
            yield k, 1.0, 1.0 / len(others), features(near + other + text[e : e + CONTEXT], len(near), len(near) + len(other))
    for s, k, e in spans:
        if not taken[s:e].any():
            yield k, 0.0, 1.0, features(text, s, e)


@dataclass
class Boosted:
    """Trees of one kind as arrays over their nodes (children of node i: 2i + 1, 2i + 2), and the threshold of the score."""

    start: float = 0.0
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    value: list = field(default_factory=list)
    threshold: float = float("inf")

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            f, c, node = np.asarray(f), np.asarray(c), np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += np.asarray(v)[node - len(f)]
        return 1 / (1 + np.exp(-out))


def _descend(binned: np.ndarray, feature: np.ndarray, split: np.ndarray, levels: int) -> np.ndarray:
    """Place within its level of the node that each row reaches after so many levels."""
    node, rows = np.zeros(len(binned), int), np.arange(len(binned))
    for _ in range(levels):
        node = 2 * node + 1 + (binned[rows, feature[node]] > split[node])
    return node - (2**levels - 1)


def _scores(binned: np.ndarray, start: float, trees: list) -> np.ndarray:
    out = np.full(len(binned), start)
    for feature, split, value in trees:
        out += value[_descend(binned, feature, split, DEPTH)]
    return 1 / (1 + np.exp(-out))


def _whole(x: np.ndarray) -> np.ndarray:
    """Values in whole steps of 1 / UNIT: sums of them are the same in any order."""
    return np.rint(x * UNIT)


def _sums(binned: np.ndarray, y: np.ndarray, w: np.ndarray, start: float, trees: list, level: int) -> np.ndarray:
    """Gradients and their curvature by (node of a level of the last tree, feature, bin), in steps of 1 / UNIT."""
    d, (feature, split, _) = binned.shape[1], trees[-1]
    p = _scores(binned, start, trees[:-1])
    node = _descend(binned, feature, split, level)
    cell = ((node[:, None] * d + np.arange(d)) * BINS + binned).ravel()
    return np.stack([np.bincount(cell, np.repeat(_whole(v), d), 2**level * d * BINS).astype(np.int64) for v in (w * (p - y), w * p * (1 - p))])


def _split(sums: np.ndarray, tree: tuple, level: int) -> None:
    """Give each node of a level the split of greatest gain, and below the last level the leaves their values."""
    feature, split, value = tree
    for at, (g, h) in enumerate(sums.reshape(2, 2**level, -1, BINS).transpose(1, 0, 2, 3)):
        (gl, hl), (g, h) = (np.cumsum(v, axis=-1)[:, :-1] / UNIT for v in (g, h)), (v[0].sum() / UNIT for v in (g, h))
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        gain = np.where((hl >= LEAF) & (h - hl >= LEAF), gain, 0)
        j, b = np.unravel_index(gain.argmax(), gain.shape)
        left = (g, h)
        if gain[j, b] > 1e-6:
            feature[2**level - 1 + at], split[2**level - 1 + at], left = j, b, (gl[j, b], hl[j, b])
        if level == DEPTH - 1:
            value[2 * at : 2 * at + 2] = [-RATE * a / (c + 1) for a, c in (left, (g - left[0], h - left[1]))]


def grow(starts: dict[int, float], sums) -> dict[int, list]:
    """Trees (features, bins, values) of each kind; ``sums(trees, level)`` gives the ``_sums`` of all training examples by kind."""
    trees: dict[int, list] = {k: [] for k in starts}
    for _ in range(TREES if starts else 0):
        for own in trees.values():  # a node without a split sends all rows to the left
            own.append((np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, BINS), np.zeros(2**DEPTH)))
        for level in range(DEPTH):
            for k, found in sums(trees, level).items():
                _split(found, trees[k][-1], level)
    return trees


def _model(start: float, trees: list, cuts: list[np.ndarray], threshold: float = float("inf")) -> Boosted:
    """Trees over bins as trees over values."""
    cut = [[float(cuts[j][b]) if b < BINS else float("inf") for j, b in zip(f, split)] for f, split, _ in trees]
    return Boosted(start, [f.tolist() for f, _, _ in trees], cut, [v.tolist() for _, _, v in trees], threshold)


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], axis=1).astype(np.uint8)


def _start(right: float, n: float) -> float:
    p = np.clip(right / n, 1e-3, 1 - 1e-3)
    return float(np.log(p / (1 - p)))


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Boosted:
    """Trees boosted on the logistic loss, over features cut into at most BINS quantiles, of examples at hand."""
    at = np.rint(np.arange(BINS) * (len(x) - 1) / (BINS - 1)).astype(int)
    cuts = [(lambda q: q[:-1])(np.unique(np.sort(c)[at])) for c in x.T]
    binned, start = _bins(x, cuts), _start(_whole(w * y).sum(), _whole(w).sum())
    trees = grow({0: start}, lambda trees, level: {0: _sums(binned, y, w, start, trees[0], level)})
    return _model(start, trees[0], cuts)


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Calibrated probability of each score: the best fit that never falls as the score rises (equal scores are one)."""
    scores, at = np.unique(score, return_inverse=True)
    right, n = np.bincount(at, w * y), np.bincount(at, w)
    blocks: list[list[float]] = []
    for r, m in zip(right, n):
        blocks.append([r, m, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.repeat([r / m for r, m, _ in blocks], [k for *_, k in blocks])[at]


def calibrate(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Lowest score of calibrated probability PRECISION from which on the precision of all has that lower bound; infinite if none."""
    order = np.argsort(-score, kind="stable")
    s, right, n = score[order], np.cumsum((w * y)[order]), np.cumsum(w[order])
    p, z = right / n, SIGMAS**2 / n
    lower = (p + z / 2 - SIGMAS * np.sqrt(np.clip(p * (1 - p), 0, 1) / n + z**2 / (4 * SIGMAS**2))) / (1 + z)
    last = np.append(s[1:] != s[:-1], True)
    ok = np.flatnonzero(last & (lower >= PRECISION) & (isotonic(score, y, w)[order] >= PRECISION))
    return float(s[ok[-1]]) if len(ok) else float("inf")


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(out):
        kind, y, w, x, held = zip(*out)
        return pa.record_batch(
            {"kind": pa.array(kind, pa.int32()), "y": pa.array(y, pa.float64()), "w": pa.array(w, pa.float64()),
             "x": pa.array([[float(v) for v in r] for r in x], pa.list_(pa.float64())), "held": pa.array(held, pa.bool_())}
        )

    out: list[tuple] = []
    for b in batches:
        for t, held in zip(b.column("text").to_pylist(), b.column("held").to_pylist()):
            for r in examples(t or ""):
                out.append((*r, held))
                if len(out) >= EXAMPLES:
                    yield table(out)
                    out = []
    if out:
        yield table(out)


def _cuts(train: DataFrame, sizes: dict[int, int]) -> dict[int, list[np.ndarray]]:
    """Per kind and feature the bounds of its bins: exact quantiles of the ``sizes`` examples a kind, but the largest."""
    values = train.selectExpr("kind", "posexplode(x) AS (j, v)").groupBy("kind", "j", "v").count()
    n = F.coalesce(*(F.when(F.col("kind") == k, F.lit(c)) for k, c in sizes.items()))
    upto = F.sum("count").over(Window.partitionBy("kind", "j").orderBy("v"))
    at = f"rint(i * (n - 1) / {BINS - 1})"
    hit = values.withColumns({"upto": upto, "n": n}).where(f"exists(sequence(0, {BINS - 1}), i -> {at} >= upto - count AND {at} < upto)")
    out: dict[int, dict] = {k: {} for k in sizes}
    for r in sorted(hit.select("kind", "j", "v").collect()):
        out[r.kind].setdefault(r.j, []).append(r.v)
    return {k: [np.array(v[:-1]) for _, v in sorted(own.items())] for k, own in out.items()}


def _blocks(batches: Iterator[pa.RecordBatch], cuts: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Examples of a batch by kind and half, as bytes: bins (one each), labels and weights (doubles)."""
    for b in batches:
        kind, held = b.column("kind").to_numpy(), b.column("held").to_numpy(zero_copy_only=False)
        for k, h in sorted(set(zip(kind.tolist(), held.tolist()))):
            own = b.filter(pa.array((kind == k) & (held == h)))
            bins = _bins(own.column("x").flatten().to_numpy().reshape(own.num_rows, -1), cuts[k])
            data = {c: [own.column(c).to_numpy().tobytes()] for c in ("y", "w")}
            yield pa.record_batch({"kind": pa.array([k], pa.int32()), "held": [h], "b": [bins.tobytes()], **data})


def _totals(blocks: RDD, work) -> dict[int, np.ndarray]:
    """Sum of ``work(kind, bins, labels, weights)`` over all blocks, by kind."""

    def of_task(rows):
        out: dict[int, np.ndarray] = {}
        for r in rows:
            y, w = np.frombuffer(r.y), np.frombuffer(r.w)
            bins = np.frombuffer(r.b, np.uint8).reshape(len(y), -1)
            out[r.kind] = out.get(r.kind, 0) + work(r.kind, bins, y, w)
        yield out

    return blocks.mapPartitions(of_task).treeReduce(lambda a, b: {k: a.get(k, 0) + b.get(k, 0) for k in {*a, *b}})


def _by_level(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights of the true and of all examples by level of their score, in steps of 1 / UNIT."""
    at = np.floor(score * LEVELS).astype(int)
    return np.stack([np.bincount(at, _whole(v), LEVELS + 1).astype(np.int64) for v in (w * y, w)])


def fit(docs: DataFrame) -> dict[int, Boosted]:
    """One model per kind number, from all examples of all documents; the driver gets sums by bin and by level of score."""
    part = F.pmod(F.xxhash64(F.lit(2), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    texts = docs.select("text", (part < 0.5).alias("held"))
    rows = stage(texts.mapInArrow(_examples, "kind int, y double, w double, x array<double>, held boolean"), "spans")
    whole = lambda x: F.sum(F.rint(x * UNIT).cast("long"))
    sizes = rows.groupBy("kind", "held").agg(F.count("*").alias("n"), whole(F.col("w") * F.col("y")).alias("right"), whole(F.col("w")).alias("all"))
    sizes = {(r.kind, r.held): r for r in sizes.collect()}
    kinds = sorted({k for k, _ in sizes})
    starts = {k: _start(r.right, r["all"]) for k in kinds if (r := sizes.get((k, False))) and r.right and (k, True) in sizes}
    if not starts:
        return {k: Boosted() for k in kinds}
    tasks = -(-sum(r.n for r in sizes.values()) // TASK_EXAMPLES)
    rows = rows.where(F.col("kind").isin(list(starts)))
    cuts = _cuts(rows.where("NOT held"), {k: sizes[k, False].n for k in starts})
    blocks = stage(rows.coalesce(tasks).mapInArrow(lambda b: _blocks(b, cuts), "kind int, held boolean, b binary, y binary, w binary"), "bins")
    train = blocks.where("NOT held").rdd  # planned once, read again for each level of the trees
    trees = grow(starts, lambda trees, level: _totals(train, lambda k, *rows: _sums(*rows, starts[k], trees[k], level)))
    scored = _totals(blocks.where("held").rdd, lambda k, bins, y, w: _by_level(_scores(bins, starts[k], trees[k]), y, w))
    out = {k: Boosted() for k in kinds}
    for k, (right, n) in scored.items():
        at = np.flatnonzero(n)
        threshold = calibrate(at / LEVELS, right[at] / n[at], n[at] / UNIT)
        out[k] = _model(starts[k], trees[k], cuts[k], threshold)
    return out


def added_spans(text: str, base: list[tuple[int, int, int]], islands: list[tuple[int, str]], model: dict[int, Boosted]) -> list[tuple[int, int, int, float]]:
    """(start, kind number, end, score) of proposed spans over their threshold, longest first, touching neither base spans nor each other."""
    spans = sorted(proposed(text, islands))
    if not spans:
        return []
    taken = np.zeros(len(text) + 1, bool)
    for s, _, e in base:
        taken[s:e] = True
    spans = [x for x in spans if x[1] in model and not taken[x[0] : x[2]].any()]
    found = []
    for k in {x[1] for x in spans}:
        own = [x for x in spans if x[1] == k]
        score = model[k].score(np.array([features(text, s, e) for s, _, e in own], float))
        found += [(*x, float(p)) for x, p in zip(own, score) if p >= model[k].threshold]
    out = []
    for s, k, e, p in sorted(found, key=lambda x: (x[0] - x[2], -x[3], x[0], x[1])):
        if not taken[s:e].any():
            taken[s:e] = True
            out.append((s, k, e, p))
    return out


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of touching spans replaced by the name of its first kind, in brackets."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _find(batches: Iterator[pa.RecordBatch], model: dict[int, Boosted]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])
    for b in batches:
        spans, clean = [], []
        for text in b.column("text").to_pylist():
            islands = _islands(text or "")
            base = base_spans(text or "", islands)
            more = added_spans(text, base, islands, model) if text else []
            every = sorted([(s, k, e, 1.0, True) for s, k, e in base] + [(s, k, e, p, False) for s, k, e, p in more])
            spans.append([{"kind": KINDS[k], "start": s, "end": e, "score": p, "base": x} for s, k, e, p, x in every])
            clean.append(redact(text, [x[:3] for x in every]) if every else None)
        yield pa.record_batch({"doc": b.column("doc"), "spans": pa.array(spans, pa.list_(kind)), "redacted": pa.array(clean, pa.string())})


def find_pii(docs: DataFrame, model: dict[int, Boosted]) -> DataFrame:
    """(doc, spans, redacted) per row of ``docs``.

    ``doc`` holds the row's columns but ``text``; ``spans`` has (kind, start,
    end, score, base) by start, then kind, in code points, end exclusive;
    ``redacted`` is the text with the spans replaced, null where there are none.
    """
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("doc")
    rows = docs.select(doc, "text")
    span = "struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>"
    return rows.mapInArrow(lambda b: _find(b, model), f"doc {rows.schema['doc'].dataType.simpleString()}, spans array<{span}>, redacted string")


def op12(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs, fit(docs))
    line = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    own = "filter(spans, s -> s.base)"
    return found.select(
        "doc.doc_id",
        *(F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(line.format(own)), 256).alias("base_sha256"),
        F.expr(line.format("spans")).alias("spans"),
    )
