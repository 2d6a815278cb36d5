"""Language identification by the nearest of several centroids per language.

A text becomes a vector of its letters' 1- to 3-grams (letters lower-cased, all
else a single space), hashed into a fixed number of places, weighted by
(1 + log tf) * idf and scaled to length 1.  Document frequencies are counted
over all training rows; centroids of each language come from spherical k-means
over a bounded sample of them.  A text takes the language of the centroid with
the largest cosine, which is the score.  It is rejected when that cosine is
below REJECT times the lowest one of the language's own sample, or if it has no
letters.  A text with few different n-grams cannot come near a centroid in any
language, so below FULL n-grams the limit falls in proportion to them.

Training rows: a known lang, and crc32 of the doc_id as text not 2 modulo 4.
Bounds of the fit: SAMPLE rows a language (chosen by a hash of doc_id and text), the
LANGUAGES most frequent languages.

Cases: null text, empty text or text without a letter gives ``und`` with score 0
and is rejected; so does everything if there is nothing to learn from; a null
doc_id is never trained on and not held out; ties go to the first language by
name; rows that repeat are judged alike; an empty table gives an empty result;
other columns, whatever their names, are carried along and never looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.session import small_batches

from .common import broadcast_checked, tidied, values_of

PLACES, CLUSTERS, SAMPLE, FULL = 4096, 4, 500, 150
#: A text is rejected below REJECT times this quantile of the cosines of its language's sample.
QUANTILE, REJECT = 0.01, 0.45
#: Characters and texts worked on at once; longer texts are counted piece by piece.
CHUNK_CHARS, CHUNK_TEXTS = 400_000, 256

_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LETTER: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTER[0]


def gram_counts(texts: list[str], places: int = PLACES) -> np.ndarray:
    """Counts of hashed letter 1- to 3-grams, a row for each text (whole texts together here)."""
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low)), [len(t) for t in low])
    code = np.where(_is_letter()[code], code, 32).astype(np.uint64)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (doc[1:] != doc[:-1])
    code, doc = code[keep], doc[keep]
    out = np.zeros(len(low) * places, np.int64)
    h = np.zeros(len(code), np.uint64)
    for n in range(3):
        m = len(code) - n
        if m <= 0:
            break
        h = h[:m] * _P[1] + code[n:] * _P[2] + _P[0]
        ok = doc[:m] == doc[n:]
        ok &= (code[:m] != 32) if n == 0 else True
        at = (h ^ (h >> np.uint64(29))) * _P[0] >> np.uint64(40)
        out += np.bincount(doc[:m][ok] * places + (at[ok] % np.uint64(places)).astype(np.int64), minlength=len(out))
    return out.reshape(len(low), places)


def counted(texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first index, counts, has a letter) for runs of texts; a long text is counted by pieces, overlapping by a 3-gram."""
    start, size, held = 0, 0, []
    for i, t in enumerate(chain(texts, [None])):
        if t is None or len(t) > CHUNK_CHARS or size + len(t) > CHUNK_CHARS or i - start == CHUNK_TEXTS:
            if held:
                x = gram_counts(held)
                yield start, x, x.any(1)
            start, size, held = i, 0, []
        if t is not None and len(t) > CHUNK_CHARS:
            x = np.zeros((1, PLACES), np.int64)
            for a in range(0, len(t), CHUNK_CHARS):
                x += gram_counts([t[a : a + CHUNK_CHARS]])
            yield i, x, x.any(1)
            start = i + 1
        elif t is not None:
            size += len(t)
            held.append(t)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows of (1 + log tf) * idf; a row without grams stays zero."""
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def centroids(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from a farthest-first start; unit rows."""
    chosen = [0]
    while len(chosen) < min(k, len(x)):
        near = (x @ x[chosen].T).max(1)
        near[chosen] = 2
        chosen.append(int(np.argmin(near)))
    c = x[chosen]
    for _ in range(rounds):
        of = np.argmax(x @ c.T, 1)
        c = np.array([x[of == j].sum(0) if (of == j).any() else c[j] for j in range(len(c))])
        c = c / np.sqrt((c * c).sum(1, keepdims=True))
    return c


@dataclass
class Model:
    idf: np.ndarray  # PLACES
    centres: np.ndarray  # rows of unit length
    langs: list[str]  # of each centre
    lowest: np.ndarray  # accepted cosine of each centre, for texts of FULL n-grams

    def predict(self, texts: list[str] | pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        lang, score, reject = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if self.langs:
            each = (t or "" for t in values_of(texts)) if isinstance(texts, pa.Array) else texts
            for start, x, some in counted(each):
                cos = np.clip(weigh(x, self.idf) @ self.centres.T, 0, 1)
                best = np.argmax(cos, 1)
                share = np.minimum(1, (x > 0).sum(1) / FULL)
                for i in np.flatnonzero(some):
                    lang[start + i] = self.langs[best[i]]
                    score[start + i] = cos[i, best[i]]
                    reject[start + i] = score[start + i] < self.lowest[best[i]] * share[i]
        return lang, score, reject


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "text", "lang")


def sampled(training: DataFrame, by_lang: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` training rows of each language (lang, n); a share of u below sample / n, without a product that grows with n."""
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(1 << 40))
    return training.join(broadcast_checked(by_lang, by_lang.count()), "lang").where(u <= F.expr(f"{(sample << 40) - 1}L div n"))


def fit(training: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Learn from rows (doc_id, text, lang)."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(PLACES, np.int64), 0
        for b in batches:
            for _, x, _ in counted(values_of(b.column("text"))):
                total += (x > 0).sum(0)
                rows += len(x)
        yield pa.record_batch([pa.array(np.arange(PLACES + 1)), pa.array(np.append(total, rows))], names=["place", "n"])

    counts = training.select("text").mapInArrow(tidied(frequencies), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    df = np.zeros(PLACES + 1)
    for r in counts.collect():  # PLACES + 1 rows
        df[r.place] = r.n
    idf = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1).astype(np.float32)

    by_lang = training.groupBy("lang").agg(F.count("*").alias("n"))
    picked = sampled(training, by_lang, sample)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, x, some in counted(values_of(b.column("text"))):
                rows = [v.tobytes() if ok else None for v, ok in zip(weigh(x, idf), some)]
                part = b.slice(start, len(x))
                yield pa.record_batch([part.column("lang"), part.column("doc_id"), pa.array(rows, pa.binary())], names=["lang", "doc_id", "v"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "v"])
        x = np.frombuffer(b"".join(pdf.v), np.float32).reshape(len(pdf), PLACES)
        c = centroids(x, clusters)
        near = (x @ c.T).max(1)[(x > 0).sum(1) >= FULL]
        low = REJECT * float(np.quantile(near, QUANTILE)) if len(near) else 0.0
        return pd.DataFrame({"lang": pdf.lang.iat[0], "k": range(len(c)), "c": [r.astype(np.float32).tobytes() for r in c], "low": low})

    kind = picked.schema["doc_id"].dataType.simpleString()
    rows = picked.select("lang", "doc_id", "text").mapInArrow(tidied(vectors), f"lang string, doc_id {kind}, v binary").where("v IS NOT NULL")
    found = rows.groupBy("lang").applyInPandas(learn, "lang string, k int, c binary, low double")
    centres = sorted(found.collect(), key=lambda r: (r.lang, r.k))  # languages * clusters rows of 16 KB
    return Model(
        idf, np.array([np.frombuffer(r.c, np.float32) for r in centres]).reshape(len(centres), PLACES), [r.lang for r in centres], np.array([r.low for r in centres])
    )


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc, lang_pred, score, rejected): ``doc`` holds all columns of the row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CLUSTERS * PLACES numbers a language
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, reject = shared.value.predict(b.column("doc").field("text"))
            yield pa.record_batch([b.column("doc"), pa.array(lang, pa.string()), pa.array(score), pa.array(reject)], names=["doc", "lang_pred", "score", "rejected"])

    kind = own.schema["doc"].dataType.simpleString()
    return own.mapInArrow(tidied(predict), f"doc {kind}, lang_pred string, score double, rejected boolean")


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    small_batches(spark)
    model = fit(training_rows(docs))
    out = classify(docs.select("doc_id", "text"), model)
    return out.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def stage_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    small_batches(spark)
    return classify(docs, fit(training_rows(docs))).where("NOT rejected").select("doc.*")
