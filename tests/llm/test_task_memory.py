"""Tasks hold a bounded amount of text, and give their memory back, whatever the size of an Arrow batch."""

import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from covenant import session
from covenant.llm import common, packing, token_counts, tokens
from covenant.llm import jaccard_join as J
from covenant.llm import language_id as G
from covenant.llm import substring_dedup as S

LONG = "abcdefghi " * 20
TEXTS = [f"{LONG.replace(' ', '')} " * 5_000, None, "", f"é{LONG.replace(' ', 'ü')} " * 9_000, *[f"{LONG.replace(' ', 'z')} " * 8_000] * 6, "last"]


def batch(texts):
    n = range(len(texts))
    return pa.record_batch([pa.array(n, pa.int64()), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(n, pa.int32())], names=["doc_id", "text", "block", "m"])


def peak(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_slices_are_the_rows_in_order():
    b = batch(TEXTS)
    got = list(common.sliced([b, b.slice(0, 0), b.slice(3, 2)]))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([b, b.slice(3, 2)]))
    assert len(got) > 3 and all(x.num_rows == 1 or sum(len((t or "").encode()) for t in x.column("text").to_pylist()) <= common.SLICE_BYTES for x in got)
    assert list(common.texts_of(b.column("text"))) == [(t or "").encode() for t in TEXTS]


def test_a_batch_is_never_whole_in_python():
    column = pa.array([f"{i} " * 20_000 for i in range(500)])  # some 38 MB
    _, most = peak(lambda: sum(map(len, common.texts_of(column))))
    assert column.nbytes > 8 * common.SLICE_BYTES and most < 3 * common.SLICE_BYTES


def test_tokenising_tasks_work_on_slices_and_give_back(monkeypatch):
    class Rows:  # a table that keeps the function it is given
        schema = {"doc_id": SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))}
        select = lambda self, *a: self
        agg = lambda self, *a: SimpleNamespace(first=lambda: [9])

        def mapInArrow(self, f, _):
            self.task = f
            raise StopIteration

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setattr(token_counts.F, "max", lambda c: c)
    monkeypatch.setattr(token_counts.F, "octet_length", lambda c: c)
    for write in (packing.pieces, lambda rows: token_counts.write_token_files(rows, "")):
        rows = Rows()
        try:
            write(rows)
        except StopIteration:
            pass
        out = list(rows.task([batch(TEXTS[4:])]))
        assert len(out) > 2 and given.pop() and not given


def test_sets_and_kept_texts_come_in_slices():
    b = batch(TEXTS)
    items = list(J._items([b], 5))
    assert len(items) > 2 and [i for x in items for i in x.column("doc_id").to_pylist()] == list(range(len(TEXTS)))
    assert len(list(J._sets([b], 5))) > 2
    doc = pa.StructArray.from_arrays(b.columns, b.schema.names)
    none = pa.nulls(len(TEXTS), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))
    rows = pa.record_batch([doc, pa.nulls(len(TEXTS), pa.int64()), none], names=["doc", "copies", "ranges"])
    schema = lambda b: pa.schema([("doc", b.column("doc").type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
    kept = list(S._keep([rows], 35, schema))
    assert len(kept) > 2 and [x for k in kept for x in k.column("kept").to_pylist()] == [" ".join((t or "").split()).encode() for t in TEXTS]


def test_repeated_names_of_a_bucket_in_little_memory():
    r = np.random.default_rng(3)
    chunks = [r.integers(0, 150_000, 4_000).astype(np.uint32) for _ in range(40)] + [np.zeros(0, np.uint32)]
    at = [np.arange(len(x)).astype(np.uint16) for x in chunks]
    n = len(chunks)
    rows = [pa.array([5] * n, pa.int32()), pa.array(range(n), pa.int64()), *(pa.array([x.tobytes() for x in xs], pa.binary()) for xs in (chunks, at)), *[pa.array([b""] * n, pa.binary())] * 2]
    b = pa.record_batch(rows, names=["bucket", "chunk", "names", "at", "docs", "sizes"])
    (got,), most = peak(lambda: list(J._repeated([b])))
    count = Counter(np.concatenate(chunks).tolist())
    assert got.column("at").to_pylist() == [a[[count[v] > 1 for v in x.tolist()]].tobytes() if len(x) else b"" for x, a in zip(chunks, at)]
    assert most < 30 * sum(map(len, chunks))  # bytes a name, with the rows themselves
    alone = b.slice(n - 1)
    assert [x.column("at").to_pylist() for x in J._repeated([alone])] == [[b""]]


def test_languages_of_an_arrow_column_are_those_of_a_list():
    texts = ["alpha beta gamma", None, "12 34", "delta " * 90_000, "", *["eta theta"] * 300]
    r = np.random.default_rng(1)
    centres = r.random((3, G.PLACES)).astype(np.float32) / 50
    model = G.Model(np.ones(G.PLACES, np.float32), centres, ["a", "b", "c"], np.full(3, 0.1))
    for one, other in zip(model.predict([t or "" for t in texts]), model.predict(pa.array(texts, pa.string()))):
        assert list(one) == list(other)


def test_the_encoder_goes_with_its_task():
    for write in (packing.pieces, lambda rows: token_counts.write_token_files(rows, "")):
        given = {}

        class Rows:
            schema = {"doc_id": SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))}
            select = lambda self, *a: self
            agg = lambda self, *a: SimpleNamespace(first=lambda: [9])

            def mapInArrow(self, f, _):
                given["task"] = f
                raise StopIteration

        with pytest.MonkeyPatch.context() as m:
            m.setattr(token_counts.F, "max", lambda c: c)
            m.setattr(token_counts.F, "octet_length", lambda c: c)
            with pytest.raises(StopIteration):
                write(Rows())
        out = given["task"](iter([batch(["one two", "three"])]))
        assert next(out).num_rows and tokens._MADE
        assert not list(out) and not tokens._MADE


def test_arrow_batches_are_small_unless_the_caller_says_otherwise(spark):
    key, value = session.ARROW_BATCH
    size = lambda s: s.range(0, 4_000, 1, 1).selectExpr("repeat('abcdefgh', 400) t").mapInArrow(lambda bs: (pa.record_batch([pa.array([b.nbytes])], names=["n"]) for b in bs), "n long")
    for step in (G.stage_language, J.stage_join, S.stage_substrings, packing.stage_pack):
        own = spark.newSession()
        docs = own.createDataFrame([(1, "alpha beta gamma", "en"), (2, "delta", "en")], "doc_id long, text string, lang string")
        docs = docs.withColumn("n_chars", F.length("text"))
        step(own, docs, "")
        assert own.conf.get(key) == value
    assert max(r.n for r in size(own).collect()) < int(value) + 10_000
    own = spark.newSession()
    own.conf.set(key, "1m")
    session.small_batches(own)
    assert own.conf.get(key) == "1m"
