import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covenant.llm import language_id as G
from covenant.llm import packing as K
from covenant.llm import token_counts as C
from covenant.llm.tokens import encoder

SF = "/root/testdata/sf0.01"


def whole(text):
    return encoder().whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\r\u00a0\u0085\u2028\x1cab'sZé日0.,<|>½", max_size=40))
def test_cached_encoding_equals_the_tokenizer(text):
    assert np.frombuffer(encoder().encode(text), "<u4").tolist() == whole(text)


def test_encoding_of_special_marks_and_long_words():
    for text in ("a<|endoftext|>b", "it's we'll  'x", "x" * 5000 + " " + "y" * 300, "the quick   brown\n\n fox", ""):
        assert np.frombuffer(encoder().encode(text), "<u4").tolist() == whole(text)


DOCS = [(1, None), (2, ""), (3, "a"), (4, "word " * 3000), (5, "alpha beta gamma " * 400), (6, "<|endoftext|> # two"), (3, "a"), (None, "null id")] + [
    (100 + i, "lorem ipsum dolor sit amet " * (i * 7 % 60)) for i in range(150)
]


def check_packing(docs, got, capacity):
    want = []
    for i, text in docs:
        ids = np.array([*whole(text or ""), 2], "<u4")
        want += [(str(i), k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(K.cut(len(ids), capacity))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    room = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == room.get(r.sequence_id, 0)
        room[r.sequence_id] = r.offset + r.length
    assert max(room.values()) <= capacity
    return len(room), sum(room.values())


@pytest.mark.parametrize("bucket_rows", [50_000, 10])
def test_packing_is_whole_gapless_and_tight(spark, bucket_rows):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS slot")
    n, tokens = check_packing(DOCS, K.pack(K.pieces(df), bucket_rows=bucket_rows).collect(), 1024)
    assert n <= -(-tokens // 1024) * 11 / 9 + 1


def test_packing_empty_table_and_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert K.pack(K.pieces(empty)).collect() == []
    r = K.pieces(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), with_ids=True).first()
    assert np.frombuffer(r.ids, "<u4").tolist() == [*whole("a b"), 2]


@given(st.dictionaries(st.integers(1, 32), st.integers(1, 30), max_size=12))
@settings(max_examples=100, deadline=None)
def test_plan_is_best_fit_decreasing(histogram):
    runs = K.plan(histogram, 32)
    fill, seen = {}, {}
    for length, rank, count, first, offset in runs:
        assert rank == seen.get(length, 0)
        seen[length] = rank + count
        for s in range(first, first + count):
            assert fill.get(s, 0) == offset
            fill[s] = offset + length
    assert seen == histogram and max(fill.values(), default=0) <= 32
    rooms = []  # one item at a time
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else 32) - length)
    assert sorted(32 - r for r in rooms) == sorted(fill.values())


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_token_counts_across_blocks(spark, tmp_path, block):
    docs = DOCS[:20]
    C.write_token_files(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), f"{tmp_path}/t")
    got = C.scan(spark, f"{tmp_path}/t", block_tokens=block).collect()
    for path in {r.path for r in got}:
        at = 0
        for k, r in enumerate(sorted((r for r in got if r.path == path), key=lambda r: r.doc)):
            assert (r.doc, r.start, r.ended) == (k, at, True)
            at += r.tokens + 1
    literal = encoder().literal
    want = [literal.encode(t or "", add_special_tokens=False).ids for _, t in docs]  # a mark in a text ends nothing
    assert not any(50256 in ids for ids in want) and any("<|endoftext|>" in (t or "") for _, t in docs)
    assert sorted(r.tokens for r in got) == sorted(map(len, want)) and len(got) == len(docs)


def test_token_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "FILE_BYTES", 4000)
    docs = spark.createDataFrame([(i, "word " * (i % 5 * 20)) for i in range(60)], "doc_id long, text string").coalesce(1)
    C.write_token_files(docs, f"{tmp_path}/t")
    sizes = [f.stat().st_size for f in (tmp_path / "t").glob("part-*")]
    assert len(sizes) > 5 and max(sizes) <= 4000
    assert C.scan(spark, f"{tmp_path}/t").count() == 60


def test_token_file_without_last_end_and_empty_file(spark, tmp_path):
    (tmp_path / "f").mkdir()
    np.array([5, 6, 9, 9, 7], "<u4").tofile(tmp_path / "f" / "a.bin")
    (tmp_path / "f" / "b.bin").touch()
    got = C.scan(spark, f"{tmp_path}/f", end=9, width=4, block_tokens=2).select("doc", "start", "tokens", "ended").collect()
    assert sorted(map(tuple, got)) == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, False)]
    assert C.scan(spark, f"{tmp_path}/f", end=8, width=4, block_tokens=3).select("doc", "start", "tokens", "ended").collect() == [(0, 0, 5, False)]


def test_language_on_held_out_documents(spark):
    out = G.op1(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet", columns=["doc_id", "lang", "text"])
    m = out.merge(docs, on="doc_id")
    assert len(m) == len(docs) and (m.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in m.doc_id]).all()
    h = m[m.held_out]
    assert len(h) > 100 and (h.lang == h.lang_pred).mean() > 0.98
    assert m.score.between(0, 1).all() and not m.rejected.any()


FOREIGN = [
    "De snelle bruine vos springt over de luie hond en loopt daarna door het bos naar huis waar de kinderen wachten op het avondeten.",
    "Szybki brązowy lis przeskakuje nad leniwym psem i biegnie dalej przez las do domu gdzie czekają dzieci na kolację.",
    "Nopea ruskea kettu hyppää laiskan koiran yli ja juoksee sitten metsän läpi kotiin missä lapset odottavat illallista.",
    "Съешь же ещё этих мягких французских булок да выпей чаю.",
    "La veloce volpe marrone salta sopra il cane pigro e poi corre attraverso il bosco verso casa dove i bambini aspettano la cena.",
    "Rychlá hnědá liška skáče přes líného psa a potom běží lesem domů kde děti čekají na večeři.",
    "asdf qwer zxcv hjkl poiu mnbv lkjh",
    "xk jq zv wq kx vj",
]


def test_foreign_languages_and_junk_are_rejected_and_known_texts_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = G.fit(G.training_rows(docs))
    r = np.random.default_rng(2)
    noise = [" ".join("".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), int(r.integers(2, 10)))) for _ in range(120)) for _ in range(12)]
    _, _, foreign = model.predict([f"{t} " * 4 for t in FOREIGN] + noise)
    assert foreign.mean() >= 0.95
    held = docs.where(G.held_out()).select("text").toPandas().text.tolist()
    _, _, known = model.predict(held)
    assert len(held) > 200 and known.mean() <= 0.005


def test_no_language_is_left_out(spark):
    rows = [(4 * i + k, " ".join([f"{chr(0x4E00 + i)}{chr(0x5E00 + i)}"] * 30), f"l{i:03d}") for i in range(300) for k in range(4)]
    model = G.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), clusters=1)
    assert len(set(model.langs)) == 300


def test_language_cases(spark):
    r = np.random.default_rng(0)
    prose = lambda letters: " ".join("".join(r.choice(list(letters), 5)) for _ in range(150))
    train = [(i, *x) for i in range(40) for x in (("the of and that with this " + prose("abdehinost"), "en"), ("der die und nicht ein ist " + prose("cdeginrstu"), "de"))]
    model = G.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), clusters=2)
    rows = [(1, "the and with", "x"), (2, "nicht die", None), (3, None, "en"), (4, " 123 ?!", "en"), (5, "", None), (6, "the and " * 200_000, None), (6, "".join(chr(0x4E00 + i) for i in range(400)), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = [(r.doc.doc_id, r.lang_pred, r.rejected) for r in G.classify(df, model).collect()]
    assert got[:6] == [(1, "en", False), (2, "de", False), (3, "und", True), (4, "und", True), (5, "und", True), (6, "en", False)]
    assert got[6][2]  # far from every language
    none = G.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in G.classify(df, none).collect()] == ["und"] * 7
    assert G.classify(df.limit(0), model).collect() == []


def test_long_text_is_counted_whole():
    a, b = "ab cd " * 100_000, "zz"
    (x,) = [c for _, c, _ in G.counted([a + b])]
    assert x.sum() > G.gram_counts([a[:1000]]).sum() * 100 and (x[0] - G.gram_counts([a])[0] >= -8).all()
