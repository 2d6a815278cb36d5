"""Landing of malformed lines, and positions in bytes."""

from pyspark.sql import functions as F

from covenant.session import scratch_path
from covenant.sources.files import RESCUED_FIELDS, RESCUED_KIND, RESCUED_LINE, read_delimited, read_fixed_width

COLS = [{"name": c} for c in "abc"]


def landed(spark, lines, **options):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = read_delimited(spark, path, COLS, options, lineage=False, rescue=True)
    return [(r.a, r.b, r.c, r[RESCUED_KIND], r[RESCUED_FIELDS], r[RESCUED_LINE]) for r in df.collect()]


def test_short_long_broken_and_sound_lines(spark):
    lines = ["1,2,3", "1,2", "1,2,3,4,5", '"x,y",2,3', '"x,y",2,3,"4,5"', '1,"2,3', ",,", "1,2,3,"]
    got = landed(spark, lines)
    assert [g[3] for g in got] == [None, "short", "long", None, "long", "broken", None, "long"]
    assert got[0] == ("1", "2", "3", None, None, None) and got[1] == ("1", "2", None, "short", None, "1,2")
    assert got[2][4] == ["4", "5"] and got[4][4] == ['"4,5"'] and got[7][4] == [""]
    assert got[3][0] == "x,y" and [g[5] for g in got if g[3]] == [x for x, g in zip(lines, got) if g[3]]


def test_options_decide_what_a_field_is(spark):
    assert [g[3:5] for g in landed(spark, ["1|2|3|4", "1|2"], delimiter="|")] == [("long", ["4"]), ("short", None)]
    assert [g[3:5] for g in landed(spark, ["1;'2;2';3;4", "1;2;3"], sep=";", quote="'")] == [("long", ["4"]), (None, None)]
    assert [g[3] for g in landed(spark, ["a,b,c", "1,2"], header="true")] == ["short"]


def test_without_rescue_the_columns_are_as_before(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("1,2",), ("1,2,3,4",)], "value string").coalesce(1).write.text(path)
    assert [tuple(r) for r in read_delimited(spark, path, COLS, lineage=False).collect()] == [("1", "2", None), ("1", "2", "3")]


def test_byte_positions_of_several_encodings(spark):
    fields = [{"name": "n", "start": 1, "length": 6, "trim": True}, {"name": "k", "start": 7, "length": 3, "cast": "int"}]
    for charset, text in (("UTF-8", "éà"), ("ISO-8859-1", "éàçñ"), ("UTF-8", "日本")):
        path = scratch_path(spark, "bytes")
        line = F.concat(F.substring(F.concat(F.encode(F.lit(text), charset), F.encode(F.lit(" " * 6), charset)), 1, 6), F.encode(F.lit("042"), charset))
        spark.range(1).select(line.cast("string").alias("value")).write.text(path)
        r = read_fixed_width(spark, path, fields, lineage=False, charset=charset).first()
        assert (r.n, r.k, r["_line_length"]) == (text, 42, 9)
    path = scratch_path(spark, "bytes")
    spark.range(1).select(F.concat(F.encode(F.lit("aaaaaé"), "UTF-8"), F.encode(F.lit("42"), "UTF-8")).cast("string").alias("value")).write.text(path)
    cut = read_fixed_width(spark, path, [{"name": "n", "start": 1, "length": 6}, {"name": "k", "start": 8, "length": 2, "cast": "int"}], lineage=False, charset="UTF-8").first()
    assert cut.n is None and cut.k == 42  # a field that ends inside a character is no text
