"""Token counts of documents in flat token files, by a scan for end-of-document ids.

A token file holds ids one after another, with an end id after each document
and no index.  Files are cut into blocks; in each block all end ids are found in
one vector comparison.  A running maximum over a file's blocks (one small row
each) gives where the document open at a block's start began, and a running sum
gives its number, so documents that cross blocks get their full counts.

Cases: a text that holds the end mark itself is encoded as ordinary text, so it
stays one document; a text of more than 1 GB of ids cannot be read back; an empty
document counts 0; ids after the last end id are one more
document, marked not ended; an empty file has no documents; for files written
from a table, null text is an empty document, and repeated rows and order stay
as in the table's partitions; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covenant.session import scratch_path, small_batches

from .common import sliced, stage, tidied
from .tokens import VOCABULARY, encoding

#: Bytes of an id, and the id that ends a document.
WIDTH, END = 2, 50256
BLOCK_TOKENS, FILE_DOCUMENTS, FILE_BYTES = 1 << 20, 20_000, 1 << 30


def write_token_files(docs: DataFrame, path: str, end: int = END, width: int = WIDTH, vocabulary: str = VOCABULARY) -> None:
    """Flat files of little-endian ids: Spark's text writer with the end id's bytes as line separator.

    A text has no more ids than bytes, so the longest text says how many documents
    stay below FILE_BYTES in a file.
    """
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0
    per_file = max(1, min(FILE_DOCUMENTS, FILE_BYTES // (width * (longest + 1))))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding(vocabulary) as made:
            for b in sliced(batches):
                ids = [np.frombuffer(made.ordinary(t or ""), "<u4").astype(f"<u{width}").tobytes() for t in b.column("text").to_pylist()]
                yield pa.record_batch([pa.array(ids, pa.binary())], names=["ids"])

    ids = docs.select("text").mapInArrow(tidied(tokenise), "ids binary")
    separator = end.to_bytes(width, "little").decode("latin-1")
    options = {"lineSep": separator, "encoding": "ISO-8859-1", "maxRecordsPerFile": per_file}
    ids.select(F.col("ids").cast("string").alias("value")).write.options(**options).text(path)


def scan(spark, path: str, end: int = END, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, doc, start, tokens, ended) of every document in the files below ``path``; positions count ids."""
    size = block_tokens * width
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block"), "content")
    blocks = blocks.select("path", (F.col("length") / width).cast("long").alias("total"), "block", F.expr(f"substring(content, cast(block * {size} + 1 as int), {size})").alias("ids"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [np.flatnonzero(np.frombuffer(x.as_buffer(), f"<u{width}") == end) for x in b.column("ids")]
            yield pa.record_batch([b.column("path"), b.column("total"), b.column("block"), pa.array(ends, pa.list_(pa.int32()))], names=["path", "total", "block", "ends"])

    found = stage(blocks.mapInArrow(find, "path string, total long, block long, ends array<int>"), "separators")

    at = F.col("block") * block_tokens
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = F.when(F.size("ends") > 0, at + F.element_at("ends", -1) + 1)
    carried = found.withColumn("open", F.coalesce(F.max(after).over(before), F.lit(0).cast("long")))
    carried = carried.withColumn("base", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0).cast("long")))
    each = carried.select("path", "block", "open", "base", "ends", F.posexplode("ends").alias("k", "e"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(at + F.get("ends", F.col("k") - 1) + 1)
    ended = each.select("path", (F.col("base") + F.col("k")).alias("doc"), start.alias("start"), (at + F.col("e") - start).alias("tokens"), F.lit(True).alias("ended"))
    last = found.groupBy("path", "total").agg(F.coalesce(F.max(after), F.lit(0).cast("long")).alias("start"), F.sum(F.size("ends")).alias("doc"))
    rest = last.where("start < total").select("path", "doc", "start", (F.col("total") - F.col("start")).alias("tokens"), F.lit(False).alias("ended"))
    return ended.union(rest)


def op3(spark, sf_dir: str) -> DataFrame:
    """Documents to flat token files, then the scan: one row for each document by file, in file order."""
    small_batches(spark)
    path = scratch_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    part = lambda i: F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", i).cast("int")
    return scan(spark, path).select(part(1).alias("part"), part(2).alias("file"), "doc", "start", "tokens")
