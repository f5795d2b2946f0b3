"""Line dedup, in DataFrame functions only.

Line keys become (128-bit hash, document, position). A partial aggregate counts lines per hash, and only lines of repeated
hashes go on. These are range-partitioned by hash, those of very frequent hashes cut into slices by document, and streamed
with the last document first and positions in order: the first row of a hash is the occurrence that stays, and each new
document counts. What is returned is a sparse bitmap per document: the words of WORD lines that hold dropped lines, so
that no text moves. Texts are rebuilt from the bitmaps where they are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelode.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = 63
SLICE = 50_000  # lines of one hash that one sorted group holds, on average


def _folded(text: Column) -> Column:
    """A-Z lower-cased; lower() does the same for texts of single-byte characters and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def keys_of(text: Column) -> Column:
    return F.transform(lines_of(_folded(text.cast("string"))), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")))


def _text_hash(text: Column) -> Column:
    """Tells the texts of rows that repeat an id apart."""
    return F.xxhash64(text.cast("string"))


def dropped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, text_hash, bitmap): for each document and text that loses lines a map from word number to the bits of its dropped lines.

    Keys of at least ``min_chars`` characters that at least ``min_docs`` documents hold stay in the largest id only.
    Rows with a null id and null texts lose nothing; rows that repeat an id are one document as far as counts go.
    """
    lines = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), _text_hash(F.col(text_col)).alias("text_hash"), F.posexplode(keys_of(F.col(text_col))).alias("pos", "key"))
    lines = lines.where(F.char_length("key") >= min_chars)
    lines = common.stage(lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos"), "lines")
    seen = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {min_docs}")
    seen = common.stage(seen, "repeated")
    again = lines.join(common.small(seen), ["h1", "h2"])
    # A hash of very many lines is cut into slices by document; ranges of (hash, slice) are streamed with the last document first.
    again = common.stage(again.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / SLICE))).drop("n"), "again")
    ranged = again.repartitionByRange(common.partitions(docs.sparkSession), "h1", "h2", "slice")
    in_order = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc("doc_id"), "pos")
    first = ranged.withColumn("before", F.lag("doc_id").over(in_order)).where("before is null or before <> doc_id")
    first = first.groupBy("h1", "h2", "slice").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
    held = first.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last")).where(f"n >= {min_docs}").drop("n")
    held = common.stage(held, "held")
    out = again.join(common.small(held), ["h1", "h2"]).where("doc_id < last")
    bits = out.groupBy("doc_id", "text_hash", F.floor(F.col("pos") / WORD).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % WORD).cast("int"))).alias("bits"))
    return bits.groupBy("doc_id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bitmap"))


def with_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with the column ``_bitmap``, null where nothing is dropped."""
    maps = dropped(docs, id_col, text_col, **options).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_text_hash", "bitmap": "_bitmap"})
    return docs.join(maps, (F.col(id_col) == F.col("_doc")) & (_text_hash(F.col(text_col)) == F.col("_text_hash")), "left").drop("_doc", "_text_hash")


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines whose bit is not set, joined by line ends; a null text stays null, and one of only dropped lines is empty."""
    bit = lambda i: F.call_function("shiftright", F.coalesce(F.try_element_at(bitmap, F.floor(i / WORD).cast("int")), F.lit(0).cast("long")), (i % WORD).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return F.when(bitmap.isNull(), text).otherwise(F.array_join(F.filter(lines_of(text), lambda x, i: bit(i) == 0), "\n"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs with the text that is left; no row goes."""
    rows = with_bitmaps(docs, id_col, text_col, **options)
    return rows.withColumn(text_col, kept_text(F.col(text_col), F.col("_bitmap"))).drop("_bitmap")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256; null and empty texts are one empty line."""
    rows = with_bitmaps(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id", "text", **options)
    n_dropped = F.aggregate(F.map_values("_bitmap"), F.lit(0).cast("long"), lambda s, b: s + F.bit_count(b))
    return rows.select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(kept_text(F.col("text"), F.col("_bitmap")), F.lit("")), 256).alias("kept_sha256"),
    )
