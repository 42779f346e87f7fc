"""Repeated lines across documents, as per-document bitmaps of the lines to keep.

Method: hashes of line keys are range-partitioned with a secondary sort by document and position; the first
holder of each key streams past and every later document's line is marked. What comes back is a bitmap
per document, not text. Only DataFrame functions are used.

Defined results: a missing or empty text is one empty line. Keys shorter than ``min_chars`` code points
never count. Documents without an ID count as one document that comes after all others. Rows with the same ID
are one document in the comparison and are cut row by row. Any other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.frames import with_rows

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _marked(rows: DataFrame, min_chars: int) -> DataFrame:
    """``row, pos`` of the lines to drop.

    A key may hold a third of all lines, so its documents are dealt into lanes: the first pass finds the first
    document of each key and lane, the second one the first document among the lanes.
    """
    lanes = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = rows.select("row", "doc_id", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = line.select("row", "doc_id", "pos", line_key(F.col("line")).alias("key")).where(
        F.length("key") >= min_chars
    )
    hashed = keyed.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(lanes)).cast("int").alias("lane"),
        "doc_id",
        "row",
        "pos",
    )
    by_document = [F.col("doc_id").asc_nulls_last(), F.col("row"), F.col("pos")]
    running = (Window.unboundedPreceding, Window.currentRow)
    in_lane = Window.partitionBy("h1", "h2", "lane").orderBy(*by_document).rowsBetween(*running)
    heads = hashed.repartitionByRange("h1", "lane").withColumn(
        "head", F.col("doc_id").eqNullSafe(F.first("doc_id").over(in_lane))
    )
    # Lines behind their lane's first document are settled; they stay in their lane.
    settled = heads.withColumn("lane", F.when(F.col("head"), -1).otherwise(F.col("lane")))
    over_lanes = Window.partitionBy("h1", "h2", "lane").orderBy(*by_document).rowsBetween(*running)
    first = settled.withColumn("owner", F.col("doc_id").eqNullSafe(F.first("doc_id").over(over_lanes)))
    return first.where(~F.col("head") | ~F.col("owner")).select("row", "pos")


def keep_bitmaps(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """``row, n_dropped, keep`` for each document that loses lines.

    ``keep`` lists ``(word, bits)`` for those stretches of 64 lines that lose any; bit ``i`` of ``bits`` is 1
    if line ``64 * word + i`` stays. Stretches and documents that are not listed stay whole. ``row`` is
    the hash of ID and text, as :func:`apply_bitmaps` computes it again.
    """
    marked = _marked(with_rows(docs, id_column, text_column), min_chars)
    words = marked.groupBy("row", F.expr("cast(pos div 64 as int)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("gone")
    )
    return words.groupBy("row").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
    )


# All words of a bitmap in order, so that a line's word is found by its place.
_DENSE = """
concat(
  flatten(transform(keep, (w, j) -> concat(
    array_repeat(-1L, w.word - if(j = 0, -1, get(keep, j - 1).word) - 1), array(w.bits)))),
  array_repeat(-1L, cast((size(lines) - 1) div 64 as int) - element_at(keep, -1).word))
"""
_KEPT = f"""
array_join(transform(array({_DENSE}), d ->
  array_join(filter(lines, (l, i) -> getbit(get(d, cast(i div 64 as int)), i % 64) = 1), '\n')), '')
"""


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``whole, text, n_lines, n_dropped``: each document as a struct of all its columns, and its kept text."""
    whole = docs.select(
        F.struct("*").alias("whole"),
        F.xxhash64(F.col(id_column).cast("long"), F.col(text_column)).alias("row"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    joined = whole.join(bitmaps, "row", "left").withColumn("lines", F.split("text", "\n", -1))
    return joined.select(
        "whole",
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.expr(_KEPT)).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """The documents with their columns, repeated lines cut from the text."""
    cut = apply_bitmaps(docs, keep_bitmaps(docs, id_column, text_column, min_chars), id_column, text_column)
    return cut.select(F.col("whole").withField(f"`{text_column}`", F.col("text")).alias("whole")).select("whole.*")
