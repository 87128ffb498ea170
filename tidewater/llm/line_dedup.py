"""Line deduplication by a range-partitioned sort of line hashes (native).

Every line's key is hashed; the occurrences ``(hash, document, position)`` are
range-partitioned by hash and sorted by document and position inside each
partition, so that a window streams over a line's occurrences with the first
one (in the largest document) in front. The result is a compressed bitmap per
document, never its text.

A hash is dealt out together with a bucket of the document id. A line that
stands in a third of all documents therefore fills many ranges; its buckets are
counted where they lie and only one count and one id per bucket travel on.
Occurrences and repeated lines are written tables: texts are read once for each,
and the join of the two can split a line that fills a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: The characters stripped at both ends, and the letters lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Ranges that one line's occurrences can be split into.
BUCKETS = 256


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. ``lower`` is the faster function and
    the same one where every character is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """Positions of all lines long enough, with a 128-bit hash of their keys.
    ``row_key`` tells apart different texts that repeat a document id."""
    key = line_key(F.col("line"))
    lines = docs.select("doc_id", F.xxhash64("text").alias("row_key"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return (
        lines.where(F.char_length("line") >= min_chars)
        .withColumn("line", key)
        .where(F.char_length("line") >= min_chars)
        .select(
            F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"),
            F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).alias("bucket"), "doc_id", "row_key", "pos",
        )
    )


def _runs(positions: Column) -> Column:
    """Ascending positions as runs ``(start, length)``."""
    spots = F.sequence(F.lit(0), F.size(positions) - 1)
    starts = F.filter(spots, lambda i: (i == 0) | (F.get(positions, i) != F.get(positions, i - 1) + 1))
    ends = F.filter(spots, lambda i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) != F.get(positions, i) + 1))
    return F.zip_with(
        starts, ends, lambda a, b: F.struct(F.get(positions, a).alias("start"), (b - a + 1).alias("length")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Which lines of each document to drop, as run-length coded bitmaps.

    A key of at least ``min_chars`` code points that stands in at least
    ``min_docs`` documents keeps only its lines in the largest ``doc_id``.
    Returns ``doc_id, row_key, dropped`` for documents that lose lines;
    ``dropped`` is an array of runs ``(start, length)`` of 0-based positions, the
    zero runs of the keep bitmap.

    Null or empty text is one empty line. A null ``doc_id`` counts as one document
    before all others. Rows that repeat a ``doc_id`` count as one document; each
    row's lines are judged on their own text. An empty table gives no rows. Other
    columns are not read.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ranged = written(_occurrences(source, min_chars), "lines").repartitionByRange("h1", "h2", "bucket")
    stream = Window.partitionBy("h1", "h2", "bucket").orderBy(F.desc("doc_id"), "pos")
    before = F.lag("doc_id").over(stream)
    fresh = (F.row_number().over(stream) == 1) | ~before.eqNullSafe(F.col("doc_id"))
    per_bucket = (
        ranged.withColumn("fresh", fresh.cast("int")).groupBy("h1", "h2", "bucket")
        .agg(F.sum("fresh").alias("docs"), F.max("doc_id").alias("last_doc"))
    )
    repeated = written(
        per_bucket.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"))
        .where(F.col("docs") >= min_docs).select("h1", "h2", "last_doc"),
        "repeated-lines",
    )
    lost = (
        ranged.join(repeated, ["h1", "h2"])
        .where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last_doc")))
    )
    return (
        lost.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("pos")).alias("positions"))
        .select("doc_id", "row_key", _runs(F.col("positions")).alias("dropped"))
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text, dropped``: one row per row of ``docs``."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    source = source.withColumn("row_key", F.xxhash64("text")).alias("s")
    marks = bitmaps.alias("b")
    joined = source.join(marks, F.col("s.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("s.row_key") == F.col("b.row_key")), "left")
    lines = F.split(F.col("s.text"), "\n", -1)
    gone = F.flatten(F.transform("dropped", lambda r: F.sequence(r["start"], r["start"] + r["length"] - 1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    # bound as an array's one element: a function of each kept position would split the text each time
    once = F.array(F.struct(lines.alias("lines"), stay.alias("stay")))
    joined_lines = F.transform(once, lambda e: F.array_join(F.transform(e["stay"], lambda i: F.get(e["lines"], i)), "\n"))
    kept = F.when(F.col("dropped").isNull(), F.col("s.text")).otherwise(F.get(joined_lines, F.lit(0)))
    n_lines = F.char_length("s.text") - F.char_length(F.replace(F.col("s.text"), F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        F.col("s.doc_id").alias("doc_id"), n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("dropped", F.lit(0), lambda total, r: total + r["length"]), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"), "dropped",
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`keep_bitmaps` applied to ``docs`` by :func:`apply_bitmaps`."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs, doc_id, text), doc_id, text)
