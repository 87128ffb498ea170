"""Shards of bounded size by extendible hashing.

A directory is indexed by the leading bits of a hash. Only a bucket whose rows
exceed the byte limit is split, on one bit more, until every bucket fits. Sums
per bucket are taken from a written table of ``(row, hash, bytes)``: per cell of
a few bits first, then for all shorter prefixes of these cells, so that a level
costs one aggregation of cells and not of rows. Rows in buckets still too large
go on with more bits.

The hash is MD5 of the id (128 bits). Where rows share all of them (repeated
ids), MD5 of the row's number in the written table provides further bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Bits added each time that some bucket is still too large.
STEP_BITS = 8


def hash_bits(value: Column) -> Column:
    """MD5 as 128 characters 0 or 1."""
    digits = F.md5(value.cast("string").cast("binary"))
    return F.concat(*[F.lpad(F.conv(F.substring(digits, at, 8), 16, 2), 32, "0") for at in (1, 9, 17, 25)])


def _leaves(cells: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """``cell, shard`` for cells of ``depth`` bits in a bucket that fits: the
    shortest prefix of more than ``base`` bits (or of ``base``, at 0) whose rows
    have ``limit`` bytes at most."""
    first = 0 if base == 0 else base + 1
    prefixes = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(first), F.lit(depth))).alias("bits"))
    prefixes = prefixes.withColumn("prefix", F.expr("substring(cell, 1, bits)"))
    fits = prefixes.groupBy("bits", "prefix").agg(F.sum("bytes").alias("total")).where(F.col("total") <= limit)
    return (
        prefixes.join(fits.select("bits", "prefix"), ["bits", "prefix"])
        .groupBy("cell").agg(F.min_by("prefix", "bits").alias("shard"))
    )


def assign_shards(docs: DataFrame, byte_limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, shard, depth, n_bytes, oversize``: one row per row of ``docs``.

    ``shard`` is the bucket's prefix of hash bits (empty: one bucket has all), and
    ``depth`` its length. A row's size is its text's UTF-8 bytes. No shard exceeds
    ``byte_limit`` but those of a single row that is larger by itself; such rows
    get a shard of their own, ``x`` and the row's number, and ``oversize`` is true.
    Null text has 0 bytes, a null id hashes as the empty string. Rows that repeat
    an id share a shard unless together they exceed the limit; then they are split
    by row number, behind a ``-``. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
            F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("n_bytes"),
        ),
        "shard-rows",
    )
    total, oversize = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.max((F.col("n_bytes") > byte_limit).cast("int")), F.lit(0))).first()
    done = []
    if oversize:
        large = rows.where(F.col("n_bytes") > byte_limit)
        done.append(large.select("doc_id", F.concat(F.lit("x"), F.col("row").cast("string")).alias("shard"), F.lit(0).alias("depth"), "n_bytes", F.lit(True).alias("oversize")))
    open_rows = rows.where(F.col("n_bytes") <= byte_limit)
    open_rows = open_rows.withColumn("bits", hash_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    base, depth, behind = 0, max(2, math.ceil(math.log2(max(1, total / byte_limit))) + 3), ""
    while True:
        with_cell = open_rows.withColumn("cell", F.substring("bits", 1, depth))
        cells = with_cell.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"))
        leaves = written(_leaves(cells, base, depth, byte_limit), "shard-cells")
        placed = with_cell.join(leaves, "cell").withColumn("at", F.instr("shard", "-"))
        done.append(placed.select(
            "doc_id", "shard", F.when(F.col("at") > 0, F.length("shard") - 1).otherwise(F.length("shard")).cast("int").alias("depth"),
            "n_bytes", F.lit(False).alias("oversize")))
        left = with_cell.join(leaves, "cell", "left_anti").drop("cell")
        if not left.limit(1).count():
            break
        if not behind and depth >= 128:
            behind = "-"
            left = left.withColumn("bits", F.concat("bits", F.lit("-"), hash_bits(F.col("row"))))
        open_rows = written(left, "shard-open")
        base, depth = depth, min(depth + STEP_BITS, 257) if behind else min(depth + STEP_BITS, 128)
        if behind and base >= 257:
            raise RuntimeError("two rows have the same number")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result
