"""Time-based train/test split.

The reference sorts the whole table and takes the date at row
``int(n · train_frac)``. Here the same row is found without a global sort:
count rows per calendar day (a partial+final aggregate, one row per distinct
day), run a cumulative sum over that small day table, and take the first day
whose cumulative count exceeds the target rank. For time-of-day columns a
second pass resolves the exact value inside that day only. The cutoff is
then a literal, so ``date < cutoff`` / ``date >= cutoff`` are pushed into the
Parquet scan of every consumer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written


def _pick(counts: DataFrame, key: str, rank: int):
    """On a small (bucket, n) table: the bucket holding ``rank`` and the rows before it."""
    w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = counts.withColumn("__cum", F.sum("__n").over(w)).where(F.col("__cum") > rank).orderBy(key).first()
    if hit is None:
        raise ValueError(f"rank {rank} is beyond the table size")
    return hit[key], hit["__cum"] - hit["__n"]


def value_at_rank(df: DataFrame, col: str, rank: int):
    """Value of ``col`` at 0-based position ``rank`` in ascending order (NULLs excluded).

    Coarse-to-fine: count rows per day (a table of distinct days), pick the
    day holding the rank, then — for time-of-day columns only — per hour,
    minute and second inside that day, and the exact value inside that
    second. Every step aggregates with map-side combine and every table a
    window runs over is bounded (days, 24, 60, 60, values in one second),
    so no task ever sorts a large share of the data."""
    dtype = df.schema[col].dataType
    x = df.where(F.col(col).isNotNull())
    if isinstance(dtype, T.DateType):
        day, _ = _pick(x.groupBy(F.col(col).alias("__k")).agg(F.count(F.lit(1)).alias("__n")), "__k", rank)
        return day
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"value_at_rank expects a date or timestamp column, got {dtype}")
    levels = [F.to_date(F.col(col)), F.date_trunc("hour", F.col(col)), F.date_trunc("minute", F.col(col)),
              F.date_trunc("second", F.col(col)), F.col(col)]
    remaining = rank
    for i, level in enumerate(levels):
        counts = x.groupBy(level.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        key, before = _pick(counts, "__k", remaining)
        remaining -= before
        if i == len(levels) - 1:
            return key
        x = x.where(level == F.lit(key))
    raise AssertionError("unreachable")


def time_cutoff(df: DataFrame, date_col: str, train_frac: float = 0.8):
    """Cutoff = value at index int(n · train_frac) of the date-sorted table (E5).

    For a date column this is one job: the per-day count table carries both
    the running sum and the total, and the target rank is derived from the
    total inside the same plan (``floor(total · frac)`` in double arithmetic,
    as Python's ``int(n * frac)``)."""
    x = df.where(F.col(date_col).isNotNull())
    if isinstance(df.schema[date_col].dataType, T.DateType):
        per_day = x.groupBy(F.col(date_col).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
        w = Window.orderBy("__d")
        ranked = per_day.withColumns({
            "__cum": F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "__tot": F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        })
        k = F.least(F.floor(F.col("__tot").cast("double") * F.lit(float(train_frac))), F.col("__tot") - 1)
        hit = ranked.where(F.col("__cum") > k).orderBy("__d").select("__d").first()
        if hit is None:
            raise ValueError("cannot split an empty table")
        return hit["__d"]
    n = x.count()
    if n == 0:
        raise ValueError("cannot split an empty table")
    return value_at_rank(x, date_col, min(int(n * train_frac), n - 1))


SPLIT_SCHEMA = "side string, n bigint, date_min date, date_max date"


def split_summary(df: DataFrame, date_col: str, train_frac: float = 0.8) -> tuple[dt.date, DataFrame]:
    """(cutoff, :func:`split_stats`) of a date column from one aggregate by day: where to cut,
    and rows and dates of both sides, without a scan for each (E5, D17)."""
    if not isinstance(df.schema[date_col].dataType, T.DateType):
        raise TypeError(f"{date_col} must be a date")
    per_day = df.where(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    # windows over a table of distinct days
    w = Window.orderBy("__d")
    upto = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    k = F.least(F.floor(total.cast("double") * F.lit(float(train_frac))), total - 1)
    side = F.when(upto > k, "test").otherwise("train")
    sides = per_day.withColumn("side", side).groupBy("side").agg(
        F.sum("__n").alias("n"), F.min("__d").alias("date_min"), F.max("__d").alias("date_max")).collect()
    cutoff = next((r["date_min"] for r in sides if r["side"] == "test"), None)
    if cutoff is None:
        raise ValueError("cannot split an empty table")
    return cutoff, df.sparkSession.createDataFrame([tuple(r) for r in sides], SPLIT_SCHEMA)


def time_split(df: DataFrame, date_col: str, train_frac: float = 0.8, cutoff=None, raw_col: str | None = None):
    """(train, test, cutoff): train is ``date < cutoff``, test ``date >= cutoff``.

    All rows of the cutoff date go to the test side, so train is < train_frac.
    ``raw_col`` names the stored timestamp the date was derived from: the
    same bound is then also stated on it (``ts < cutoff 00:00``), a predicate
    Parquet can take as a pushed filter (a ``to_date(ts)`` predicate cannot)."""
    if cutoff is None:
        cutoff = time_cutoff(df, date_col, train_frac)
    lit = F.lit(cutoff)
    train, test = df.where(F.col(date_col) < lit), df.where(F.col(date_col) >= lit)
    if raw_col is not None and isinstance(cutoff, dt.date) and not isinstance(cutoff, dt.datetime):
        dtype = df.schema[raw_col].dataType
        bound = dt.datetime(cutoff.year, cutoff.month, cutoff.day)
        kind = "TIMESTAMP_NTZ" if isinstance(dtype, T.TimestampNTZType) else "TIMESTAMP"
        b = F.expr(f"{kind}'{bound:%Y-%m-%d %H:%M:%S}'")
        train, test = train.where(F.col(raw_col) < b), test.where(F.col(raw_col) >= b)
    return train, test, cutoff



def split_stats(df: DataFrame, date_col: str, cutoff) -> DataFrame:
    """Rows and date range of each side."""
    side = F.when(F.col(date_col) < F.lit(cutoff), F.lit("train")).otherwise(F.lit("test"))
    return df.where(F.col(date_col).isNotNull()).groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(date_col).alias("date_min"),
        F.max(date_col).alias("date_max"),
    )


def iso_date(value) -> str:
    if isinstance(value, dt.datetime):
        return value.date().isoformat()
    return value.isoformat()


def with_row_id(df: DataFrame, order: Sequence[str], out: str = "row_id") -> DataFrame:
    """Surrogate row ids 0, 1, 2, … in the order of ``order`` (E2), without a global sort in
    one task: rows are range-partitioned on the order and written with their partition's
    number; each partition numbers its own rows, and adds the rows of those before it.

    NULLs come first. ``order`` should be unique: rows that tie lie in one partition and get
    their ids in any order."""
    by = [F.col(c) for c in order]
    ranged = written(df.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), "row-ids")
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # one row a partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*by)) - 1
    return (ranged.withColumn("__place", place).join(sizes, "__part")
            .withColumn(out, F.col("__before") + F.col("__place")).drop("__part", "__place", "__before"))
