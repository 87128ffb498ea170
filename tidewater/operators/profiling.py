"""Table profiling and sparse-column removal.

All per-column statistics come from ONE aggregation pass over the table
(``count`` + one ``sum(isNull)`` per column), unpivoted afterwards on the
one-row result — never a job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_stats(df: DataFrame) -> DataFrame:
    """(column, null_count, null_ratio, n_rows) for every column, one pass; NaN counts
    as missing (D9, D10). A table without columns gives no rows."""
    missing = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        missing.append(c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c.isNull())
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.sum(m.cast("bigint")).alias(f"__n{i}") for i, m in enumerate(missing)])
    each = [F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("null_count")) for i, c in enumerate(df.columns)]
    empty = F.array().cast("array<struct<column:string,null_count:bigint>>")
    return one.select(F.col("__rows").alias("n_rows"), F.inline(F.array(*each) if each else empty)).select(
        "column", F.coalesce(F.col("null_count"), F.lit(0)).alias("null_count"),
        F.try_divide(F.col("null_count").cast("double"), F.col("n_rows").cast("double")).alias("null_ratio"),
        "n_rows")


def null_fraction_top(df: DataFrame, k: int = 10, digits: int = 3) -> DataFrame:
    """Top-k null fractions, ranked on the exact ratio (ties by column name), then rounded."""
    top = null_stats(df).orderBy(F.desc("null_ratio"), F.asc("column")).limit(k)
    return top.select("column", F.round("null_ratio", digits).alias("null_pct"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with at least one NULL, most first."""
    return null_stats(df).where(F.col("null_count") > 0).select("column", "null_count").orderBy(
        F.desc("null_count"), F.asc("column"))


def sparse_columns(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """Columns whose NULL ratio is strictly above ``threshold``."""
    return [r["column"] for r in null_stats(df).where(F.col("null_ratio") > threshold).collect()]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def table_shape(df: DataFrame, name: str) -> DataFrame:
    """(table, rows, cols)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("cols"))


def profile_tables(spark: SparkSession, tables: dict[str, DataFrame] | Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Shape of many tables as one long DataFrame."""
    items = tables.items() if isinstance(tables, dict) else tables
    out = None
    for name, df in items:
        s = table_shape(df, name)
        out = s if out is None else out.unionByName(s)
    return out
