"""Median baselines.

The per-group median table has one row per (group keys × bin) — bounded by
the categorical cardinality, not by the data — and is attached with a plain
left join: AQE measures the materialised table at run time and turns the
join into a broadcast hash join when it is small (a checked size), keeping
a shuffle join beyond the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fixed_bins
from .stats import quantile_values, selected_quantiles, values_of

# Fixed value: the reference's age bin edges (left-closed).
AGE_BIN_EDGES = [0, 18, 21, 24, 27, 30, 35, 100]


def global_median(df: DataFrame, target: str, accuracy: int | None = None) -> float:
    """Training-side median of the target (D7) as a literal."""
    return float(quantile_values(df, target, [0.5], accuracy)[0])


def median_tables(train: DataFrame, target: str, keys: Sequence[str], accuracy: int | None = None,
                  out: str = "pred_log") -> tuple[DataFrame, float | None]:
    """(median target per group, median of all rows) from one selection. Rows with a NULL
    key belong to no group, as in pandas groupby (D6), but to all rows (D7)."""
    found = selected_quantiles(train, {"all": ([], target, [0.5]), "group": (list(keys), target, [0.5])}, accuracy)
    known = F.col("statistic") == "group"
    for k in keys:
        known = known & F.col(k).isNotNull()
    every = values_of(found, "all")
    return found.where(known).select(*keys, F.col("q").alias(out)), every[0] if every else None


def group_medians(train: DataFrame, target: str, keys: Sequence[str], accuracy: int | None = None,
                  out: str = "pred_log") -> DataFrame:
    """Median target per group; NULL keys dropped as pandas groupby does."""
    return median_tables(train, target, keys, accuracy, out)[0]


def add_age_bin(df: DataFrame, age: str = "age", edges: Sequence[float] = AGE_BIN_EDGES,
                out: str = "age_bin") -> DataFrame:
    """Left-closed fixed-edge bin index; outside → NULL."""
    return df.withColumn(out, fixed_bins(age, edges))


def predict_group_median(df: DataFrame, medians: DataFrame, keys: Sequence[str], fallback: float,
                         out: str = "pred_log") -> DataFrame:
    """Attach the group median, falling back to the global median."""
    value = next(c for c in medians.columns if c not in keys)
    joined = df.join(medians.withColumnRenamed(value, "__gm"), on=list(keys), how="left")
    return joined.withColumn(out, F.coalesce(F.col("__gm"), F.lit(float(fallback)))).drop("__gm")


def fit_predict_group_median(train: DataFrame, score: DataFrame, target: str, keys: Sequence[str],
                             accuracy: int | None = None, out: str = "pred_log") -> DataFrame:
    medians, fallback = median_tables(train, target, keys, accuracy, out)
    return predict_group_median(score, medians, keys, fallback, out)
