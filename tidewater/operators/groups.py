"""Per-group performance with a dimension lookup.

The reference's club-performance notebook, parameterised by column names:
games played (non-null game ids), goals for / against, wins and win rate per
group; names from a dimension table patched with known-missing keys; keys
still absent from the dimension reported with an anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import percent, try_int


def clean_games(df: DataFrame, keys: Sequence[str], count_cols: Sequence[str]) -> DataFrame:
    """Drop rows with missing keys; missing counts → 0, cast to int."""
    out = df.na.drop(subset=list(keys))
    return out.withColumns({c: try_int(c, 0) for c in count_cols})


def group_performance(games: DataFrame, group: str, game_id: str, goals_for: str, goals_against: str,
                      win: str) -> DataFrame:
    """games, goals scored/conceded, wins and win rate (%) per group."""
    return games.groupBy(group).agg(
        F.count(game_id).alias("games_played"),
        F.sum(goals_for).alias("goals_scored"),
        F.sum(goals_against).alias("goals_conceded"),
        F.sum(win).alias("wins"),
    ).withColumn("win_rate", percent("wins", "games_played"))


def patched_dimension(dim: DataFrame, key: str, name: str, patch_keys: Sequence[int],
                      label: str = "Club {}") -> DataFrame:
    """Dimension ∪ generated rows for known-missing keys."""
    spark = dim.sparkSession
    patch = spark.createDataFrame([(int(k),) for k in patch_keys], f"{key} bigint").withColumn(
        name, F.concat(F.lit(label.split("{}")[0]), F.col(key).cast("string"),
                       F.lit(label.split("{}")[1] if "{}" in label else "")))
    base = dim.select(try_int(key, dtype="bigint").alias(key), F.col(name).cast("string").alias(name))
    return base.unionByName(patch)


def attach_names(perf: DataFrame, dim: DataFrame, key: str, name: str, missing: str = "Unknown Club") -> DataFrame:
    """Left lookup of the group name; unmatched → constant label."""
    return perf.join(dim.select(key, name), on=key, how="left").withColumn(
        name, F.coalesce(F.col(name), F.lit(missing)))


def missing_keys(perf: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys without a dimension row."""
    return perf.select(key).distinct().join(dim.select(key), on=key, how="left_anti")
