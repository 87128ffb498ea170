"""Exact quantiles of any number of statistics in one selection, one way at every size.

Spark's exact ``percentile`` / ``median`` keeps a value→count map per group and
merges it in one task. ``quantile_selection`` returns the same linearly
interpolated numbers (pandas ``quantile``, DuckDB ``quantile_cont``) for several
statistics (a column, its grouping and its quantiles each) at once, and holds
neither a group nor a bracket in one task:

1. rows become ``(statistic, group, value)``; per group, the row count and one
   ``percentile_approx`` sketch give a bracket around each wanted rank (rank error
   at most n / accuracy, bracket ± 3 n / accuracy);
2. values become cells with counts: each value inside a bracket is a cell, however
   often it occurs, and all values between two brackets are one, with the smallest
   and the largest of them;
3. cells are range-partitioned by statistic, group and value and written; running
   sums inside each partition, plus the totals of the partitions before it, are exact
   ranks, so a bracket can span any number of partitions;
4. the values at the two neighbouring ranks of each quantile are interpolated.

A missed bracket (against the sketch's guarantee) is an error, never a wrong
number. NULL and NaN values are ignored, as pandas does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

DEFAULT_ACCURACY = 10_000

#: (grouping columns, value column, quantiles) of a statistic.
Statistic = tuple[Sequence[str], "str | Column", Sequence[float]]


def _values(df: DataFrame, wanted: Mapping[str, Statistic], keys: Sequence[str]) -> DataFrame:
    """(statistic, keys…, __v): a row per row and statistic, NULL where a key isn't its own."""
    rows = []
    for name, (own, value, _) in wanted.items():
        v = (F.col(value) if isinstance(value, str) else value).cast("double")
        key = [(F.col(k) if k in own else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys]
        rows.append([F.lit(name).alias("statistic"), *key, F.when(~F.isnan(v), v).alias("__v")])
    if len(rows) == 1:
        return df.select(*rows[0])
    return df.select(F.explode(F.array(*[F.struct(*r) for r in rows])).alias("__s")).select("__s.*")


def quantile_selection(df: DataFrame, wanted: Mapping[str, Statistic], accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """(statistic, keys…, qi, q): quantile number ``qi`` of each statistic and group.

    ``keys`` are the grouping columns of all statistics, NULL in the rows of those that
    don't group by them. A NULL key is a group, a group without values has NULL
    quantiles, and a statistic without grouping has one row per quantile unless the
    input is empty."""
    keys = list(dict.fromkeys(k for own, _, _ in wanted.values() for k in own))
    group = ["statistic", *keys]
    eps = 3.0 / accuracy
    ps = sorted({float(q) for _, _, qs in wanted.values() for q in qs})
    bounds = [F.lit(min(1.0, max(0.0, p + side))) for p in ps for side in (-eps, eps)]
    values = _values(df, wanted, keys)
    # read twice: for the brackets and for the ranks
    stats = written(values.groupBy(*group).agg(
        F.count("__v").alias("__n"), F.percentile_approx("__v", F.array(*bounds), accuracy).alias("__b")), "brackets")
    v = F.col("__v")
    x = join_on_keys(values.where(v.isNotNull()), stats.select(*group, "__b"), group, "inner")
    spans = [(F.get("__b", F.lit(2 * i)), F.get("__b", F.lit(2 * i + 1))) for i in range(len(ps))]
    inside, passed = F.lit(False), F.lit(0)
    for low, high in spans:
        inside, passed = inside | v.between(low, high), passed + (v > high).cast("int")
    cells = (
        x.select(*group, "__v", F.when(inside, v).alias("__in"), passed.alias("__passed"))
        .groupBy(*group, "__passed", "__in")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    )
    ranged = written(cells.repartitionByRange(*group, "__min").withColumn("__pid", F.spark_partition_id()), "ranks")
    ahead = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy(*group, "__pid").agg(F.sum("__c").alias("__t"))
        .withColumn("__ahead", F.coalesce(F.sum("__t").over(ahead), F.lit(0))).drop("__t")
    )
    so_far = Window.partitionBy(*group, "__pid").orderBy("__min").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = ranged.withColumn("__upto", F.sum("__c").over(so_far))
    ranked = join_on_keys(running, totals, [*group, "__pid"], "inner").withColumn("__upto", F.col("__upto") + F.col("__ahead"))
    own = df.sparkSession.createDataFrame(
        [(name, i, float(q)) for name, (_, _, qs) in wanted.items() for i, q in enumerate(qs)], "statistic string, qi int, __p double")
    places = stats.select(*group, "__n").join(F.broadcast(own), "statistic").withColumn("__pos", F.col("__p") * (F.col("__n") - 1))
    places = places.withColumn("__r0", F.floor("__pos")).withColumn("__r1", F.least(F.col("__r0") + 1, F.col("__n") - 1)).drop("__p")
    at = join_on_keys(ranked, places.select(*group, "qi", "__r0", "__r1"), group, "inner")
    # of a cell between brackets only the first and the last value are known
    first, last = F.col("__upto") - F.col("__c"), F.col("__upto") - 1
    here = lambda r: F.when(F.col(r) == first, F.col("__min")).when(F.col(r) == last, F.col("__max")).when(
        F.col(r).between(first, last), F.col("__in"))
    picked = at.groupBy(*group, "qi").agg(F.max(here("__r0")).alias("__v0"), F.max(here("__r1")).alias("__v1"))
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    return join_on_keys(places, picked, [*group, "qi"], "left").select(*group, "qi", F.when(F.col("__n") == 0, F.lit(None)).when(
        F.col("__v0").isNull() | F.col("__v1").isNull(), missed).otherwise(
        F.col("__v0") + (F.col("__pos") - F.col("__r0")) * (F.col("__v1") - F.col("__v0"))).alias("q"))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float],
                      accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """(keys…, qi, q): the exact quantile ``qs[qi]`` of ``value`` per group."""
    return quantile_selection(df, {"one": (list(keys), value, list(qs))}, accuracy).drop("statistic")


def grouped_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, out: str = "q",
                     accuracy: int = DEFAULT_ACCURACY, approximate: bool = False) -> DataFrame:
    """(keys…, out): one quantile per group; ``approximate=True`` is the sketch alone (one pass)."""
    keys = list(keys)
    if approximate:
        x = F.col(value).cast("double")
        return df.groupBy(*keys).agg(F.percentile_approx(F.when(~F.isnan(x), x), float(q), accuracy).alias(out))
    return grouped_quantiles(df, keys, value, [q], accuracy).select(*keys, F.col("q").alias(out))


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` treating NULL keys as equal (a NULL group is a group)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                   accuracy: int | None = None) -> DataFrame:
    """Exact (or, with ``accuracy``, sketch) median per group, NULL groups kept."""
    if accuracy is not None:
        return grouped_quantile(df, keys, value, 0.5, out, accuracy, approximate=True)
    return grouped_quantile(df, keys, value, 0.5, out)
