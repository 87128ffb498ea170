"""Quantiles, quantile cuts, histograms and error statistics.

Quantile policy: ``accuracy=None`` computes exact, linearly interpolated
quantiles (same numbers as pandas / DuckDB ``quantile_cont``) in the one way of
:mod:`quantiles`, whatever the size; an integer ``accuracy`` asks for the
mergeable ``percentile_approx`` sketch instead.
Everything else here is a partial+final hash aggregate (map-side combine),
safe under key skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_lower, safe_expm1
from ..session import written
from .quantiles import Statistic, grouped_median, grouped_quantiles, join_on_keys, quantile_selection


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def quantile_expr(col, q: float | Sequence[float], accuracy: int | None = None) -> Column:
    """Exact (interpolated) or approximate quantile(s) aggregate expression."""
    x = _c(col).cast("double")
    x = F.when(~F.isnan(x), x)
    qs = F.array(*[F.lit(float(v)) for v in q]) if isinstance(q, (list, tuple)) else F.lit(float(q))
    if accuracy is None:
        return F.percentile(x, qs)
    return F.percentile_approx(x, qs, accuracy)


def quantile_values(df: DataFrame, col, qs: Sequence[float], accuracy: int | None = None) -> list[float]:
    """Global quantiles as Python floats, linear interpolation (pandas/DuckDB ``quantile_cont``).

    ``accuracy`` set → one ``percentile_approx`` pass; otherwise exact
    (:func:`grouped_quantiles` without keys). NULL quantiles where there are no values."""
    if accuracy is not None:
        row = df.agg(quantile_expr(col, list(qs), accuracy).alias("q")).first()
        return [float(v) if v is not None else None for v in (row["q"] or [None] * len(qs))]
    found = grouped_quantiles(df.select(_c(col).alias("__x")), [], "__x", list(qs)).collect()
    by = {r["qi"]: r["q"] for r in found}
    return [by.get(i) for i in range(len(qs))]


def global_median(df: DataFrame, col, accuracy: int | None = None) -> float | None:
    return quantile_values(df, col, [0.5], accuracy)[0]


def qcut_edges(df: DataFrame, col, q: int = 10, accuracy: int | None = None) -> list[float]:
    """Deduplicated quantile edges at 0, 1/q, …, 1 (pandas ``qcut`` with duplicates="drop")."""
    return distinct_edges(quantile_values(df, col, cut_points(q), accuracy))


def cut_points(q: int) -> list[float]:
    return [i / q for i in range(q + 1)]


def distinct_edges(edges: Sequence[float | None]) -> list[float]:
    """Ascending edges without NULLs and repeats."""
    return list(dict.fromkeys(e for e in edges if e is not None))


def qcut_bin(col, edges: Sequence[float]) -> Column:
    """Right-closed bin index for sorted unique edges; the minimum falls in bin 0."""
    x = _c(col).cast("double")
    if len(edges) < 2:
        return F.when(x.isNotNull(), F.lit(0))
    below = None
    for e in edges:
        term = (x > F.lit(float(e))).cast("int")
        below = term if below is None else below + term
    return F.when(x.isNotNull(), F.greatest(below - 1, F.lit(0)))


def quantile_cut(df: DataFrame, col: str, q: int = 10, out: str = "decile",
                 accuracy: int | None = None) -> DataFrame:
    """Add ``pd.qcut(x, q, labels=False, duplicates="drop")`` bins.

    Two passes: one aggregate for the ≤ q+1 edges (a literal list), then a
    per-row projection — no sort, no shuffle, unlike ``ntile`` which also
    splits ties differently."""
    edges = qcut_edges(df, col, q, accuracy)
    return df.withColumn(out, qcut_bin(col, edges))


def calibration_table(df: DataFrame, pred: str, actual: str, q: int = 10,
                      accuracy: int | None = None, edges: Sequence[float] | None = None) -> DataFrame:
    """Mean predicted, mean actual and n per prediction decile (D5), between given ``edges`` if any."""
    binned = quantile_cut(df, pred, q, "decile", accuracy) if edges is None else df.withColumn("decile", qcut_bin(pred, edges))
    return binned.where(F.col("decile").isNotNull()).groupBy("decile").agg(
        F.avg(pred).alias("pred_mean"),
        F.avg(actual).alias("actual_mean"),
        F.count(actual).alias("n"),
    )


def histogram(df: DataFrame, col: str, bins: int = 60) -> DataFrame:
    """Equal-width bin counts over [min, max] (D19); the max lands in the last bin."""
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    lo, hi = float(lo), float(hi)
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5  # numpy's rule for a constant input
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("int"), F.lit(bins - 1))
    return (
        df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width))
        .withColumn("bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width))
        .select("bin", "bin_lo", "bin_hi", "n")
    )


# ---------------------------------------------------------------------------
# Errors and metrics
# ---------------------------------------------------------------------------

def add_error_columns(df: DataFrame, pred_log: str = "pred_log", actual: str = "market_value_in_eur",
                      pred_out: str = "pred_eur", scale: Column | float | None = None) -> DataFrame:
    """pred_eur = clip(expm1(pred_log)), actual_eur = clip(actual), signed/abs error.

    ``scale`` multiplies the back-transformed prediction (smearing), clipped again."""
    pred = safe_expm1(pred_log)
    if scale is not None:
        pred = clip_lower(pred * (scale if isinstance(scale, Column) else F.lit(float(scale))))
    return df.withColumns({
        pred_out: pred,
        "actual_eur": clip_lower(actual),
    }).withColumns({
        "signed_err_eur": F.col(pred_out) - F.col("actual_eur"),
        "abs_err_eur": F.abs(F.col(pred_out) - F.col("actual_eur")),
    })



def selected_quantiles(df: DataFrame, wanted: Mapping[str, Statistic], accuracy: int | None = None) -> DataFrame:
    """(statistic, keys…, qi, q): exact, or by one sketch per group with ``accuracy``. Written
    once, since several tables read it."""
    if accuracy is None:
        return written(quantile_selection(df, wanted), "quantiles")
    keys = list(dict.fromkeys(k for own, _, _ in wanted.values() for k in own))
    parts = None
    for name, (own, value, qs) in wanted.items():
        one = df.groupBy(*own).agg(F.posexplode(quantile_expr(value, list(qs), accuracy)).alias("qi", "q"))
        given = [F.col(k) if k in own else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
        one = one.select(F.lit(name).alias("statistic"), *given, "qi", "q")
        parts = one if parts is None else parts.unionByName(one)
    return written(parts, "quantiles")


def values_of(selected: DataFrame, statistic: str) -> list[float]:
    """The quantiles of an ungrouped statistic, in order (empty if there was no row)."""
    rows = selected.where(F.col("statistic") == statistic).select("qi", "q").collect()
    return [r["q"] for r in sorted(rows, key=lambda r: r["qi"])]


ERROR_SUMS = {"n_rows": lambda: F.count(F.lit(1)), "mae": lambda: F.avg("abs_err_eur"), "mse": lambda: F.avg("signed_err_eur")}


@dataclass(frozen=True)
class ErrorTables:
    """Error summary (D4) and per-group breakdowns (D3) of scored rows, and the edges of
    prediction deciles (E3): one aggregate over all groupings and one quantile selection."""

    sums: DataFrame
    quantiles: DataFrame
    groups: tuple[str, ...]

    def summary(self) -> DataFrame:
        """n, MAE, median AE, mean signed error over all rows."""
        row = self.sums.where(F.col("grouping") == "").first()
        median = (values_of(self.quantiles, "summary") or [None])[0]
        return self.sums.sparkSession.createDataFrame(
            [(row["n_rows"] if row else 0, row["mae"] if row else None, median, row["mse"] if row else None)],
            "n_test_rows bigint, mae_eur double, median_abs_err_eur double, mean_signed_err_eur double")

    def by_group(self, group: str) -> DataFrame:
        """n (non-null actuals), MAE, median AE and mean signed error per group; a NULL group is kept."""
        sums = self.sums.where(F.col("grouping") == group).select(group, "n", F.col("mae").alias("mae_eur"), F.col("mse").alias("mean_signed_err"))
        medians = self.quantiles.where(F.col("statistic") == f"by {group}").select(group, F.col("q").alias("median_abs_err"))
        return join_on_keys(sums, medians, [group], "left").select(
            group, "n", "mae_eur", "median_abs_err", "mean_signed_err").orderBy(F.desc("mae_eur"), group)

    def edges(self) -> list[float]:
        return distinct_edges(values_of(self.quantiles, "edges"))


def error_tables(df: DataFrame, groups: Sequence[str] = (), accuracy: int | None = None, actual: str = "actual_eur",
                 pred: str | None = None, q: int = 10) -> ErrorTables:
    """:class:`ErrorTables` of rows with ``abs_err_eur`` and ``signed_err_eur``; with ``pred``
    also the edges of its quantile cut."""
    groups = tuple(groups)
    aggregates = [agg().alias(name) for name, agg in ERROR_SUMS.items()] + [F.count(actual).alias("n")]
    if groups:
        sets = df.groupingSets([[], *[[g] for g in groups]], *groups).agg(F.grouping_id().alias("__id"), *aggregates)
        # a set bit stands for a column that was summed over
        every = (1 << len(groups)) - 1
        name = F.when(F.col("__id") == every, "")
        for i, g in enumerate(groups):
            name = name.when(F.col("__id") == every - (1 << (len(groups) - 1 - i)), g)
        sums = written(sets.withColumn("grouping", name).drop("__id"), "error-sums")
    else:
        sums = written(df.agg(*aggregates).withColumn("grouping", F.lit("")), "error-sums")
    wanted: dict[str, Statistic] = {"summary": ([], "abs_err_eur", [0.5])}
    wanted |= {f"by {g}": ([g], "abs_err_eur", [0.5]) for g in groups}
    if pred is not None:
        wanted["edges"] = ([], pred, cut_points(q))
    return ErrorTables(sums, selected_quantiles(df, wanted, accuracy), groups)


def error_summary(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """n, MAE, median AE, mean signed error over all rows."""
    return error_tables(df.withColumn("actual_eur", F.lit(0)) if "actual_eur" not in df.columns else df, (), accuracy).summary()


def error_by_group(df: DataFrame, group: str, accuracy: int | None = None, actual: str = "actual_eur") -> DataFrame:
    """Per group: n (non-null actuals), MAE, median AE, mean signed error; NULL group kept (D3)."""
    return error_tables(df, [group], accuracy, actual).by_group(group)


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """RMSE and MAE in log space, MAE in original units via expm1 (no clip)."""
    d = F.col(pred) - F.col(y)
    return df.agg(
        F.sqrt(F.avg(d * d)).alias("rmse_log"),
        F.avg(F.abs(d)).alias("mae_log"),
        F.avg(F.abs(F.expm1(F.col(pred)) - F.expm1(F.col(y)))).alias("mae_eur"),
    )


def metrics_by_variant(df: DataFrame, y: str, variants: Mapping[str, str]) -> DataFrame:
    """:func:`regression_metrics` of several prediction columns, one row per ``variant``, in one pass."""
    pairs = F.array(*[F.struct(F.lit(k).alias("variant"), F.col(c).cast("double").alias("__p")) for k, c in variants.items()])
    long = df.select(F.col(y).alias("__y"), F.explode(pairs).alias("__s")).select("__y", "__s.*")
    d = F.col("__p") - F.col("__y")
    return long.groupBy("variant").agg(
        F.sqrt(F.avg(d * d)).alias("rmse_log"), F.avg(F.abs(d)).alias("mae_log"),
        F.avg(F.abs(F.expm1("__p") - F.expm1("__y"))).alias("mae_eur"))


def smearing_factor_expr(actual_log: str, pred_log: str) -> Column:
    """Duan smearing factor mean(exp(actual − pred))."""
    return F.avg(F.exp(F.col(actual_log) - F.col(pred_log)))


def group_smearing(df: DataFrame, group: str, actual_log: str, pred_log: str) -> DataFrame:
    """Smearing factor per group; NULL groups dropped as pandas groupby does."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        smearing_factor_expr(actual_log, pred_log).alias("smearing_factor"))


def coverage_expr(actual: str, lower: str, upper: str) -> Column:
    """Share of rows with lower <= actual <= upper."""
    inside = (F.col(actual) >= F.col(lower)) & (F.col(actual) <= F.col(upper))
    return F.avg(F.coalesce(inside, F.lit(False)).cast("double"))


def top_n(df: DataFrame, by: str, n: int = 50, descending: bool = True, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top-n rows by a column with an explicit tie-break (E6, E7) → TakeOrderedAndProject."""
    order = [F.desc(by) if descending else F.asc(by)] + [F.asc(t) for t in tiebreak]
    return df.orderBy(*order).limit(n)


def variant_metrics(df: DataFrame, actual: str, variants: dict[str, str], accuracy: int | None = None,
                    medians: Mapping[str, float] | None = None) -> DataFrame:
    """One metrics row per prediction variant from a single pass.

    The variants are stacked (one row per input row per variant, narrow) and aggregated
    together, instead of one job per variant. ``medians`` of the absolute errors may come
    from a selection that the caller has made."""
    names = list(variants)
    stack = "stack({n}, {body}) as (variant, pred)".format(
        n=len(names), body=", ".join(f"'{k}', `{variants[k]}`" for k in names))
    long = df.select(F.col(actual).alias("__a"), F.expr(stack))
    err = F.col("pred") - F.col("__a")
    sums = long.groupBy("variant").agg(F.count("__a").alias("n"), F.avg(F.abs(err)).alias("mae_eur"),
                                        F.avg(err).alias("mean_signed_err_eur"))
    if medians is None:
        med = grouped_median(long.select("variant", F.abs(err).alias("__e")), ["variant"], "__e", "median_abs_err_eur", accuracy)
    else:
        med = df.sparkSession.createDataFrame([(k, medians[k]) for k in names], "variant string, median_abs_err_eur double")
    return join_on_keys(sums, med, ["variant"], "left").select(
        "variant", "n", "mae_eur", "median_abs_err_eur", "mean_signed_err_eur")
