"""Diagnostic jobs on a scored table (G13–G16): error analysis, global and
groupwise bias correction, residual-quantile prediction intervals.

Inputs are DataFrames that already carry ``pred_log`` (from any model) plus
the log target and the original-unit value; outputs are DataFrames. Each job
computes its statistics (smearing factors, quantiles, decile edges) as small
aggregates first, and uses them as literals or a small join afterwards, so
the scored rows are never collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_lower, safe_expm1
from ..operators.stats import (ErrorTables, add_error_columns, calibration_table, coverage_expr, cut_points,
                               distinct_edges, error_tables, group_smearing, quantile_values, selected_quantiles,
                               smearing_factor_expr, top_n, values_of, variant_metrics)
from ..session import written


@dataclass
class ErrorAnalysis:
    """Parts of the error analysis (G16); each is computed when it is asked for."""

    err: DataFrame
    group_cols: list[str]
    key_cols: list[str]
    cols: list[str]
    top: int
    accuracy: int | None

    @cached_property
    def tables(self) -> ErrorTables:
        """Sums and quantiles of the summary, the breakdowns and the calibration."""
        return error_tables(self.err, self.group_cols, self.accuracy, pred="pred_eur")

    @property
    def summary(self) -> DataFrame:
        return self.tables.summary()

    @property
    def by_group(self) -> dict[str, DataFrame]:
        return {g: self.tables.by_group(g) for g in self.group_cols}

    @property
    def top_over(self) -> DataFrame:
        return top_n(self.err, "signed_err_eur", self.top, True, self.key_cols).select(*self.cols)

    @property
    def top_under(self) -> DataFrame:
        return top_n(self.err, "signed_err_eur", self.top, False, self.key_cols).select(*self.cols)

    @property
    def calibration(self) -> DataFrame:
        return calibration_table(self.err, "pred_eur", "actual_eur", edges=self.tables.edges())


@dataclass
class BiasCorrection:
    """A correction's factor(s) and corrected rows; metrics and calibration on demand."""

    factor: float
    err: DataFrame
    corrected: str
    label: str
    accuracy: int | None
    table: DataFrame | None = None

    @cached_property
    def quantiles(self) -> DataFrame:
        """Median errors before and after, and the decile edges of the corrected predictions."""
        error = lambda c: F.abs(F.col(c) - F.col("actual_eur"))
        return selected_quantiles(self.err, {
            "baseline": ([], error("pred_eur"), [0.5]), self.label: ([], error(self.corrected), [0.5]),
            "edges": ([], self.corrected, cut_points(10))}, self.accuracy)

    @property
    def comparison(self) -> DataFrame:
        medians = {k: (values_of(self.quantiles, k) or [None])[0] for k in ("baseline", self.label)}
        return variant_metrics(self.err, "actual_eur", {"baseline": "pred_eur", self.label: self.corrected}, medians=medians)

    @property
    def calibration(self) -> DataFrame:
        edges = distinct_edges(values_of(self.quantiles, "edges"))
        return calibration_table(self.err, self.corrected, "actual_eur", edges=edges)


def error_analysis(scored: DataFrame, *, actual: str, group_cols: list[str], key_cols: list[str],
                   keep_cols: list[str], top: int = 50, accuracy: int | None = None) -> ErrorAnalysis:
    """Error summary, per-group breakdowns, top over/under predictions, calibration."""
    err = add_error_columns(scored, "pred_log", actual)
    return ErrorAnalysis(err, group_cols, key_cols, keep_cols + ["actual_eur", "pred_eur", "signed_err_eur", "abs_err_eur"],
                         top, accuracy)


def smearing_factor(train_scored: DataFrame, actual_log: str = "target_log", pred_log: str = "pred_log") -> float:
    return float(train_scored.agg(smearing_factor_expr(actual_log, pred_log)).first()[0])


def global_bias_correction(train_scored: DataFrame, test_scored: DataFrame, *, actual: str,
                           actual_log: str = "target_log", accuracy: int | None = None) -> BiasCorrection:
    """pred × S with Duan's S from the training residuals; before/after metrics."""
    s = smearing_factor(train_scored, actual_log)
    err = add_error_columns(test_scored, "pred_log", actual).withColumn(
        "pred_eur_bc", clip_lower(F.col("pred_eur") * F.lit(s)))
    return BiasCorrection(s, err, "pred_eur_bc", "bias_corrected", accuracy)


def groupwise_bias_correction(train_scored: DataFrame, test_scored: DataFrame, *, group: str, actual: str,
                              actual_log: str = "target_log", accuracy: int | None = None) -> BiasCorrection:
    """pred × S_group with the global S as fallback; before/after metrics.

    The factor table has one row per group value and joins back with AQE
    choosing broadcast on its measured size. It is written: the last digits of a mean
    depend on the order its parts arrive in, and the statistics read the corrected rows
    more than once, so each read must find the same factors."""
    s = smearing_factor(train_scored, actual_log)
    table = written(group_smearing(train_scored, group, actual_log, "pred_log"), "factors")
    err = add_error_columns(test_scored, "pred_log", actual)
    err = err.join(table, on=group, how="left").withColumn(
        "smearing_factor", F.coalesce(F.col("smearing_factor"), F.lit(s)))
    err = err.withColumn("pred_eur_groupwise", clip_lower(F.col("pred_eur") * F.col("smearing_factor")))
    return BiasCorrection(s, err, "pred_eur_groupwise", "groupwise_bias_corrected", accuracy, table)


def prediction_intervals(train_scored: DataFrame, test_scored: DataFrame, *, actual: str,
                         actual_log: str = "target_log", low_q: float = 0.10, high_q: float = 0.90,
                         accuracy: int | None = None):
    """Residual-quantile interval: pred_log + q → expm1, clipped; coverage on test."""
    resid = train_scored.select((F.col(actual_log) - F.col("pred_log")).alias("resid_log"))
    q_low, q_med, q_high = quantile_values(resid, "resid_log", [low_q, 0.5, high_q], accuracy)
    rows = test_scored.withColumns({
        "pred_log_lower": F.col("pred_log") + F.lit(q_low),
        "pred_log_median": F.col("pred_log") + F.lit(q_med),
        "pred_log_upper": F.col("pred_log") + F.lit(q_high),
    }).withColumns({
        "pred_eur_lower": safe_expm1("pred_log_lower"),
        "pred_eur_median": safe_expm1("pred_log_median"),
        "pred_eur_upper": safe_expm1("pred_log_upper"),
        "actual_eur": clip_lower(actual),
    })
    summary = rows.agg(
        F.count(F.lit(1)).alias("n_test"),
        coverage_expr("actual_eur", "pred_eur_lower", "pred_eur_upper").alias("empirical_coverage"),
    ).withColumns({
        "q10": F.lit(q_low), "q50": F.lit(q_med), "q90": F.lit(q_high),
        "target_coverage": F.lit(round(high_q - low_q, 10)),
        "interval": F.lit(f"{int(round(low_q * 100))}-{int(round(high_q * 100))}"),
    })
    return (q_low, q_med, q_high), summary, rows
