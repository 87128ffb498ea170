"""Consolidated model report.

Inputs are the small diagnostic tables (one-row summaries and per-group
error tables). Ranking and flag logic are column expressions; the report
is assembled from at most a handful of aggregated rows, never from the
scored data itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import bias_direction, format_eur, format_pct
from ..sources.readers import read_artifact

# The reference's report wording.
COVERAGE_FLAGS = {
    "below": "Interval coverage is below target, so the uncertainty band is still a bit too optimistic.",
    "above": "Interval coverage is above target, which suggests the current band may be wider than necessary.",
    "close": "Interval coverage is close to target, which is a good sign for calibration.",
}
BIAS_FLAGS = {
    "underprediction": "Average signed error stays negative, so the model is still underpricing players overall.",
    "overprediction": "Average signed error stays positive, so the model is still overpricing players overall.",
    "roughly_unbiased": "Average signed error is reasonably balanced at the top level.",
}
POSITION_FLAG = "Highest position-level error is in {} profiles, so that subgroup deserves a closer look."
LEAGUE_FLAG = "League-level error is highest in {}, which is worth checking for sample or feature gaps."
LEAGUE_FALLBACK = ("League breakdown is not yet very informative because the current artifact is mostly "
                   "tagged as 'Unknown'.")
COVERAGE_TOLERANCE = 0.02


def top_group_risks(frame: DataFrame, group_col: str, top_n: int = 3, exclude_unknown: bool = False) -> DataFrame:
    """Top groups by (MAE desc, n desc); alternate column names accepted."""
    med = "median_abs_err_eur" if "median_abs_err_eur" in frame.columns else "median_abs_err"
    sig = "mean_signed_err_eur" if "mean_signed_err_eur" in frame.columns else "mean_signed_err"
    f = frame
    if exclude_unknown:
        f = f.where(F.lower(F.col(group_col).cast("string")) != "unknown")
    return f.orderBy(F.desc("mae_eur"), F.desc("n"), F.asc(group_col)).limit(top_n).select(
        F.col(group_col).cast("string").alias("group"), F.col("n").cast("bigint").alias("samples"),
        F.col("mae_eur").cast("double").alias("mae_eur"), F.col(med).cast("double").alias("median_abs_err_eur"),
        F.col(sig).cast("double").alias("mean_signed_err_eur"))


def coverage_gap_expr(empirical, target):
    return F.round(F.col(empirical) - F.col(target), 4)


def coverage_flag_expr(gap_col: str):
    g = F.col(gap_col)
    return (F.when(g <= -COVERAGE_TOLERANCE, F.lit(COVERAGE_FLAGS["below"]))
            .when(g >= COVERAGE_TOLERANCE, F.lit(COVERAGE_FLAGS["above"]))
            .otherwise(F.lit(COVERAGE_FLAGS["close"])))


def bias_flag_expr(direction_col: str):
    d = F.col(direction_col)
    expr = None
    for k, v in BIAS_FLAGS.items():
        expr = F.when(d == k, F.lit(v)) if expr is None else expr.when(d == k, F.lit(v))
    return expr


def report_overall(error_summary: DataFrame, interval_summary: DataFrame) -> DataFrame:
    """One row: overall metrics, bias direction, coverage gap and flags.

    Both inputs are one-row aggregates; their values enter as literals."""
    es = error_summary.first().asDict()
    iv = interval_summary.first().asDict()
    spark = error_summary.sparkSession
    row = spark.createDataFrame([(
        int(es["n_test_rows"]), str(es["cutoff_date"]), float(es["mae_eur"]), float(es["median_abs_err_eur"]),
        float(es["mean_signed_err_eur"]), str(iv["interval"]), float(iv["target_coverage"]),
        float(iv["empirical_coverage"]))],
        "n_test_rows bigint, cutoff_date string, mae_eur double, median_abs_err_eur double, "
        "mean_signed_err_eur double, interval string, target_coverage double, empirical_coverage double")
    return (row.withColumn("bias_direction", bias_direction("mean_signed_err_eur", "mae_eur"))
            .withColumn("coverage_gap", coverage_gap_expr("empirical_coverage", "target_coverage"))
            .withColumn("coverage_flag", coverage_flag_expr("coverage_gap"))
            .withColumn("bias_flag", bias_flag_expr("bias_direction")))


def risk_flags(overall_row: dict, position_risks: list[dict], league_risks: list[dict]) -> list[str]:
    """Ordered risk flag texts."""
    flags = [overall_row["coverage_flag"], overall_row["bias_flag"]]
    if position_risks:
        flags.append(POSITION_FLAG.format(position_risks[0]["group"]))
    flags.append(LEAGUE_FLAG.format(league_risks[0]["group"]) if league_risks else LEAGUE_FALLBACK)
    return flags


def build_report(spark: SparkSession, model_version: str, error_summary: DataFrame, interval_summary: DataFrame,
                 by_position: DataFrame, position_col: str, by_league: DataFrame, league_col: str,
                 generated_from: dict[str, str] | None = None) -> DataFrame:
    """Consolidated report as one nested row (H14): overall struct, top risks, flags and,
    where given, the artifacts it was made of."""
    overall = report_overall(error_summary, interval_summary)
    o = overall.first().asDict()
    pos = [r.asDict() for r in top_group_risks(by_position, position_col).collect()]
    lea = [r.asDict() for r in top_group_risks(by_league, league_col, exclude_unknown=True).collect()]
    flags = risk_flags(o, pos, lea)
    risk_t = "array<struct<group:string,samples:bigint,mae_eur:double,median_abs_err_eur:double,mean_signed_err_eur:double>>"
    overall_keys = ["n_test_rows", "cutoff_date", "mae_eur", "median_abs_err_eur", "mean_signed_err_eur",
                    "bias_direction", "interval", "target_coverage", "empirical_coverage", "coverage_gap"]
    schema = (f"model_version string, overall struct<n_test_rows:bigint,cutoff_date:string,mae_eur:double,"
              f"median_abs_err_eur:double,mean_signed_err_eur:double,bias_direction:string,interval:string,"
              f"target_coverage:double,empirical_coverage:double,coverage_gap:double>, "
              f"top_position_risks {risk_t}, top_league_risks {risk_t}, risk_flags array<string>, "
              f"generated_from map<string,string>")
    keys = ["group", "samples", "mae_eur", "median_abs_err_eur", "mean_signed_err_eur"]
    return spark.createDataFrame([(model_version, tuple(o[k] for k in overall_keys),
                                   [tuple(r[k] for k in keys) for r in pos],
                                   [tuple(r[k] for k in keys) for r in lea], flags, generated_from)], schema)


# Fixed names: artifact → its base name, followed by the model version.
ARTIFACTS = {
    "error_summary": "error_analysis_summary",
    "interval_summary": "prediction_interval_summary",
    "error_by_position": "error_by_position",
    "error_by_league": "error_by_league",
}


def report_from_artifacts(spark: SparkSession, artifacts_dir: str, version: str = "v3",
                          position_col: str = "position_bucket",
                          league_col: str = "domestic_competition_id") -> DataFrame:
    """The report of a model version from its written diagnostics (H14, A9); an absent
    artifact is an error that names it."""
    names = {k: f"{base}_{version}" for k, base in ARTIFACTS.items()}
    found = {k: read_artifact(spark, f"{artifacts_dir.rstrip('/')}/{n}", "json" if k.endswith("summary") else "csv")
             for k, n in names.items()}
    return build_report(spark, version, found["error_summary"], found["interval_summary"],
                        found["error_by_position"], position_col, found["error_by_league"], league_col, names)


def report_lines(report: DataFrame) -> DataFrame:
    """The report flattened to (section, position, label, value) rows in page order."""
    o = "overall"
    snapshot = F.array(
        F.struct(F.lit("Test rows").alias("label"), F.format_number(F.col(f"{o}.n_test_rows"), 0).alias("value")),
        F.struct(F.lit("Cutoff date").alias("label"), F.col(f"{o}.cutoff_date").alias("value")),
        F.struct(F.lit("MAE").alias("label"), format_eur(F.col(f"{o}.mae_eur")).alias("value")),
        F.struct(F.lit("Median absolute error").alias("label"),
                 format_eur(F.col(f"{o}.median_abs_err_eur")).alias("value")),
        F.struct(F.lit("Mean signed error").alias("label"),
                 F.concat(format_eur(F.col(f"{o}.mean_signed_err_eur")), F.lit(" ("),
                          F.col(f"{o}.bias_direction"), F.lit(")")).alias("value")),
        F.struct(F.lit("Interval coverage").alias("label"),
                 F.concat(format_pct(F.col(f"{o}.empirical_coverage")), F.lit(" vs target "),
                          format_pct(F.col(f"{o}.target_coverage"))).alias("value")),
    )

    def risks(col):
        return F.transform(col, lambda r: F.struct(r["group"].alias("label"), F.concat(
            F.lit("MAE "), format_eur(r["mae_eur"]), F.lit(" across "), r["samples"].cast("string"),
            F.lit(" rows")).alias("value")))
    flags = F.transform("risk_flags", lambda f: F.struct(F.lit("flag").alias("label"), f.alias("value")))
    sections = F.array(
        F.struct(F.lit("overall").alias("section"), snapshot.alias("items")),
        F.struct(F.lit("risk_flags").alias("section"), flags.alias("items")),
        F.struct(F.lit("positions").alias("section"), risks("top_position_risks").alias("items")),
        F.struct(F.lit("leagues").alias("section"), risks("top_league_risks").alias("items")),
    )
    return (report.select(F.explode(sections).alias("s"))
            .select(F.col("s.section").alias("section"), F.posexplode("s.items").alias("position", "item"))
            .select("section", "position", F.col("item.label").alias("label"), F.col("item.value").alias("value")))
