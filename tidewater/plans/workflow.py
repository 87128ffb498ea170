"""End-to-end jobs on the reference's own table layout.

Column names default to the reference's (players, player_valuations,
appearances, club_games, clubs); every step is a DataFrame-in /
DataFrame-out function, and ``run_workflow`` chains them in one
SparkSession, writing the artifacts the reference writes (feature tables,
metrics, breakdowns, model, report). The feature table is written once and
read back, so the training and diagnostic jobs start from a materialised
table (cut lineage, restartable) instead of recomputing the lookback.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import keyword_bucket, log_target, safe_date
from ..operators.baselines import add_age_bin, median_tables, predict_group_median
from ..operators.cleaning import (POSITION_RULES, add_age_at_anchor, clean_entities, default_numeric, drop_missing,
                                  entity_base, keep_positive)
from ..operators.features import add_rate_features, apply_collapse, fit_top_categories, select_feature_group
from ..operators.groups import attach_names, clean_games, group_performance, missing_keys, patched_dimension
from ..operators.lookback import lookback_aggregate
from ..operators.model import RidgeModel, column_roles, fit_gram, top_coefficients
from ..operators.profiling import null_fraction_top, table_shape
from ..operators.report import report_from_artifacts, report_lines
from ..operators.split import iso_date, split_summary, time_split
from ..operators.stats import metrics_by_variant
from ..sources.manifest import Steps
from ..sources.readers import (discover_tables, read_artifact, read_csv_typed, require_columns, table_name,
                               version_tag)
from ..session import folder_stamp, release_scratch, scratch_mark, written
from ..sources.sinks import save_model, write_summary, write_table
from .diagnostics import error_analysis, global_bias_correction, groupwise_bias_correction, prediction_intervals

# The reference's table layouts and model settings.
RAW_TYPES = {
    "players": {"player_id": "bigint", "height_in_cm": "double", "date_of_birth": "date"},
    "player_valuations": {"player_id": "bigint", "date": "date", "market_value_in_eur": "double",
                          "current_club_id": "bigint"},
    "appearances": {"player_id": "bigint", "date": "date", "minutes_played": "double", "goals": "double",
                    "assists": "double", "yellow_cards": "double", "red_cards": "double"},
    "club_games": {"game_id": "bigint", "club_id": "bigint", "opponent_id": "bigint", "own_goals": "double",
                   "opponent_goals": "double", "is_win": "int"},
    "clubs": {"club_id": "bigint"},
}
APPEARANCE_TOTALS = ["minutes_played", "goals", "assists", "yellow_cards", "red_cards"]
WINDOWS = {"w180": 180, "w365": 365}
COLLAPSE_V3 = {"country_of_birth": 40, "country_of_citizenship": 40, "player_club_domestic_competition_id": 60}
LEAKAGE_COLUMNS = ["player_id", "market_value_in_eur", "date_of_birth", "date"]
TARGET = "target_log"
GROUP_COL = "player_club_domestic_competition_id"
ABLATIONS = ["full", "no_nationality", "no_context", "performance_only"]
KNOWN_MISSING_CLUBS = [1, 2, 7, 4506871, 4506872, 4506873]


def load_raw(spark: SparkSession, raw_dir: str, infer: bool = False) -> dict[str, DataFrame]:
    """Every CSV in the raw folder, typed with ``try_cast`` (A1, A3). Columns without a stated
    type stay text; ``infer`` reads every table once more to find theirs."""
    out = {}
    for path in discover_tables(spark, raw_dir, ".csv"):
        name = table_name(path, ".csv")
        out[name] = read_csv_typed(spark, path, RAW_TYPES.get(name), infer=infer)
    return out


PROFILE_SCHEMA = "table string, rows bigint, cols int, column string, null_pct double, error string"


def profile_raw(spark: SparkSession, raw_dir: str, sample_rows: int | None = None) -> DataFrame:
    """(table, rows, cols, column, null_pct) for each CSV, over whole tables unless
    ``sample_rows`` asks for the first rows. Each table is profiled by itself: one
    that can't be read is a row with its error, and the others go on. A folder
    without tables gives no rows (L5, A2, A3, D9, D11)."""
    rows = []
    for path in discover_tables(spark, raw_dir, ".csv"):
        name = table_name(path, ".csv")
        try:
            df = read_csv_typed(spark, path)
            if sample_rows:
                df = df.limit(sample_rows)
            shape = table_shape(df, name).first()
            top = null_fraction_top(df, 10, 3).collect()  # ten rows at most
            rows += [(name, shape["rows"], shape["cols"], r["column"], r["null_pct"], None) for r in top]
        except Exception as exc:  # noqa: BLE001 - per-table failure is reported, not fatal
            rows.append((name, None, None, None, None, str(exc)[:500]))
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


# ---------------------------------------------------------------------------
# L1: feature versions
# ---------------------------------------------------------------------------

def anchor_rows(players: DataFrame, valuations: DataFrame) -> DataFrame:
    """Valid anchors ⟕ entity base with the age filter: the row set of every feature version."""
    require_columns(valuations, ["player_id", "date", "market_value_in_eur"], "valuations")
    vals = valuations.withColumn("date", safe_date("date"))
    vals = drop_missing(vals, ["player_id", "date", "market_value_in_eur"])
    vals = keep_positive(vals, "market_value_in_eur")
    df = vals.join(entity_base(players), "player_id", "left")
    return add_age_at_anchor(df, "date", "date_of_birth", "age")


def build_features_v1(players: DataFrame, valuations: DataFrame, appearances: DataFrame,
                      anchors: DataFrame | None = None) -> DataFrame:
    """Anchors ⟕ entity base, age at anchor, 180/365-day lookback totals, log target."""
    df = anchors if anchors is not None else anchor_rows(players, valuations)
    apps = drop_missing(appearances.withColumn("date", safe_date("date")), ["player_id", "date"])
    apps = default_numeric(apps, APPEARANCE_TOTALS)          # absent / unparsable totals count as 0 (B18)
    df = lookback_aggregate(df, apps, entity="player_id", anchor_time="date", measures={m: m for m in APPEARANCE_TOTALS},
                            windows=WINDOWS, count_name="games_played")
    return df.withColumn(TARGET, log_target("market_value_in_eur"))


def build_features(players: DataFrame, valuations: DataFrame, appearances: DataFrame,
                   version: str = "v3", collapse: dict[str, int] | None = None, first: DataFrame | None = None) -> DataFrame:
    """v1 → v2 (rate columns) → v3 (rare categories collapsed); stops at ``version``.

    The v3 keep-lists count the anchor rows before the lookback (the lookback
    keeps rows 1:1), so fitting them never recomputes the window plan. ``first`` is the v1
    table where it has been written already: later versions start from it."""
    anchors = anchor_rows(players, valuations) if first is None else first
    df = build_features_v1(players, valuations, appearances, anchors) if first is None else first
    if version == "v1":
        return df
    df = add_rate_features(df, list(WINDOWS))
    if version == "v2":
        return df
    specs = {c: k for c, k in (collapse or COLLAPSE_V3).items() if c in anchors.columns}
    return apply_collapse(df, fit_top_categories(anchors, specs)) if specs else df


# ---------------------------------------------------------------------------
# Training with ablations and baselines
# ---------------------------------------------------------------------------

@dataclass
class TrainingResult:
    cutoff: object
    model: RidgeModel
    metrics: DataFrame
    ablation: DataFrame
    top_coefficients: DataFrame
    train: DataFrame
    test: DataFrame


#: Fixed names of the model's inputs beside the window columns (w180_…, w365_…).
MODEL_INPUTS = ["age", "height_in_cm", "current_club_id", "position", "sub_position", "foot", "height_bucket", "country_of_birth",
                "country_of_citizenship", "player_club_domestic_competition_id"]


def model_inputs(features: DataFrame, date_col: str = "date") -> list[str]:
    """The stated inputs that the table has, in its order (G5); any other column, ids
    among them, is no input."""
    stated = set(MODEL_INPUTS)
    prefixes = tuple(f"{w}_" for w in WINDOWS)
    return [c for c in features.columns if c != date_col and c not in LEAKAGE_COLUMNS and (c in stated or c.startswith(prefixes))]


def train(spark: SparkSession, features: DataFrame, *, date_col: str = "date", alpha: float = 1.0,
          train_frac: float = 0.8, position_col: str = "position", age_col: str = "age") -> TrainingResult:
    """Time split, four ablation fits on the same split, full model,
    coefficients, global and position × age median baselines (G10–G12, G17)."""
    feats = features.where(F.col(TARGET).isNotNull())
    # cutoff, rows and dates of both sides from one aggregate by day
    cutoff, sides_table = split_summary(feats.withColumn(date_col, F.to_date(date_col)), date_col, train_frac)
    train_df, test_df, _ = time_split(feats, date_col, cutoff=cutoff)
    inputs = model_inputs(feats, date_col)
    numeric, categorical = column_roles(feats.select(*inputs))
    # one Gram matrix serves all fits, and one pass over the test side all metrics
    gram = fit_gram(train_df, TARGET, numeric, categorical)
    groups = {mode: select_feature_group(inputs, mode) for mode in ABLATIONS}
    models = {mode: gram.solve(cols, alpha) for mode, cols in groups.items()}
    full = models["full"]
    medians, overall = median_tables(add_age_bin(train_df, age_col), TARGET, [position_col, "age_bin"])
    scored = full.predict_all(test_df, {f"__pred_{mode}": m for mode, m in models.items()})
    scored = predict_group_median(add_age_bin(scored, age_col), medians, [position_col, "age_bin"], overall, "__pred_group")
    variants = {mode: f"__pred_{mode}" for mode in ABLATIONS}
    variants |= {"baseline_global_median": "__pred_all", "baseline_position_age": "__pred_group"}
    found = written(metrics_by_variant(scored.withColumn("__pred_all", F.lit(overall)), TARGET, variants), "metrics")
    sizes = F.create_map(*[F.lit(x) for mode, cols in groups.items() for x in (mode, len(cols))])
    rows = found.where(F.col("variant").isin(ABLATIONS)).select(
        F.col("variant").alias("experiment"), sizes[F.col("variant")].alias("n_features_input"), "rmse_log", "mae_log", "mae_eur")
    # rows and dates of both sides, on every metrics row
    sides = {r["side"]: r for r in sides_table.collect()}
    split_cols = [F.lit(sides[s][k] if s in sides else None).alias(f"{s}_{k}" if k != "n" else f"n_{s}")
                  for s in ("train", "test") for k in ("n", "date_min", "date_max")]
    names = {"baseline_global_median": "baseline_global_median", "baseline_position_age": "baseline_position_age", "full": "ridge_model_full"}
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    metrics = found.where(F.col("variant").isin(list(names))).select(
        label[F.col("variant")].alias("model"), "rmse_log", "mae_log", "mae_eur", *split_cols)
    return TrainingResult(cutoff, full, metrics, rows.orderBy("rmse_log"), top_coefficients(full, spark, 25),
                          train_df, test_df)


def default_group(df: DataFrame, columns: Sequence[str], value: str = "Unknown") -> DataFrame:
    """Group columns that a table doesn't have, as one group."""
    absent = {c: F.lit(value) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


# ---------------------------------------------------------------------------
# Group performance (club games notebook)
# ---------------------------------------------------------------------------

def club_performance(games: DataFrame, clubs: DataFrame, patch_keys: Sequence[int] = KNOWN_MISSING_CLUBS,
                     top: int = 10):
    """(performance, top by win rate with names, keys still missing)."""
    g = clean_games(games, ["club_id", "opponent_id"], ["own_goals", "opponent_goals"])
    perf = group_performance(g, "club_id", "game_id", "own_goals", "opponent_goals", "is_win")
    dim = patched_dimension(clubs, "club_id", "name", patch_keys)
    named = attach_names(perf, dim, "club_id", "name")
    top_df = named.orderBy(F.desc("win_rate"), F.asc("club_id")).limit(top)
    return perf, top_df, missing_keys(perf, dim, "club_id")


# ---------------------------------------------------------------------------
# L3: every step in order
# ---------------------------------------------------------------------------

def run_workflow(spark: SparkSession, raw_dir: str, out_dir: str, version: str = "v3",
                 missing: str = "pipeline") -> dict[str, str]:
    """Build features → train → error analysis → bias corrections →
    intervals → report, writing every artifact under ``out_dir``.

    ``missing="zero"`` reproduces the reference's diagnostics, which zero-fill
    inputs before predicting (§8.2); the default uses the fitted imputation.

    Each step leaves a manifest with the stamp of its inputs (files, version, ``missing``).
    A run after a failure skips the steps that are done and goes on behind them; scratch
    tables of this run are deleted at its end."""
    return run_steps(spark, raw_dir, out_dir, version, missing)[0]


def run_steps(spark: SparkSession, raw_dir: str, out_dir: str, version: str = "v3",
              missing: str = "pipeline") -> tuple[dict[str, str], list[str]]:
    """:func:`run_workflow`'s paths, and the names of the steps that this call ran."""
    out = out_dir.rstrip("/")
    steps = Steps(spark, f"{out}/_steps", f"{folder_stamp(spark, raw_dir)}-{version}-{missing}")
    mark = scratch_mark(spark)
    try:
        return _all_steps(spark, steps, raw_dir, out, version, missing), steps.ran
    finally:
        release_scratch(spark, mark)


def _all_steps(spark: SparkSession, steps: Steps, raw_dir: str, out: str, version: str, missing: str) -> dict[str, str]:
    paths: dict[str, str] = {}
    raw = cache(lambda: load_raw(spark, raw_dir))
    art = f"{out}/artifacts"

    def features() -> dict[str, str]:
        feats = build_features(raw()["players"], raw()["player_valuations"], raw()["appearances"], version)
        return {"features": write_table(feats, f"{out}/features/version={version}")}
    paths |= steps.run("features", features)
    feats = spark.read.parquet(paths["features"])          # materialised: later steps start here
    tag = version_tag(paths["features"])

    def training() -> dict[str, str]:
        res = train(spark, feats)
        return {
            "model": save_model(res.model, f"{art}/ridge_model_{tag}"),
            "metrics": write_summary(res.metrics.withColumn("cutoff_date", F.lit(iso_date(res.cutoff))), f"{art}/metrics_{tag}"),
            "ablation": write_table(res.ablation, f"{art}/ablation_{tag}", "csv"),
            "top_coefficients": write_table(res.top_coefficients, f"{art}/ridge_top_coefficients_{tag}", "csv"),
        }
    paths |= steps.run("training", training)

    # both sides scored once: every diagnostic below runs several passes over these two
    def scoring() -> dict[str, str]:
        model = RidgeModel.load(paths["model"])
        rows = feats.where(F.col(TARGET).isNotNull())
        cutoff = dt.date.fromisoformat(read_artifact(spark, paths["metrics"], "lines").first()["cutoff_date"])
        train_rows, test_rows, _ = time_split(rows, "date", cutoff=cutoff)
        test_scored = default_group(model.predict(test_rows, missing=missing), ["position", "domestic_competition_id"])
        test_scored = test_scored.withColumn("position_bucket", keyword_bucket("position", POSITION_RULES))
        return {"scored_train": write_table(model.predict(train_rows, missing=missing), f"{out}/scored/side=train"),
                "scored_test": write_table(test_scored, f"{out}/scored/side=test")}
    paths |= steps.run("scoring", scoring)
    scored_train, scored_test = spark.read.parquet(paths["scored_train"]), spark.read.parquet(paths["scored_test"])
    cutoff = read_artifact(spark, paths["metrics"], "lines").first()["cutoff_date"]

    def errors() -> dict[str, str]:
        ea = error_analysis(scored_test, actual="market_value_in_eur",
                            group_cols=["position_bucket", "domestic_competition_id"], key_cols=["player_id", "date"],
                            keep_cols=["date", "player_id", "position", "domestic_competition_id"])
        found = {"error_summary": write_summary(ea.summary.withColumn("cutoff_date", F.lit(cutoff)), f"{art}/error_analysis_summary_{tag}")}
        for g, df in ea.by_group.items():
            short = "position" if g == "position_bucket" else "league"
            found[f"error_by_{short}"] = write_table(df, f"{art}/error_by_{short}_{tag}", "csv")
        found["top_over"] = write_table(ea.top_over, f"{art}/top_overpredictions_{tag}", "csv")
        found["top_under"] = write_table(ea.top_under, f"{art}/top_underpredictions_{tag}", "csv")
        found["calibration"] = write_table(ea.calibration.orderBy("decile"), f"{art}/calibration_deciles_{tag}", "csv")
        return found
    paths |= steps.run("errors", errors)

    def bias() -> dict[str, str]:
        bc = global_bias_correction(scored_train, scored_test, actual="market_value_in_eur")
        found = {
            "bias_comparison": write_table(bc.comparison.withColumn("smearing_factor", F.lit(bc.factor)), f"{art}/error_analysis_bias_comparison_{tag}", "csv"),
            "calibration_bc": write_table(bc.calibration.orderBy("decile"), f"{art}/calibration_deciles_bias_corrected_{tag}", "csv")}
        if GROUP_COL in scored_train.columns:
            gw = groupwise_bias_correction(scored_train, scored_test, group=GROUP_COL, actual="market_value_in_eur")
            found["groupwise_smearing"] = write_table(gw.table, f"{art}/groupwise_smearing_{tag}", "csv")
            found["groupwise_comparison"] = write_table(gw.comparison.withColumn("global_fallback_smearing", F.lit(gw.factor)),
                                                        f"{art}/error_analysis_groupwise_comparison_{tag}", "csv")
            found["calibration_groupwise"] = write_table(gw.calibration.orderBy("decile"), f"{art}/calibration_deciles_groupwise_{tag}", "csv")
        return found
    paths |= steps.run("bias", bias)

    def intervals() -> dict[str, str]:
        _, summary, rows = prediction_intervals(scored_train, scored_test, actual="market_value_in_eur")
        keep = [c for c in ["date", "player_id", "pred_eur_lower", "pred_eur_median", "pred_eur_upper", "actual_eur"] if c in rows.columns]
        return {"interval_rows": write_table(rows.select(*keep), f"{art}/prediction_intervals_{tag}", "csv"),
                "interval_summary": write_summary(summary.withColumn("model_version", F.lit(tag)), f"{art}/prediction_interval_summary_{tag}")}
    paths |= steps.run("intervals", intervals)

    def report() -> dict[str, str]:
        # from the written artifacts, so that it can be made again without the scored rows
        made = report_from_artifacts(spark, art, tag)
        return {"report": write_summary(made, f"{art}/model_report_{tag}"),
                "report_lines": write_table(report_lines(made), f"{art}/model_report_lines_{tag}", "csv")}
    paths |= steps.run("report", report)

    def tables() -> dict[str, str]:
        found = {}
        if "club_games" in raw() and "clubs" in raw():
            cleaned = clean_games(raw()["club_games"], ["club_id", "opponent_id"], ["own_goals", "opponent_goals"])
            found["club_games_clean"] = write_table(cleaned, f"{out}/processed/club_games_clean", "csv")
            perf, top10, miss = club_performance(raw()["club_games"], raw()["clubs"])
            found["club_performance"] = write_table(perf, f"{art}/club_performance", "csv")
            found["club_top10"] = write_table(top10, f"{art}/club_top10_win_rate", "csv")
            found["club_missing_ids"] = write_table(miss, f"{art}/club_missing_ids", "csv")
        if "players" in raw():
            found["players_clean"] = write_table(clean_entities(raw()["players"]), f"{out}/processed/players_clean")
        return found
    return paths | steps.run("tables", tables)
