"""Batch (and streaming) scoring of request rows.

The reference validates and scores one JSON record per HTTP call; here the
same rules are column expressions over a whole table of requests, so a
million requests are one projection. Everything is stream-safe (no actions),
which is what lets the streaming job reuse it unchanged (J1).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import (confidence_note, format_eur, strip_ws, uncertainty_level, valuation_band)
from ..sources.readers import request_schema
from .features import add_rate_features

# The reference's validation groups and messages.
STAT_GROUPS = [
    ("Games played", ["games_played"]),
    ("Minutes played", ["minutes_played"]),
    ("Goals and assists", ["goals", "assists"]),
    ("Cards", ["yellow_cards", "red_cards"]),
]
AGE_LIMITS = (16.0, 50.0)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def validation_errors(df: DataFrame, *, age: str = "age", age_limits=AGE_LIMITS,
                      windows: Sequence[str] = ("w180", "w365"), position: str = "position",
                      group: str = "player_club_domestic_competition_id") -> Column:
    """array<struct<field, message>> of rule violations, one entry per failing field (H1)."""
    lo, hi = age_limits
    a = F.col(age).cast("double")
    checks = [F.when(~_finite(a), F.struct(F.lit(age).alias("field"),
                                           F.lit("Age must be a finite number").alias("message")))
              .when(~a.between(lo, hi), F.struct(F.lit(age).alias("field"),
                                                 F.lit(f"Age must be between {_num(lo)} and {_num(hi)}")
                                                 .alias("message")))]
    for w in windows:
        for label, stats in STAT_GROUPS:
            for s in stats:
                name = f"{w}_{s}"
                x = F.col(name).cast("double")
                checks.append(
                    F.when(~_finite(x), F.struct(F.lit(name).alias("field"),
                                                 F.lit(f"{label} must be a finite number").alias("message")))
                    .when(x < 0, F.struct(F.lit(name).alias("field"),
                                          F.lit(f"{label} cannot be negative").alias("message"))))
    for col, label in ((position, "Position"), (group, "Competition ID")):
        txt = F.col(col).cast("string")
        checks.append(F.when(txt.isNull() | (strip_ws(txt) == ""),
                             F.struct(F.lit(col).alias("field"),
                                      F.lit(f"{label} must be a non-empty string").alias("message"))))
    return F.array_compact(F.array(*checks))


def _num(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


def validate_requests(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) request frames; labels of valid rows are stripped (H1)."""
    position = kw.get("position", "position")
    group = kw.get("group", "player_club_domestic_competition_id")
    checked = df.withColumn("errors", validation_errors(df, **kw))
    valid = checked.where(F.size("errors") == 0).drop("errors").withColumns(
        {position: strip_ws(position), group: strip_ws(group)})
    rejected = checked.where(F.size("errors") > 0)
    return valid, rejected


def rejection_rows(rejected: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row per (request, field, message) (H2)."""
    keys = [key] if isinstance(key, str) else list(key)
    return rejected.select(*keys, F.explode("errors").alias("e")).select(*keys, "e.field", "e.message")


def scoring_frame(df: DataFrame, windows: Sequence[str] = ("w180", "w365"),
                  absent_numeric: Sequence[str] = ("current_club_id", "height_in_cm"),
                  absent_text: Sequence[str] = ("height_bucket", "country_of_birth", "country_of_citizenship",
                                                "sub_position", "foot"),
                  missing: str = "pipeline") -> DataFrame:
    """Model-ready rows: rate features for both windows (÷0 → 0) and the model inputs
    that requests don't carry (H3). These are NULL, for the fitted pipeline to impute;
    with ``missing="zero"``, as the reference fills them, 0 and the empty text, which
    is a category of its own."""
    if missing not in ("pipeline", "zero"):
        raise ValueError(f"missing must be 'pipeline' or 'zero', not {missing!r}")
    out = add_rate_features(df, windows)
    zero = missing == "zero"
    extra = {c: F.lit(0.0 if zero else None).cast("double") for c in absent_numeric if c not in out.columns}
    extra.update({c: F.lit("" if zero else None).cast("string") for c in absent_text if c not in out.columns})
    return out.withColumns(extra)


def point_and_interval(df: DataFrame, q_low: float, q_high: float, pred_log: str = "pred_log",
                       link: str = "exp") -> DataFrame:
    """Point value and interval in original units; bounds sorted; non-finite → error text (H4).

    ``link="exp"`` follows the scoring path of the reference; ``"expm1"`` is
    the exact inverse of the log1p target (§8.3)."""
    inv = F.exp if link == "exp" else F.expm1
    p = F.col(pred_log)
    lo, hi = inv(p + F.lit(q_low)), inv(p + F.lit(q_high))
    out = df.withColumns({
        "predicted_value_eur": inv(p),
        "ci_lower": F.least(lo, hi),
        "ci_upper": F.greatest(lo, hi),
    })
    ok = _finite(p) & _finite(F.col("predicted_value_eur")) & _finite(F.col("ci_lower")) & _finite(F.col("ci_upper"))
    return out.withColumn("score_error", F.when(~_finite(p), F.lit("Model returned an invalid prediction"))
                          .when(~ok, F.lit("Prediction interval could not be computed")))


def scout_columns(df: DataFrame, coverage_label: str, value: str = "predicted_value_eur",
                  lower: str = "ci_lower", upper: str = "ci_upper") -> DataFrame:
    """Band, uncertainty level, note and the summary sentence."""
    out = df.withColumns({
        "valuation_band": valuation_band(value),
        "uncertainty_level": uncertainty_level(value, lower, upper),
    })
    out = out.withColumn("confidence_note", confidence_note("uncertainty_level"))
    summary = F.concat(
        F.lit("Estimated market value is "), format_eur(value, by_magnitude=False),
        F.lit(f" with a {coverage_label} interval from "), format_eur(lower, by_magnitude=False),
        F.lit(" to "), format_eur(upper, by_magnitude=False),
        F.lit(". This sits in the '"), F.col("valuation_band"), F.lit("' tier with "),
        F.col("uncertainty_level"), F.lit(" uncertainty."))
    out = out.withColumn("summary", summary)
    if "top_positive" in out.columns:
        out = out.withColumns({"key_positives": F.transform("top_positive", lambda e: e["feature"]),
                               "key_risks": F.transform("top_negative", lambda e: e["feature"])})
    return out


def coverage_label(low_level: float, high_level: float) -> str:
    """Interval label from the quantile levels, e.g. 0.1/0.9 → "80%" (the reference hard-codes "90%", §8.4)."""
    return f"{int(round((high_level - low_level) * 100))}%"


@dataclass
class Readiness:
    status: str
    reason: str | None = None
    detail: str | None = None


def assert_ready(model, q_low: float | None, q_high: float | None, coverage: float | None,
                 sample: DataFrame | None = None) -> Readiness:
    """Readiness check before a scoring job: model present, quantiles finite,
    coverage > 0, a sample record scores (H16)."""
    if model is None:
        return Readiness("unhealthy", "model_not_loaded")
    if coverage is None or coverage <= 0 or q_low is None or q_high is None or not (
            math.isfinite(q_low) and math.isfinite(q_high)):
        return Readiness("unhealthy", "prediction_intervals_not_loaded")
    if sample is not None:
        try:
            row = model.predict(sample).select("pred_log").first()
            if row is None or row[0] is None or not math.isfinite(row[0]):
                return Readiness("unhealthy", "model_prediction_failed", "non-finite prediction")
        except Exception as exc:  # noqa: BLE001 - surfaced as a status, like the reference
            return Readiness("unhealthy", "model_prediction_failed", str(exc))
    return Readiness("healthy")


class NotReadyError(RuntimeError):
    """A scoring job was started without a usable model or interval."""


def sample_request(spark: SparkSession, age_limits=AGE_LIMITS) -> DataFrame:
    """One valid request with an age inside the limits and counts that don't contradict."""
    lo, hi = age_limits
    counts = {"games_played": 5.0, "minutes_played": 450.0, "goals": 1.0, "assists": 1.0, "yellow_cards": 0.0,
              "red_cards": 0.0}
    schema = request_schema()
    known = {"request_id": "readiness", "age": (lo + hi) / 2.0, "position": "Midfield",
             "player_club_domestic_competition_id": "GB1"}
    row = tuple(known[n] if n in known else counts[n.split("_", 1)[1]] for n in schema.names)
    return spark.createDataFrame([row], schema)


def require_ready(spark: SparkSession, model, q_low: float | None, q_high: float | None,
                  interval_coverage: float | None, age_limits=AGE_LIMITS, missing: str = "pipeline") -> None:
    """Raise :class:`NotReadyError` unless the readiness check passes, a sample request
    scored included (H16)."""
    sample = None if model is None else scoring_frame(sample_request(spark, age_limits), missing=missing)
    state = assert_ready(model, q_low, q_high, interval_coverage, sample)
    if state.status != "healthy":
        raise NotReadyError(f"{state.reason}: {state.detail}" if state.detail else str(state.reason))


def score_requests(requests: DataFrame, model, q_low: float, q_high: float, *, explain: bool = False,
                   scout: bool = False, top_k: int = 3, coverage: str | None = None, key: str = "request_id",
                   age_limits=AGE_LIMITS, link: str = "exp", missing: str = "pipeline",
                   interval_coverage: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Batch scoring (L4): readiness (H16) → validation (H1) → scoring frame (H3) →
    prediction (G7) → value, interval and the interval's measured coverage (H4),
    optionally local explanations (H5) and the scouting summary (H9). ``missing`` is how
    absent inputs are filled, here and in the model. Returns (scored, rejected rows).
    ``requests`` may be a stream: only the readiness check runs a job, on its own row."""
    require_ready(requests.sparkSession, model, q_low, q_high, interval_coverage, age_limits, missing)
    valid, rejected = validate_requests(requests, age_limits=age_limits)
    out = score_valid(valid, model, q_low, q_high, explain=explain, scout=scout, top_k=top_k, coverage=coverage, link=link,
                      missing=missing, interval_coverage=interval_coverage)
    return out, rejection_rows(rejected, key)


def score_valid(valid: DataFrame, model, q_low: float, q_high: float, *, explain: bool = False, scout: bool = False,
                top_k: int = 3, coverage: str | None = None, link: str = "exp", missing: str = "pipeline",
                interval_coverage: float = 0.8) -> DataFrame:
    """The scored rows of requests that :func:`validate_requests` let through."""
    frame = scoring_frame(valid, missing=missing)
    pred = (model.contributions(frame, top_k, missing=missing) if (explain or scout)
            else model.predict(frame, missing=missing))
    out = point_and_interval(pred, q_low, q_high, link=link).withColumn(
        "interval_coverage", F.lit(float(interval_coverage)))
    return scout_columns(out, coverage or coverage_label(0.1, 0.9)) if scout else out
