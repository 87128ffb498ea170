"""Request validation (the reference's rejection cases), intervals, report goldens."""

import math

import pytest
from pyspark.sql import functions as F

from tidewater.operators.report import build_report, report_lines, report_overall, top_group_risks
from tidewater.operators.scoring import (point_and_interval, rejection_rows, scout_columns, validate_requests)
from tidewater.sources.readers import request_schema

BASE = dict(request_id="r", age=25.0, position="Centre-Forward", w180_games_played=10.0, w180_minutes_played=900.0,
            w180_goals=2.0, w180_assists=3.0, w180_yellow_cards=1.0, w180_red_cards=0.0, w365_games_played=30.0,
            w365_minutes_played=2700.0, w365_goals=8.0, w365_assists=10.0, w365_yellow_cards=3.0,
            w365_red_cards=0.0, player_club_domestic_competition_id="GB1")


def _frame(spark, records):
    schema = request_schema()
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


@pytest.mark.parametrize("field,value,message", [
    ("age", -1.0, "Age must be between 16 and 50"),
    ("age", 51.0, "Age must be between 16 and 50"),
    ("age", float("nan"), "Age must be a finite number"),
    ("w180_games_played", -1.0, "Games played cannot be negative"),
    ("w365_minutes_played", -5.0, "Minutes played cannot be negative"),
    ("w180_goals", -1.0, "Goals and assists cannot be negative"),
    ("w365_assists", -2.0, "Goals and assists cannot be negative"),
    ("w180_red_cards", -1.0, "Cards cannot be negative"),
    ("w365_yellow_cards", float("inf"), "Cards must be a finite number"),
    ("position", "", "Position must be a non-empty string"),
    ("position", "   ", "Position must be a non-empty string"),
    ("player_club_domestic_competition_id", "", "Competition ID must be a non-empty string"),
    ("player_club_domestic_competition_id", " \t", "Competition ID must be a non-empty string"),
])
def test_rejections(spark, field, value, message):
    rec = dict(BASE, **{field: value})
    valid, rejected = validate_requests(_frame(spark, [rec]))
    assert valid.count() == 0
    rows = rejection_rows(rejected, "request_id").collect()
    assert [(r["field"], r["message"]) for r in rows] == [(field, message)]


def test_accepted_edges(spark):
    recs = [dict(BASE, request_id="a", w180_games_played=0.0, w180_goals=0.0, w365_minutes_played=0.0),
            dict(BASE, request_id="b", age=16.0), dict(BASE, request_id="c", age=50.0),
            dict(BASE, request_id="d", position="  Centre-Forward ")]
    valid, rejected = validate_requests(_frame(spark, recs))
    assert rejected.count() == 0 and valid.count() == 4
    assert valid.where(F.col("request_id") == "d").first()["position"] == "Centre-Forward"


def test_interval_golden(spark):
    df = spark.createDataFrame([(13.0,)], "pred_log double")
    r = point_and_interval(df, -1.43, 1.51).first()
    assert math.isclose(r["predicted_value_eur"], math.exp(13.0))
    assert math.isclose(r["ci_lower"], math.exp(11.57)) and math.isclose(r["ci_upper"], math.exp(14.51))
    assert r["ci_lower"] < r["ci_upper"] and r["score_error"] is None
    s = scout_columns(point_and_interval(df, -1.43, 1.51), "80%").first()
    assert s["valuation_band"] == "Development or depth option"
    assert s["summary"].startswith("Estimated market value is EUR 442K with a 80% interval from EUR 106K to EUR 2.00M")
    bad = point_and_interval(spark.createDataFrame([(float("nan"),)], "pred_log double"), -1.0, 1.0).first()
    assert bad["score_error"] == "Model returned an invalid prediction"


def _report_inputs(spark):
    es = spark.createDataFrame([(120, "2022-05-18", 2_450_000.0, 410_000.0, -1_250_000.0)],
                               "n_test_rows bigint, cutoff_date string, mae_eur double, median_abs_err_eur double, "
                               "mean_signed_err_eur double")
    iv = spark.createDataFrame([("v3", "10-90", 0.80, 0.74, 120)],
                               "model_version string, interval string, target_coverage double, "
                               "empirical_coverage double, n_test bigint")
    pos = spark.createDataFrame([("MID", 40, 3_000_000.0, 500_000.0, -1_500_000.0),
                                 ("FWD", 35, 2_000_000.0, 400_000.0, -1_000_000.0),
                                 ("GK", 20, 1_000_000.0, 200_000.0, -500_000.0)],
                                "position_bucket string, n bigint, mae_eur double, median_abs_err double, "
                                "mean_signed_err double")
    lea = spark.createDataFrame([("Unknown", 120, 2_450_000.0, 410_000.0, -1_250_000.0)],
                                "domestic_competition_id string, n bigint, mae_eur double, median_abs_err double, "
                                "mean_signed_err double")
    return es, iv, pos, lea


def test_report_golden(spark):
    es, iv, pos, lea = _report_inputs(spark)
    o = report_overall(es, iv).first()
    assert o["bias_direction"] == "underprediction" and o["coverage_gap"] == -0.06
    assert o["coverage_flag"].startswith("Interval coverage is below target")
    rep = build_report(spark, "v3", es, iv, pos, "position_bucket", lea, "domestic_competition_id").first()
    assert rep["top_position_risks"][0]["group"] == "MID" and rep["top_position_risks"][0]["samples"] == 40
    assert rep["top_league_risks"] == []
    assert len(rep["risk_flags"]) == 4 and "'Unknown'" in rep["risk_flags"][-1]
    assert "MID profiles" in rep["risk_flags"][2]


def test_report_lines_and_risk_order(spark):
    es, iv, pos, lea = _report_inputs(spark)
    rep = build_report(spark, "v3", es, iv, pos, "position_bucket", lea, "domestic_competition_id")
    lines = report_lines(rep).collect()
    overall = [(r["label"], r["value"]) for r in lines if r["section"] == "overall"]
    assert overall[0] == ("Test rows", "120") and overall[2] == ("MAE", "EUR 2.45M")
    assert overall[4] == ("Mean signed error", "EUR -1.25M (underprediction)")
    assert overall[5] == ("Interval coverage", "74.0% vs target 80.0%")
    assert [r["label"] for r in lines if r["section"] == "positions"] == ["MID", "FWD", "GK"]
    ties = spark.createDataFrame([("A", 5, 1.0, 1.0, 0.0), ("B", 9, 1.0, 1.0, 0.0), ("unknown", 99, 9.0, 1.0, 0.0)],
                                 "g string, n bigint, mae_eur double, median_abs_err_eur double, "
                                 "mean_signed_err_eur double")
    assert [r["group"] for r in top_group_risks(ties, "g", exclude_unknown=True).collect()] == ["B", "A"]
