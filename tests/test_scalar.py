"""Column functions: NULL/NaN/inf/tie edge cases (the testdata has no NULLs)."""

import math

import pytest
from pyspark.sql import functions as F

from tidewater.functions import scalar as S
from tidewater.operators.cleaning import FOOT_EXACT, FOOT_SUBSTRING, POSITION_RULES


def col_values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


# the reference's five safe_divide cases
@pytest.mark.parametrize("numer,denom,expected", [
    ([1.0, 2.0, 3.0], 0, [0.0, 0.0, 0.0]),
    ([10.0, 20.0, 30.0], 2, [5.0, 10.0, 15.0]),
    ([10.0, 20.0, 30.0], [2.0, 0.0, 5.0], [5.0, 0.0, 6.0]),
    ([10.0, 20.0, 30.0], [2.0, 4.0, 5.0], [5.0, 5.0, 6.0]),
    ([1.0, 2.0, 3.0], [0.0, float("inf"), float("nan")], [0.0, 0.0, 0.0]),
])
def test_safe_divide(spark, numer, denom, expected):
    if isinstance(denom, list):
        rows = list(zip(numer, denom))
        got = col_values(spark, rows, "n double, d double", S.safe_divide("n", "d"))
    else:
        got = col_values(spark, [(v,) for v in numer], "n double", S.safe_divide("n", denom))
    assert got == expected


def test_safe_divide_null_numerator(spark):
    got = col_values(spark, [(None, 2.0), (float("nan"), 2.0)], "n double, d double", S.safe_divide("n", "d"))
    assert got == [0.0, 0.0]


def test_try_double_and_int(spark):
    rows = [("2.0",), ("abc",), ("NaN",), (None,), (" 7 ",), ("3.9",)]
    assert col_values(spark, rows, "s string", S.try_double("s")) == [2.0, None, None, None, 7.0, 3.9]
    assert col_values(spark, rows, "s string", S.try_int("s", 0)) == [2, 0, 0, 0, 7, 3]


def test_clip_keeps_null(spark):
    got = col_values(spark, [(-1.0,), (None,), (5.0,)], "x double", S.clip_lower("x"))
    assert got == [0.0, None, 5.0]
    got = col_values(spark, [(-20.0,), (1.0,)], "x double", S.safe_expm1("x"))
    assert got[0] == 0.0 and math.isclose(got[1], math.e - 1)


def test_exact_label_map(spark):
    rows = [(None,), (" Right ",), ("r",), ("LEFT",), ("l",), ("both",), ("B",), ("\tleft\n",), ("either",)]
    got = col_values(spark, rows, "f string", S.exact_label_map("f", FOOT_EXACT))
    assert got == ["Unknown", "Right", "Right", "Left", "Left", "Both", "Both", "Left", "Other"]


def test_substring_label_map_order(spark):
    rows = [("left foot",), ("right",), ("ambidextrous",), ("left and right",), ("x",), (None,)]
    got = col_values(spark, rows, "f string", S.substring_label_map("f", FOOT_SUBSTRING))
    assert got == ["Left", "Right", "Both", "Left", None, None]


def test_keyword_bucket_order(spark):
    rows = [("Goalkeeper",), ("Centre-Back",), ("Right Winger",), ("Centre-Forward",), ("Attack",), (None,),
            ("Defensive Midfield",)]
    got = col_values(spark, rows, "p string", S.keyword_bucket("p", POSITION_RULES))
    # "winger" contains "wing" which the MID rule tests first; "Attack" matches nothing
    assert got == ["GK", "DEF", "MID", "FWD", "Other", "Unknown", "MID"]


def test_height_bucket(spark):
    rows = [(None,), (float("nan"),), (169.9,), (170.0,), (185.0,), (185.1,)]
    got = col_values(spark, rows, "h double", S.three_way_bucket("h", 170, 185))
    assert got == ["Unknown", "Unknown", "Short", "Average", "Average", "Tall"]


def test_null_outside(spark):
    got = col_values(spark, [(139.9,), (140.0,), (220.0,), (221.0,), ("abc",)], "h string", S.null_outside("h", 140, 220))
    assert got == [None, 140.0, 220.0, None, None]


def test_fixed_bins_left_closed(spark):
    edges = [0, 18, 21, 24, 27, 30, 35, 100]
    rows = [(-1.0,), (0.0,), (17.99,), (18.0,), (99.9,), (100.0,), (None,)]
    assert col_values(spark, rows, "a double", S.fixed_bins("a", edges)) == [None, 0, 0, 1, 6, None, None]
    assert col_values(spark, [(18.0,)], "a double", S.fixed_bins("a", edges, as_label=True)) == ["[18, 21)"]


def test_full_name(spark):
    rows = [("Ada", "Lovelace", "x"), ("Ada", None, "A. L."), (None, None, None)]
    got = col_values(spark, rows, "f string, l string, n string", S.full_name("f", "l", "n"))
    assert got == ["Ada Lovelace", "A. L.", None]


def test_format_eur_and_pct(spark):
    rows = [(2_344_545.0,), (385_457.0,), (-1_652_575.0,), (2.5,), (1_500_000_000.0,), (999.4,)]
    got = col_values(spark, rows, "v double", S.format_eur("v"))
    assert got == ["EUR 2.34M", "EUR 385K", "EUR -1.65M", "EUR 2", "EUR 1.50B", "EUR 999"]
    # signed comparison (scoring style): negatives are not scaled
    assert col_values(spark, [(-2_000_000.0,)], "v double", S.format_eur("v", by_magnitude=False)) == [
        "EUR -2000000"]
    assert col_values(spark, [(0.808,), (0.8,)], "v double", S.format_pct("v")) == ["80.8%", "80.0%"]


def test_bias_direction(spark):
    rows = [(-1_250_000.0, 2_450_000.0), (40_000.0, 100_000.0), (300_000.0, 2_000_000.0)]
    got = col_values(spark, rows, "s double, m double", S.bias_direction("s", "m"))
    assert got == ["underprediction", "roughly_unbiased", "overprediction"]


def test_bands_and_uncertainty(spark):
    rows = [(1_999_999.0,), (2_000_000.0,), (29_999_999.0,), (69_999_999.0,), (70_000_000.0,)]
    got = col_values(spark, rows, "v double", S.valuation_band("v"))
    assert got == ["Development or depth option", "Rotation-level asset", "First-team starter profile",
                   "High-value starter", "Elite market asset"]
    rows = [(0.0, 1.0, 2.0), (10.0, 5.0, 19.0), (10.0, 5.0, 30.0), (10.0, 5.0, 40.0)]
    got = col_values(spark, rows, "v double, lo double, hi double", S.uncertainty_level("v", "lo", "hi"))
    assert got == ["high", "low", "medium", "high"]


def test_age_years(spark):
    import datetime as dt
    rows = [(dt.date(2020, 1, 1), dt.date(2000, 1, 1))]
    got = col_values(spark, rows, "d date, b date", S.age_years("d", "b"))
    assert math.isclose(got[0], 7305 / 365.25)
    got = col_values(spark, rows, "d date, b date", S.completed_years("b", F.col("d")))
    assert got == [20]
