"""Split, quantiles, quantile cut, histogram and metrics vs pandas / numpy."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators.split import split_stats, time_cutoff, time_split, value_at_rank
from tidewater.operators.stats import (add_error_columns, calibration_table, histogram, qcut_edges, quantile_cut,
                                       quantile_values, regression_metrics, variant_metrics)

from conftest import SF01


def test_cutoff_matches_sorted_index(spark):
    rnd = random.Random(3)
    dates = [dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)) for _ in range(997)]
    df = spark.createDataFrame([(d,) for d in dates], "date date")
    s = sorted(dates)
    for frac in (0.8, 0.5, 0.1):
        assert time_cutoff(df, "date", frac) == s[int(len(s) * frac)]
    train, test, cut = time_split(df, "date", 0.8)
    assert train.count() == sum(d < cut for d in dates)
    assert test.agg(F.min("date")).first()[0] == cut


def test_value_at_rank_timestamps(spark):
    rnd = random.Random(5)
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    s = sorted(ts)
    for k in (0, 17, 250, 499):
        assert value_at_rank(df, "ts", k) == s[k]


def test_sf001_cutoff(spark):
    from tidewater.plans.star_queries import split_frames
    train, test, cutoff = split_frames(spark, SF01)
    assert cutoff == dt.date(2000, 4, 11)
    assert train.count() == 11997
    st = {r["side"]: r["n"] for r in split_stats(train.unionByName(test), "anchor_date", cutoff).collect()}
    assert st == {"train": 11997, "test": 3003}


def test_quantiles_match_numpy(spark):
    x = np.random.default_rng(1).normal(size=301)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = quantile_values(df, "x", [0.1, 0.5, 0.9])
    assert np.allclose(got, np.quantile(x, [0.1, 0.5, 0.9]))


def test_qcut_with_ties_matches_pandas(spark):
    rnd = np.random.default_rng(2)
    x = np.concatenate([np.round(rnd.exponential(3, 150)), np.zeros(60), np.full(20, 7.0)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, x double")
    got = {r["i"]: r["d"] for r in quantile_cut(df, "x", 10, "d").collect()}
    expected = pd.qcut(pd.Series(x), 10, labels=False, duplicates="drop")
    assert all(got[i] == int(expected[i]) for i in range(len(x)))
    assert len(qcut_edges(df, "x", 10)) - 1 == int(expected.max()) + 1


def test_calibration_table(spark):
    x = np.arange(100, dtype=float)
    df = spark.createDataFrame([(float(v), float(2 * v)) for v in x], "p double, a double")
    cal = {r["decile"]: (r["pred_mean"], r["actual_mean"], r["n"]) for r in calibration_table(df, "p", "a").collect()}
    assert len(cal) == 10 and all(v[2] == 10 for v in cal.values())
    assert cal[0] == (4.5, 9.0, 10)


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(4).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = {r["bin"]: r["n"] for r in histogram(df, "x", 60).collect()}
    counts, _ = np.histogram(x, bins=60)
    assert [got.get(i, 0) for i in range(60)] == list(counts)


def test_metrics_and_errors(spark):
    rows = [(np.log1p(100.0), np.log1p(150.0), 100.0), (np.log1p(200.0), np.log1p(100.0), 200.0)]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in rows], "y double, p double, v double")
    m = regression_metrics(df, "y", "p").first()
    d = np.array([r[1] - r[0] for r in rows])
    assert np.isclose(m["rmse_log"], np.sqrt(np.mean(d ** 2))) and np.isclose(m["mae_log"], np.mean(np.abs(d)))
    assert np.isclose(m["mae_eur"], 75.0)
    e = add_error_columns(df.withColumnRenamed("p", "pred_log"), "pred_log", "v").orderBy("v").collect()
    assert np.isclose(e[0]["signed_err_eur"], 50.0) and np.isclose(e[1]["abs_err_eur"], 100.0)
    vm = {r["variant"]: r for r in variant_metrics(e and add_error_columns(
        df.withColumnRenamed("p", "pred_log"), "pred_log", "v").withColumn("pz", F.lit(0.0)),
        "actual_eur", {"a": "pred_eur", "b": "pz"}).collect()}
    assert np.isclose(vm["b"]["mae_eur"], 150.0) and np.isclose(vm["a"]["mean_signed_err_eur"], -25.0)


def test_exact_quantiles_match_numpy(spark):
    import tidewater.operators.stats as st
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.lognormal(10, 2, 3000), np.full(500, 42.0)])   # heavy tail + a hot value
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    qs = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    got = st.quantile_values(df, "x", qs)
    assert np.allclose(got, np.quantile(x, qs), rtol=1e-12)
    edges = st.qcut_edges(df, "x", 10)
    assert np.allclose(edges, sorted(set(np.quantile(x, np.linspace(0, 1, 11)))), rtol=1e-12)


def test_collapse_top_k_ties(spark):
    from tidewater.operators.features import collapse_rare_categories
    rows = [("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [(None,)] * 2 + [(" d ",)]
    df = spark.createDataFrame(rows, "v string")
    got = sorted(r[0] for r in collapse_rare_categories(df, {"v": 2}).collect())
    # counts a:3, then b, c, Unknown tie at 2 → value ascending keeps "Unknown" ('U' < 'b')
    assert got == sorted(["a"] * 3 + ["Unknown"] * 2 + ["Other"] * 5)


def test_grouped_exact_quantile_hot_group_and_value(spark):
    from tidewater.operators.quantiles import grouped_median, grouped_quantile
    rng = np.random.default_rng(0)
    n = 6000
    g = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c", None], n))
    v = np.round(rng.lognormal(3, 1.5, n), 1)
    v[rng.random(n) < 0.2] = 7.0                      # a hot value
    df = spark.createDataFrame([(a, float(b)) for a, b in zip(g, v)], "g string, v double")
    pdf = pd.DataFrame({"g": g, "v": v}).fillna({"g": "<null>"})
    for q in (0.5, 0.1, 0.9, 1.0):
        for acc in (50, 10_000):                      # a coarse sketch forces wide brackets
            got = {(r["g"] if r["g"] is not None else "<null>"): r["q"]
                   for r in grouped_quantile(df, ["g"], "v", q, accuracy=acc).collect()}
            exp = pdf.groupby("g").v.quantile(q).to_dict()
            assert got.keys() == exp.keys()
            assert all(np.isclose(got[k], exp[k], rtol=1e-12) for k in exp)
    medians = {(r["g"] if r["g"] is not None else "<null>"): r["m"] for r in grouped_median(df, ["g"], "v", "m").collect()}
    assert medians == pytest.approx(pdf.groupby("g").v.median().to_dict())


def test_exact_quantiles_with_one_value_in_nine_of_ten_rows(spark):
    from tidewater.operators.quantiles import grouped_quantiles
    from tidewater.operators.stats import qcut_edges, quantile_values
    rng = np.random.default_rng(5)
    x = np.where(rng.random(4000) < 0.9, 7.0, rng.normal(7, 3, 4000))
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    qs = [0.0, 0.02, 0.5, 0.97, 1.0]
    assert np.allclose(quantile_values(df, "x", qs), np.quantile(x, qs), rtol=1e-12)
    assert np.allclose(qcut_edges(df, "x"), sorted(set(np.quantile(x, np.linspace(0, 1, 11)))), rtol=1e-12)
    assert quantile_values(df.where("x is null"), "x", qs) == [None] * 5
    groups = df.selectExpr("case when x is null then 'none' when rand(3) < 0.4 then 'hot' else 'rest' end as g", "x")
    groups = spark.createDataFrame(groups.collect(), "g string, x double")
    got = {(r["g"], r["qi"]): r["q"] for r in grouped_quantiles(groups, ["g"], "x", qs, accuracy=50).collect()}
    exp = groups.toPandas().groupby("g").x.quantile(qs)
    for g in ("hot", "rest"):
        assert np.allclose([got[g, i] for i in range(5)], exp[g].to_numpy(), rtol=1e-12)
    assert [got["none", i] for i in range(5)] == [None] * 5


def test_error_by_group_keeps_null_group(spark):
    from tidewater.operators.stats import error_by_group
    rows = [("a", 1.0, 1.0, -1.0), ("a", 3.0, 3.0, 3.0), (None, 10.0, 10.0, 10.0), (None, 20.0, 20.0, -20.0),
            (None, 40.0, 40.0, 40.0)]
    df = spark.createDataFrame(rows, "g string, actual_eur double, abs_err_eur double, signed_err_eur double")
    got = {r["g"]: (r["n"], r["mae_eur"], r["median_abs_err"], r["mean_signed_err"])
           for r in error_by_group(df, "g").collect()}
    assert got == {"a": (2, 2.0, 2.0, 1.0), None: (3, 70 / 3, 20.0, 10.0)}


def test_row_ids_are_dense_in_order(spark):
    from tidewater.operators.split import with_row_id
    rows = [(i * 37 % 101, None if i % 10 == 0 else i % 7) for i in range(101)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = sorted((r["row_id"], r["v"], r["k"]) for r in with_row_id(df, ["v", "k"]).collect())
    assert [g[0] for g in got] == list(range(101))
    assert [g[1:] for g in got] == sorted(((v, k) for k, v in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert with_row_id(df.limit(0), ["v", "k"]).count() == 0


def test_split_summary_is_cutoff_and_stats_in_one_aggregate(spark):
    import datetime as dt
    from tidewater.operators.split import split_stats, split_summary, time_cutoff
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=d * d % 37) for d in range(50)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for frac in (0.0, 0.3, 0.8, 1.0):
        cutoff, sides = split_summary(df, "d", frac)
        assert cutoff == time_cutoff(df, "d", frac)
        assert sorted(map(tuple, sides.collect())) == sorted(map(tuple, split_stats(df, "d", cutoff).collect()))
    with pytest.raises(ValueError):
        split_summary(df.limit(0), "d")
    with pytest.raises(TypeError):
        split_summary(df.withColumn("d", F.col("d").cast("string")), "d")


def test_several_statistics_in_one_selection(spark):
    """Groupings with a null group and an empty one, NaN and null values, against numpy."""
    from tidewater.operators.quantiles import quantile_selection
    rng = np.random.default_rng(1)
    rows = [(None if i % 7 == 0 else "abc"[i % 3], int(i % 2), float(rng.integers(0, 60)) if i % 5 else None, float("nan") if i % 4 == 0 else float(rng.normal())) for i in range(900)]
    rows += [("empty", 0, None, float("nan"))]
    df = spark.createDataFrame(rows, "g string, h int, x double, y double")
    wanted = {"all": ([], "x", [0.0, 0.25, 0.5, 1.0]), "by g": (["g"], "y", [0.1, 0.9]), "by both": (["g", "h"], F.col("x") * 2, [0.5])}
    for accuracy in (10_000, 20):
        got = {(r["statistic"], r["g"], r["h"], r["qi"]): r["q"] for r in quantile_selection(df, wanted, accuracy).collect()}
        want = {}
        for i, q in enumerate(wanted["all"][2]):
            want["all", None, None, i] = np.quantile([r[2] for r in rows if r[2] is not None], q)
        for g in (None, "a", "b", "c", "empty"):
            own = [r[3] for r in rows if r[0] == g and not np.isnan(r[3])]
            for i, q in enumerate((0.1, 0.9)):
                want["by g", g, None, i] = np.quantile(own, q) if own else None
            for h in (0, 1):
                both = [2 * r[2] for r in rows if r[0] == g and r[1] == h and r[2] is not None]
                if any(r[0] == g and r[1] == h for r in rows):
                    want["by both", g, h, 0] = np.quantile(both, 0.5) if both else None
        assert got.keys() == want.keys()
        assert all((want[k] is None and got[k] is None) or np.isclose(got[k], want[k], rtol=1e-12) for k in want)
    assert quantile_selection(df.limit(0), wanted).count() == 0


def test_groupwise_factors_are_the_same_in_every_pass(spark):
    """A mean's last digits differ from run to run of the same plan; the decile edges are
    exact ranks of few distinct values, so all passes must see one set of factors."""
    from tidewater.plans.diagnostics import groupwise_bias_correction

    noise = F.udf(lambda: random.random() * 1e-9, "double").asNondeterministic()
    rows = spark.range(400).select((F.col("id") % 4).cast("string").alias("league"), (10.0 + F.col("id") % 3).alias("pred_log"),
                                   (20000.0 + F.col("id")).alias("value"))
    train = rows.withColumn("target_log", F.col("pred_log") + noise())
    bc = groupwise_bias_correction(train, rows, group="league", actual="value")
    assert sum(r["n"] for r in bc.calibration.collect()) == 400
    assert {r["variant"]: r["n"] for r in bc.comparison.collect()} == {"baseline": 400, "groupwise_bias_corrected": 400}
