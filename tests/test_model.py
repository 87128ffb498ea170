"""Imputation, scaling, ridge equivalence with the closed form, explanations, save/load."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators.model import column_roles, fit_gram, fit_preprocessing, fit_ridge, top_coefficients


def _data(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(5, 2, n)
    x2 = rng.normal(-1, 0.5, n)
    cat = rng.choice(["a", "b", "c"], n)
    y = 1.5 * x1 - 2 * x2 + (cat == "b") * 0.7 + rng.normal(0, 3, n) + 10
    rows = [(float(a), float(b), str(c), float(t)) for a, b, c, t in zip(x1, x2, cat, y)]
    return spark.createDataFrame(rows, "x1 double, x2 double, cat string, y double"), x1, x2, cat, y


def test_ridge_equals_closed_form(spark):
    df, x1, x2, cat, y = _data(spark)
    for alpha in (1.0, 25.0):
        m = fit_ridge(df, "y", ["x1", "x2"], ["cat"], alpha=alpha)
        Z = np.column_stack([(x1 - x1.mean()) / x1.std(), (x2 - x2.mean()) / x2.std(),
                             (cat == "a"), (cat == "b"), (cat == "c")]).astype(float)
        Zc, yc = Z - Z.mean(0), y - y.mean()
        w = np.linalg.solve(Zc.T @ Zc + alpha * np.eye(5), Zc.T @ yc)
        assert np.allclose(m.coefficients, w, atol=1e-9)
        assert np.isclose(m.intercept, y.mean() - Z.mean(0) @ w, atol=1e-9)
    assert m.feature_names == ["x1", "x2", "cat=a", "cat=b", "cat=c"]


def test_unseen_category_is_zero_vector_and_contributions_sum(spark):
    df, *_ = _data(spark)
    m = fit_ridge(df, "y", ["x1", "x2"], ["cat"])
    new = spark.createDataFrame([(5.0, -1.0, "zzz", 0.0), (None, None, None, 0.0)], "x1 double, x2 double, cat string, y double")
    p = m.predict(new).collect()
    z1 = (5.0 - m.prep.means["x1"]) / m.prep.scales["x1"]
    z2 = (-1.0 - m.prep.means["x2"]) / m.prep.scales["x2"]
    assert np.isclose(p[0]["pred_log"], m.intercept + m.coefficients[0] * z1 + m.coefficients[1] * z2)
    ex = m.contributions(df.limit(20), top_k=3).collect()
    for r in ex:
        assert len(r["top_positive"]) <= 3 and all(c["contribution_log"] > 0 for c in r["top_positive"])
        mags = [abs(c["contribution_log"]) for c in r["top_negative"]]
        assert mags == sorted(mags, reverse=True)


def test_imputation_statistics(spark):
    rows = [(1.0, "x"), (None, None), (3.0, "y"), (10.0, "y"), (float("nan"), "x"), (6.0, None)]
    df = spark.createDataFrame(rows, "v double, c string")
    p = fit_preprocessing(df, ["v"], ["c"])
    assert p.medians["v"] == 4.5          # exact, interpolated (Spark ML Imputer would give 3.0)
    assert p.modes["c"] == "x"            # tie x/y → smallest, like sklearn
    imputed = [4.5 if v is None or v != v else v for v, _ in rows]
    assert np.isclose(p.means["v"], np.mean(imputed)) and np.isclose(p.scales["v"], np.std(imputed))
    assert column_roles(df) == (["v"], ["c"])


def test_top_coefficients_and_save_load(spark, tmp_path):
    df, *_ = _data(spark)
    m = fit_ridge(df, "y", ["x1", "x2"], ["cat"])
    tc = top_coefficients(m, spark, 2).collect()
    assert [r["side"] for r in tc] == ["largest", "largest", "smallest", "smallest"]
    from tidewater.operators.model import RidgeModel
    m.save(str(tmp_path / "m"))
    m2 = RidgeModel.load(str(tmp_path / "m"))
    a = m.predict(df).select("pred_log").collect()
    b = m2.predict(df).select("pred_log").collect()
    assert np.allclose([r[0] for r in a], [r[0] for r in b])


def test_imputation_medians_equal_numpy(spark):
    import tidewater.operators.model as mdl
    df, *_ = _data(spark)
    df = df.withColumn("x1", F.when(F.col("x2") > -1, F.col("x1")))     # some NULLs
    fitted = mdl.fit_preprocessing(df, ["x1", "x2"], ["cat"])
    exp = df.select("x1", "x2").toPandas().median()
    assert np.allclose([fitted.medians[c] for c in ("x1", "x2")], [exp["x1"], exp["x2"]], rtol=1e-12)


def test_subset_of_the_gram_matrix_is_a_fit_of_its_own(spark):
    df, x1, x2, cat, y = _data(spark)
    gram = fit_gram(df, "y", ["x1", "x2"], ["cat"])
    assert gram.n == len(y) and np.isclose(gram.label_std, y.std())
    for columns, numeric, categorical in ((["x2", "cat"], ["x2"], ["cat"]), (["x1"], ["x1"], []), (["cat"], [], ["cat"])):
        for alpha in (1.0, 7.0):
            sub, fresh = gram.solve(columns, alpha), fit_ridge(df, "y", numeric, categorical, alpha)
            assert sub.feature_names == fresh.feature_names
            assert np.allclose(sub.coefficients, fresh.coefficients, atol=1e-9) and np.isclose(sub.intercept, fresh.intercept, atol=1e-9)
    # without a penalty: least squares
    ols = gram.solve(["x1", "x2"], 0.0)
    z = np.column_stack([np.ones(len(y)), (x1 - x1.mean()) / x1.std(), (x2 - x2.mean()) / x2.std()])
    assert np.allclose([ols.intercept, *ols.coefficients], np.linalg.lstsq(z, y, rcond=None)[0], atol=1e-9)


def test_several_models_score_in_one_pass(spark):
    df, *_ = _data(spark)
    gram = fit_gram(df, "y", ["x1", "x2"], ["cat"])
    full, part = gram.solve(), gram.solve(["x2", "cat"])
    both = full.predict_all(df, {"a": full, "b": part})
    assert [c for c in both.columns if c.startswith("__")] == []
    alone = [r["pred_log"] for r in part.predict(df).collect()]
    assert np.allclose([r["b"] for r in both.collect()], alone, rtol=1e-13)
    # the expression is the scalar product of the assembled features
    rows = full.assembled(df).select("__features", "__pred").collect()
    assert np.allclose([r["__features"].dot(np.array(full.coefficients)) + full.intercept for r in rows], [r["__pred"] for r in rows], rtol=1e-12)


def test_gram_edges(spark):
    schema = "x double, empty string, cat string, y double"
    df = spark.createDataFrame([(1.0, None, "a", 1.0), (None, None, None, 2.0), (float("nan"), None, "b", 4.0), (3.0, None, "b", None)], schema)
    m = fit_ridge(df, "y", ["x"], ["empty", "cat"])
    assert m.feature_names == ["x", "cat=a", "cat=b"] and m.n_train == 3      # a column without values adds no feature
    assert all(np.isfinite(r["pred_log"]) for r in m.predict(df).collect())
    assert len(m.contributions(df, 5).collect()) == 4
    with pytest.raises(ValueError, match="no training rows"):
        fit_ridge(df.where("y > 9"), "y", ["x"], ["cat"])
    import tidewater.operators.model as mdl
    limit, mdl.MAX_FEATURES = mdl.MAX_FEATURES, 2
    try:
        with pytest.raises(ValueError, match="at most 2"):
            fit_gram(df, "y", ["x"], ["cat"])
    finally:
        mdl.MAX_FEATURES = limit


def test_too_many_categories_is_an_error(spark):
    from tidewater.operators.model import fit_preprocessing
    df = spark.createDataFrame([(str(i), "a") for i in range(30)], "wide string, narrow string")
    assert fit_preprocessing(df, [], ["narrow", "wide"]).modes["narrow"] == "a"
    with pytest.raises(ValueError, match="wide"):
        fit_preprocessing(df, [], ["narrow", "wide"], max_categories=20)


def test_released_scratch_is_gone_and_tables_are_built_again(spark, tmp_path):
    import os
    from tidewater.session import release_scratch, written_table
    folder = tmp_path / "in"
    spark.range(5).write.parquet(str(folder / "t.parquet"))
    def table():
        return written_table(spark, "released", lambda: spark.read.parquet(str(folder / "t.parquet")), str(folder))
    old = table().inputFiles()[0].removeprefix("file://")
    assert os.path.exists(old) and table().inputFiles()[0].endswith(old)
    assert release_scratch(spark) > 0 and not os.path.exists(old)
    assert table().count() == 5 and release_scratch(spark) == 1


def test_gram_reads_the_rows_once_after_the_medians(spark):
    """Means, scales and products come of one pass, those of all rows and of the rows with a target."""
    seen = spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return v
    rng = np.random.default_rng(3)
    x, y = rng.normal(1e6, 2.0, 200), rng.normal(size=200)
    rows = [(float(a), None if i % 9 == 0 else float(b), "pq"[i % 2]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, c string").repartition(3)
    df = df.withColumn("x", F.udf(counted, "double").asNondeterministic()("x"))
    gram = fit_gram(df, "y", ["x"], [], accuracy=10_000)
    assert seen.value == 2 * len(rows)
    assert gram.prep.means["x"] == pytest.approx(x.mean()) and gram.prep.scales["x"] == pytest.approx(x.std())
    z, has = (x - x.mean()) / x.std(), np.arange(200) % 9 != 0
    m = np.column_stack([z, np.where(has, y, 0.0), np.ones(200)])[has]
    assert np.allclose(gram.products, m.T @ m)


def test_contributions_are_ranked_as_numbers(spark):
    """The texts of an entry are made for the first ones only; equal sizes keep the features' order."""
    rows = [(1.0, 1.0, "p", 1.0), (3.0, 3.0, "q", 2.0), (5.0, 5.0, "q", 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c string, y double")
    ex = fit_ridge(df, "y", ["a", "b"], ["c"]).contributions(df, top_k=2)
    assert "array_sort" not in ex._jdf.queryExecution().optimizedPlan().toString()
    for r in ex.collect():
        for side, sign in ((r["top_positive"], 1), (r["top_negative"], -1)):
            sizes = [sign * e["contribution_log"] for e in side]
            assert len(side) <= 2 and all(s > 0 for s in sizes) and sizes == sorted(sizes, reverse=True)
    last = max(ex.collect(), key=lambda r: r["y"])
    assert [(e["feature"], e["feature_value"]) for e in last["top_positive"]] == [("a", "5.0"), ("b", "5.0")]
