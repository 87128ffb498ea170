"""Property checks (hypothesis): the quantile cut equals pandas qcut; safe_divide never yields NULL/NaN/inf."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.functions.scalar import safe_divide
from tidewater.operators.stats import quantile_cut

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=30), min_size=12, max_size=80))
def test_qcut_equals_pandas(spark, values):
    x = np.array(values, dtype=float)
    if len(set(values)) < 2:
        return
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, x double")
    got = {r["i"]: r["d"] for r in quantile_cut(df, "x", 10, "d").collect()}
    exp = pd.qcut(pd.Series(x), 10, labels=False, duplicates="drop")
    assert all(got[i] == int(exp[i]) for i in range(len(x)))


finite = st.floats(allow_nan=True, allow_infinity=True, width=64)


@SETTINGS
@given(st.lists(st.tuples(finite, finite), min_size=1, max_size=30))
def test_safe_divide_always_finite(spark, pairs):
    df = spark.createDataFrame([(a, b) for a, b in pairs], "n double, d double")
    for (a, b), r in zip(pairs, df.select(safe_divide("n", "d").alias("q")).collect()):
        q = r["q"]
        assert q is not None and math.isfinite(q)
        if b != 0 and math.isfinite(a) and math.isfinite(b) and math.isfinite(a / b):
            assert q == a / b


def test_top_categories_equal_full_counts(spark):
    """Few values, very many, ties at the border, and all values alike: always the exact list."""
    import collections
    import random

    from tidewater.operators import features
    pick = random.Random(2)
    tables = {
        "few": [pick.choice(["a", "b ", " b", None, "c"]) for _ in range(300)],
        "zipf": ["v%d" % int(400 * pick.random() ** 4) for _ in range(3000)],
        "unique": ["u%d" % i for i in range(700)],
        "ties": ["t%02d" % (i % 60) for i in range(600)],
        "none": [],
    }
    calls = []
    whole = features.count_top
    for name, values in tables.items():
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x string, i int")
        counts = collections.Counter((v if v is not None else "Unknown").strip() for v in values)
        for k, tracked in ((3, 10_000), (59, 64)):
            want = [v for v, _ in sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:k]]
            assert features.fit_top_categories(df, {"x": k}, tracked=tracked)["x"] == want, (name, k, tracked)
    features.count_top = lambda *args: calls.append(args) or whole(*args)
    try:
        df = spark.createDataFrame([("hot",)] * 900 + [("w%d" % i,) for i in range(500)], "x string")
        assert features.fit_top_categories(df, {"x": 1}, tracked=64)["x"] == ["hot"] and not calls       # proved by the counts
        assert features.fit_top_categories(df, {"x": 2}, tracked=64)["x"] == ["hot", "w0"] and calls     # a tie at the border
    finally:
        features.count_top = whole
