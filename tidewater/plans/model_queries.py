"""Queries that check the fitted model and the streaming scorer in SQL.

The ridge fit has no SQL form, but what makes a fit right has: at the solution the
gradient of the loss is zero for each transformed feature, and a row's contributions add
up to its prediction (G4–G9, H5, E11). The stream's rejections and its scored rows with
the group-median model are the rows of the batch queries' SQL (J1, H2, G11).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.baselines import median_tables, predict_group_median
from ..operators.model import top_coefficients
from ..operators.scoring import assert_ready, coverage_label, scoring_frame
from ..operators.stats import metrics_by_variant, quantile_values
from ..session import PARTITION_BYTES, TASK_BYTES, input_stamp, scratch_path, split_scans, written
from ..streaming.scoring_stream import drain, requests_as_json, sink_table, start_scoring
from .star_queries import (_REQ_SQL, ABLATION_MODES, ACCT_BUCKETS, CATEGORICAL_INPUTS, GROUP_KEYS, MEASURES, NUMERIC_INPUTS,
                           ORACLE, REQ_AGE_LIMITS, SCORED_SQL, WINDOWS, _gram, _ridge_setup, ablation_columns, r4, r6, register,
                           requests_frame, scored, split_frames)

_NUMERIC_ROWS = ", ".join(f"('{c}')" for c in NUMERIC_INPUTS)


@register("ridge_gradient", SCORED_SQL + f""",
  attrs AS (
    SELECT t.position, t.nationality, regexp_replace(COALESCE(r.r_name, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS region,
           CASE WHEN c.c_acctbal IS NULL OR c.c_acctbal < 0 THEN 'Unknown' WHEN c.c_acctbal < {ACCT_BUCKETS[0]} THEN 'Short'
                WHEN c.c_acctbal <= {ACCT_BUCKETS[1]} THEN 'Average' ELSE 'Tall' END AS acctbal_bucket
    FROM train t JOIN customer c ON c.c_custkey = t.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey),
  f AS (
    SELECT feature, 1 AS n FROM (VALUES {_NUMERIC_ROWS}, ('(intercept)')) v(feature)
    UNION ALL SELECT 'position', COUNT(DISTINCT position) FROM attrs
    UNION ALL SELECT 'nationality', LEAST(COUNT(DISTINCT nationality), 11) FROM attrs
    UNION ALL SELECT 'region', COUNT(DISTINCT region) FROM attrs
    UNION ALL SELECT 'acctbal_bucket', COUNT(DISTINCT acctbal_bucket) FROM attrs)
SELECT feature, CAST(n AS BIGINT) AS n_features, CAST(0 AS DOUBLE) AS max_gradient FROM f
""")
def ridge_gradient(spark, sf):
    """Transformed features per source column and the largest gradient of the loss among them."""
    _, train, _, model = _ridge_setup(spark, sf)
    g = model.normal_equations(train, "target_log")
    return g.groupBy("feature").agg(F.count(F.lit(1)).alias("n_features"),
                                    r6(F.max(F.abs("gradient"))).alias("max_gradient"))


@register("ridge_balance", SCORED_SQL + """
SELECT o_orderkey, CAST(0 AS DOUBLE) AS off, CAST(3 AS INTEGER) AS n_positives, CAST(3 AS INTEGER) AS n_risks,
       CAST(0 AS INTEGER) AS unnamed FROM test
""")
def ridge_balance(spark, sf):
    """Per test row: intercept and all contributions less the prediction, the lengths of the
    two lists a scout sees, and the contributions without a value where the input has one."""
    _, _, test, model = _ridge_setup(spark, sf)
    every = len(model.feature_names)
    ex = model.contributions(test, top_k=every)

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, e: a + e["contribution_log"])
    unnamed = F.size(F.filter(F.concat("top_positive", "top_negative"), lambda e: e["feature_value"].isNull()
                              & ~e["feature"].isin("age", "acctbal")))
    off = F.col("baseline_log_value") + total("top_positive") + total("top_negative") - F.col("pred_log")
    return ex.select("o_orderkey", F.abs(r6(off)).alias("off"),
                     F.size(F.slice("top_positive", 1, 3)).alias("n_positives"),
                     F.size(F.slice("top_negative", 1, 3)).alias("n_risks"), unnamed.alias("unnamed"))


# ---------------------------------------------------------------------------
# A fit that SQL can solve: two standardised inputs, by Cramer's rule
# ---------------------------------------------------------------------------

_TWO_INPUTS_SQL = SCORED_SQL + """,
  x AS (SELECT t.target_log AS y, t.age, CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS acctbal
        FROM train t LEFT JOIN customer c ON c.c_custkey = t.o_custkey),
  xt AS (SELECT t.target_log AS y, t.age, CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS acctbal
         FROM test t LEFT JOIN customer c ON c.c_custkey = t.o_custkey),
  med AS (SELECT median(age) AS m1, median(acctbal) AS m2 FROM x),
  st AS (SELECT avg(COALESCE(age, m1)) AS mu1, stddev_pop(COALESCE(age, m1)) AS sd1, avg(COALESCE(acctbal, m2)) AS mu2,
                stddev_pop(COALESCE(acctbal, m2)) AS sd2, avg(y) AS my FROM x CROSS JOIN med),
  z AS (SELECT (COALESCE(age, m1) - mu1) / sd1 AS z1, (COALESCE(acctbal, m2) - mu2) / sd2 AS z2, y - my AS yc
        FROM x CROSS JOIN med CROSS JOIN st),
  g AS (SELECT sum(z1 * z1) + 1 AS a, sum(z2 * z2) + 1 AS b, sum(z1 * z2) AS ab, sum(z1 * yc) AS y1, sum(z2 * yc) AS y2 FROM z),
  fit AS (SELECT 'both' AS experiment, 2 AS k, (b * y1 - ab * y2) / (a * b - ab * ab) AS w1,
                 (a * y2 - ab * y1) / (a * b - ab * ab) AS w2 FROM g
          UNION ALL SELECT 'age', 1, y1 / a, 0 FROM g UNION ALL SELECT 'acctbal', 1, 0, y2 / b FROM g)"""


def _two_input_models(spark, sf):
    gram = _gram(spark, sf)
    return {"both": gram.solve(["age", "acctbal"]), "age": gram.solve(["age"]), "acctbal": gram.solve(["acctbal"])}


@register("ridge_two_inputs", _TWO_INPUTS_SQL + """,
  filled AS (SELECT 'pipeline' AS missing, y, COALESCE(age, m1) AS age, COALESCE(acctbal, m2) AS acctbal FROM xt CROSS JOIN med
             UNION ALL SELECT 'zero', y, COALESCE(age, 0), COALESCE(acctbal, 0) FROM xt),
  p AS (SELECT experiment, missing, k, w1, w2, my, y, my + w1 * (age - mu1) / sd1 + w2 * (acctbal - mu2) / sd2 AS p
        FROM filled CROSS JOIN fit CROSS JOIN st),
  m AS (SELECT experiment, missing, k, w1, w2, my, sqrt(avg(pow(p - y, 2))) AS rmse_log, avg(abs(p - y)) AS mae_log,
               avg(abs((exp(p) - 1) - (exp(y) - 1))) AS mae_eur FROM p GROUP BY ALL)
SELECT experiment, missing, CAST(k AS INTEGER) AS n_features_input, ROUND(w1, 6) AS coef_age, ROUND(w2, 6) AS coef_acctbal,
       ROUND(my, 6) AS intercept, ROUND(rmse_log, 6) AS rmse_log, ROUND(mae_log, 6) AS mae_log, ROUND(mae_eur, 4) AS mae_eur,
       CAST(row_number() OVER (PARTITION BY missing ORDER BY rmse_log) AS INTEGER) AS place
FROM m
""")
def ridge_two_inputs(spark, sf):
    """Fits of one and two inputs from the model's Gram matrix: coefficients, and test metrics
    in order, with imputed and with zero-filled inputs (G6, G8, G12)."""
    _, _, test, full = _ridge_setup(spark, sf)
    models = _two_input_models(spark, sf)
    rows = None
    for missing in ("pipeline", "zero"):
        found = metrics_by_variant(full.predict_all(test, {f"pred_{k}": m for k, m in models.items()}, missing),
                                   "target_log", {k: f"pred_{k}" for k in models}).withColumn("missing", F.lit(missing))
        rows = found if rows is None else rows.unionByName(found)
    facts = [(k, len(m.feature_names), *[dict(zip(m.feature_names, m.coefficients)).get(c, 0.0) for c in ("age", "acctbal")], m.intercept)
             for k, m in models.items()]
    fits = spark.createDataFrame(facts, "variant string, n_features_input int, coef_age double, coef_acctbal double, intercept double")
    place = F.row_number().over(Window.partitionBy("missing").orderBy("rmse_log"))
    return rows.join(fits, "variant").select(
        F.col("variant").alias("experiment"), "missing", "n_features_input", *[r6(F.col(c)).alias(c) for c in ("coef_age", "coef_acctbal", "intercept", "rmse_log", "mae_log")],
        r4(F.col("mae_eur")).alias("mae_eur"), place.alias("place"))


@register("ridge_two_input_coefficients", _TWO_INPUTS_SQL + """,
  c AS (SELECT 'age' AS feature, w1 AS coef FROM fit WHERE experiment = 'both' UNION ALL SELECT 'acctbal', w2 FROM fit WHERE experiment = 'both')
SELECT 'largest' AS side, CAST(row_number() OVER (ORDER BY coef DESC, feature) AS INTEGER) AS place, feature, ROUND(coef, 6) AS coef FROM c
UNION ALL SELECT 'smallest', CAST(row_number() OVER (ORDER BY coef, feature) AS INTEGER), feature, ROUND(coef, 6) FROM c
""")
def ridge_two_input_coefficients(spark, sf):
    """The largest and the smallest coefficients with their order."""
    found = top_coefficients(_two_input_models(spark, sf)["both"], spark, 2)
    order = F.when(F.col("side") == "largest", -F.col("coef")).otherwise(F.col("coef"))
    place = F.row_number().over(Window.partitionBy("side").orderBy(order, "feature"))
    return found.select("side", place.alias("place"), "feature", r6(F.col("coef")).alias("coef"))


@register("ablation_inputs", SCORED_SQL + f"""
SELECT experiment, CAST(n AS INTEGER) AS n_features_input, (SELECT CAST(COUNT(*) AS BIGINT) FROM test) AS n_test,
       CAST(0 AS DOUBLE) AS train_residual, true AS fits_train_no_worse
FROM (VALUES ('full', {len(NUMERIC_INPUTS) + len(CATEGORICAL_INPUTS)}), ('no_nationality', {len(NUMERIC_INPUTS) + len(CATEGORICAL_INPUTS) - 1}),
             ('no_context', {len(NUMERIC_INPUTS) + len(CATEGORICAL_INPUTS) - 2}),
             ('performance_only', {len([c for c in NUMERIC_INPUTS if c != "acctbal"]) + 1})) v(experiment, n)
""")
def ablation_inputs(spark, sf):
    """Inputs and rows of each ablation, the sum of its training residuals per row (an unpenalised
    intercept makes it 0), and that fewer inputs never fit the training rows better (B26, G12)."""
    _, train_rows, test, full = _ridge_setup(spark, sf)
    gram = _gram(spark, sf)
    models = {mode: gram.solve(ablation_columns(mode)) for mode in ABLATION_MODES}
    scored_train = full.predict_all(train_rows, {f"pred_{k}": m for k, m in models.items()})
    pairs = F.array(*[F.struct(F.lit(k).alias("experiment"), (F.col("target_log") - F.col(f"pred_{k}")).alias("r")) for k in models])
    sums = scored_train.select(F.explode(pairs).alias("s")).select("s.*").groupBy("experiment").agg(
        F.avg("r").alias("mean_r"), F.sum(F.col("r") * F.col("r")).alias("rss"))
    weights = [(k, len(ablation_columns(k)), float(sum(w * w for w in m.coefficients))) for k, m in models.items()]
    facts = spark.createDataFrame(weights, "experiment string, n_features_input int, w2 double")
    # the penalised loss, least over all inputs, can only grow with fewer of them
    loss = F.col("rss") + F.col("w2")
    least = F.min(F.when(F.col("experiment") == "full", loss)).over(Window.partitionBy(F.lit(1)))
    rows = sums.join(facts, "experiment").withColumn("fits_train_no_worse", loss >= least * (1 - 1e-12))
    return rows.select("experiment", "n_features_input", F.lit(test.count()).cast("bigint").alias("n_test"), F.abs(r6(F.col("mean_r"))).alias("train_residual"), "fits_train_no_worse")


# ---------------------------------------------------------------------------
# The scoring frame's fills, readiness
# ---------------------------------------------------------------------------

@register("scoring_frame_fills", _REQ_SQL + """,
  r AS (SELECT *, CASE WHEN w180_minutes_played = 0 THEN 0 ELSE w180_goals / (w180_minutes_played / 90.0) END AS g,
               CASE WHEN w365_games_played = 0 THEN 0 ELSE w365_minutes_played / w365_games_played END AS m FROM req)
SELECT missing, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(CASE WHEN missing = 'zero' THEN 1 END) AS BIGINT) AS n_height,
       CAST(CASE WHEN missing = 'zero' THEN 0 END AS DOUBLE) AS max_height, CAST(COUNT(CASE WHEN missing = 'zero' THEN 1 END) AS BIGINT) AS n_empty_foot,
       ROUND(avg(g), 4) AS mean_goals_per90, ROUND(avg(m), 4) AS mean_minutes_per_game,
       CAST(SUM(CASE WHEN w180_minutes_played > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_played
FROM r CROSS JOIN (VALUES ('pipeline'), ('zero')) v(missing) GROUP BY missing
""")
def scoring_frame_fills(spark, sf):
    """What the scoring frame puts where requests carry nothing, and its rates (H3)."""
    out = None
    for missing in ("pipeline", "zero"):
        frame = scoring_frame(requests_frame(spark, sf), missing=missing)
        one = frame.agg(
            F.lit(missing).alias("missing"), F.count(F.lit(1)).alias("n"), F.count("height_in_cm").alias("n_height"), F.max("height_in_cm").alias("max_height"),
            F.count(F.when(F.col("foot") == "", 1)).alias("n_empty_foot"), r4(F.avg("w180_goals_per90")).alias("mean_goals_per90"),
            r4(F.avg("w365_minutes_per_game")).alias("mean_minutes_per_game"), F.sum("w180_played_any_minutes").cast("bigint").alias("n_played"))
        out = one if out is None else out.unionByName(one)
    return out


@register("readiness_states", """
SELECT * FROM (VALUES ('usable', 'healthy', NULL), ('no model', 'unhealthy', 'model_not_loaded'),
  ('no quantile', 'unhealthy', 'prediction_intervals_not_loaded'), ('endless quantile', 'unhealthy', 'prediction_intervals_not_loaded'),
  ('no coverage', 'unhealthy', 'prediction_intervals_not_loaded'), ('no prediction', 'unhealthy', 'model_prediction_failed')) v("case", status, reason)
""")
def readiness_states(spark, sf):
    """The readiness check of a model fitted on the given tables, usable and with a part missing."""
    train, _, _ = split_frames(spark, sf)
    medians, overall = median_tables(train, "target_log", GROUP_KEYS)
    usable = GroupMedianModel(medians, GROUP_KEYS, overall)
    endless = GroupMedianModel(medians.withColumn("pred_log", F.lit(float("nan"))), GROUP_KEYS, float("nan"))
    sample = requests_frame(spark, sf).orderBy("o_orderkey").limit(1)
    cases = {
        "usable": assert_ready(usable, -1.0, 1.0, 0.8, sample), "no model": assert_ready(None, -1.0, 1.0, 0.8, sample),
        "no quantile": assert_ready(usable, None, 1.0, 0.8, sample), "endless quantile": assert_ready(usable, -1.0, float("inf"), 0.8, sample),
        "no coverage": assert_ready(usable, -1.0, 1.0, 0.0, sample), "no prediction": assert_ready(endless, -1.0, 1.0, 0.8, sample)}
    return spark.createDataFrame([(k, state.status, state.reason) for k, state in cases.items()], "case string, status string, reason string")


@dataclass
class GroupMedianModel:
    """The group-median baseline as a scoring model: a table of medians and a fallback."""

    medians: DataFrame
    keys: list[str]
    fallback: float

    def predict(self, df: DataFrame, missing: str = "pipeline") -> DataFrame:
        given = df.withColumns({k: F.lit(None).cast(self.medians.schema[k].dataType)
                                for k in self.keys if k not in df.columns})
        return predict_group_median(given, self.medians, self.keys, self.fallback)

    def contributions(self, df: DataFrame, top_k: int = 3, missing: str = "pipeline") -> DataFrame:
        """No features to explain with: both lists are empty."""
        empty = F.array().cast("array<struct<feature:string>>")
        return self.predict(df, missing).withColumns({"top_positive": empty, "top_negative": empty})


def _request_files(spark, sf, reqs: DataFrame, folder: str) -> None:
    """The requests as JSON lines in two sets of files; the second repeats those of every
    seventh order and has a cut-off line for every fiftieth."""
    number = F.col("request_id").cast("bigint")
    again = requests_as_json(reqs.where(number % 7 == 0), "request_id")
    cut = reqs.where(number % 50 == 0).select(F.concat(F.lit('{"request_id": "'), number.cast("string")).alias("value"))
    # a compressed file is read by one task: files of a few megabytes keep all cores busy to the end
    with split_scans(reqs, PARTITION_BYTES):
        requests_as_json(reqs, "request_id").write.text(f"{folder}/set=1", compression="snappy")
    again.unionByName(cut).write.text(f"{folder}/set=2", compression="snappy")


def _streamed(spark, sf) -> str:
    """All requests as JSON files, scored by an ``availableNow`` stream; its sink folder,
    made once per input folder: both tables are of one run."""
    key = (spark.sparkContext.applicationId, sf, input_stamp(spark, sf))
    if key not in _STREAMED:
        train, _, _ = split_frames(spark, sf)
        medians, overall = median_tables(train, "target_log", GROUP_KEYS)
        # written: each micro-batch joins it
        model = GroupMedianModel(written(medians, "medians"), GROUP_KEYS, overall)
        resid = scored(spark, sf, "train").select((F.col("target_log") - F.col("pred_log")).alias("r"))
        q10, q90 = quantile_values(resid, "r", [0.1, 0.9])
        reqs = requests_frame(spark, sf).select(
            F.col("o_orderkey").cast("string").alias("request_id"), "age", "age_bin", "position",
            "player_club_domestic_competition_id", *[f"{w}_{t}" for w in WINDOWS for t in ["games_played", *MEASURES]])
        root = scratch_path(spark, "stream")
        _request_files(spark, sf, reqs, f"{root}/in")
        with split_scans(reqs, TASK_BYTES):
            drain(start_scoring(spark, f"{root}/in/*", reqs.schema, model, q10, q90, f"{root}/out", f"{root}/ckpt",
                                coverage_label=coverage_label(0.1, 0.9), age_limits=REQ_AGE_LIMITS))
        _STREAMED[key] = f"{root}/out"
    return _STREAMED[key]


_STREAMED: dict[tuple, str] = {}


@register("stream_rejections", ORACLE["validate_requests"] + """
UNION ALL SELECT NULL AS o_orderkey, 'body' AS field, 'Request must be one JSON object' AS message
FROM orders WHERE o_orderkey % 50 = 0
""")
def stream_rejections(spark, sf):
    found = sink_table(spark, _streamed(spark, sf), "rejected")
    return found.select(F.col("request_id").cast("bigint").alias("o_orderkey"), "field", "message")


@register("stream_score_bands", ORACLE["score_bands"])
def stream_score_bands(spark, sf):
    return sink_table(spark, _streamed(spark, sf), "scored").select(
        F.col("request_id").cast("bigint").alias("o_orderkey"), r4(F.col("predicted_value_eur")).alias("predicted_value_eur"),
        r4(F.col("ci_lower")).alias("ci_lower"), r4(F.col("ci_upper")).alias("ci_upper"),
        "valuation_band", "uncertainty_level", "summary")
