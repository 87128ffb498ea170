"""The query pack: every operator run on the TPC-H-style test tables.

Mapping of the reference's roles onto the star schema (see FIXTURES.md §3):

* entity = customer (``c_custkey``), label = ``c_mktsegment``, nationality =
  ``nation.n_name``;
* anchor = an order: (``o_custkey``, ``o_orderdate``), value = ``o_totalprice``,
  ``target_log = log1p(o_totalprice)``;
* fact = a line item joined to its order: (``o_custkey``, ``l_shipdate``) with
  minutes = ``l_quantity``, goals = ``l_extendedprice``, assists =
  ``l_discount``, yellow cards = ``l_tax``, red cards = returned flag;
* "age" of an anchor = years since the customer's first order (tenure).

Each query is a function ``(spark, sf_dir) -> DataFrame`` and, where the
result is SQL-expressible, the matching DuckDB SQL is in ``ORACLE``. Every
computed column is aliased identically on both sides and floating results
are rounded the same way (``round(x, 6)``) because summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import (age_years, clean_category, completed_years, exact_label_map, full_name,
                                keyword_bucket, log_target, null_outside, substring_label_map, three_way_bucket)
from ..operators.cleaning import FOOT_EXACT, FOOT_SUBSTRING, POSITION_RULES, add_age_at_anchor
from ..operators.model import fit_gram, fit_preprocessing, top_coefficients
from ..operators.report import (BIAS_FLAGS, COVERAGE_FLAGS, LEAGUE_FALLBACK, build_report, report_lines,
                                report_overall, top_group_risks)
from ..operators.scoring import (STAT_GROUPS, coverage_label, point_and_interval, rejection_rows, scout_columns,
                                 validate_requests)
from ..operators.baselines import (add_age_bin, fit_predict_group_median, group_medians, median_tables,
                                   predict_group_median)
from ..operators.features import (add_rate_features, apply_collapse, category_counts, collapse_rare_categories,
                                  fit_top_categories, select_feature_group)
from ..operators.groups import attach_names, clean_games, group_performance, missing_keys, patched_dimension
from ..operators.profiling import null_counts, null_fraction_top, null_stats, profile_tables
from ..operators.lookback import lookback_aggregate
from ..operators.split import iso_date, split_summary, time_split
from ..operators.stats import (add_error_columns, calibration_table, error_by_group, error_summary, error_tables,
                               group_smearing, histogram, metrics_by_variant, quantile_values, top_n)
from ..session import SCAN_BYTES, input_stamp, materialize, scratch_path, written, written_table
from ..streaming.scoring_stream import drain, requests_as_json, sink_table, start_scoring
from .diagnostics import error_analysis, global_bias_correction, groupwise_bias_correction, prediction_intervals
from ..sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = spark_rounding(sql.strip())
        return fn
    return deco


def spark_rounding(sql: str) -> str:
    """Rewrite ``ROUND(x, d)`` so DuckDB rounds like Spark's ``round``.

    Spark rounds HALF_UP on the shortest decimal text of the double
    (0.1209375 → 0.120938); DuckDB rounds the binary value (→ 0.120937).
    Rounding the decimal text in the oracle too makes ties agree."""
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k, comma = 0, j + len("ROUND("), None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        arg, digits = spark_rounding(sql[j + 6:comma]), sql[comma + 1:k].strip()
        out.append(f"CAST(ROUND(CAST(CAST(({arg}) AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)")
        i = k + 1


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------

MEASURES = ["minutes_played", "goals", "assists", "yellow_cards", "red_cards"]


def measure_columns():
    """Fact measure expressions (built lazily: a Column needs an active session)."""
    return {
        "minutes_played": F.col("l_quantity"),
        "goals": F.col("l_extendedprice"),
        "assists": F.col("l_discount"),
        "yellow_cards": F.col("l_tax"),
        "red_cards": (F.col("l_returnflag") == "R").cast("int"),
    }
WINDOWS = {"w180": 180, "w365": 365}


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their order's customer (fact rows of an entity)."""
    li = read_table(spark, sf, "lineitem",
                    ["l_orderkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").drop("o_orderkey")


def anchors(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return o.withColumn("anchor_date", F.to_date("o_orderdate"))


def lookback_frame(spark: SparkSession, sf: str) -> DataFrame:
    return lookback_aggregate(
        anchors(spark, sf), facts(spark, sf),
        entity="o_custkey", anchor_time="o_orderdate", fact_time="l_shipdate",
        measures=measure_columns(), windows=WINDOWS, count_name="games_played",
    )


_LOOKBACK_COLS = [f"{w}_{m}" for w in WINDOWS for m in ["games_played", *MEASURES]]

_FACTS_SQL = """
  f AS (SELECT o.o_custkey AS e, CAST(l.l_shipdate AS DATE) AS d,
               l.l_quantity AS minutes_played, l.l_extendedprice AS goals, l.l_discount AS assists,
               l.l_tax AS yellow_cards, CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS red_cards
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
  a AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS anchor_date, o_totalprice FROM orders)"""


def _lookback_sql_select(round_sums: bool = True) -> str:
    parts = []
    for w, days in WINDOWS.items():
        cond = f"f.d >= a.anchor_date - {days}"
        parts.append(f"CAST(COUNT(CASE WHEN {cond} THEN 1 END) AS BIGINT) AS {w}_games_played")
        for m in MEASURES:
            expr = f"COALESCE(SUM(CASE WHEN {cond} THEN f.{m} END), 0.0)"
            parts.append(f"ROUND({expr}, 6) AS {w}_{m}" if round_sums else f"{expr} AS {w}_{m}")
    return ",\n       ".join(parts)


LOOKBACK_SQL_CTE = f"""
WITH {_FACTS_SQL.strip()},
  lb AS (SELECT a.o_orderkey, a.o_custkey, a.anchor_date, a.o_totalprice,
       {_lookback_sql_select(round_sums=True)}
  FROM a LEFT JOIN f ON f.e = a.o_custkey AND f.d < a.anchor_date AND f.d >= a.anchor_date - 365
  GROUP BY a.o_orderkey, a.o_custkey, a.anchor_date, a.o_totalprice)"""


# ---------------------------------------------------------------------------
# Lookback totals, B22–B24: rate features
# ---------------------------------------------------------------------------

@register("lookback_totals", f"""
WITH {_FACTS_SQL.strip()}
SELECT a.o_orderkey, a.o_custkey, a.anchor_date,
       {_lookback_sql_select()}
FROM a LEFT JOIN f ON f.e = a.o_custkey AND f.d < a.anchor_date AND f.d >= a.anchor_date - 365
GROUP BY a.o_orderkey, a.o_custkey, a.anchor_date
""")
def lookback_totals(spark, sf):
    lb = written(lookback_frame(spark, sf), "lookback", SCAN_BYTES)
    return lb.select("o_orderkey", "o_custkey", "anchor_date",
                     *[F.col(c) if c.endswith("games_played") else r6(F.col(c)).alias(c) for c in _LOOKBACK_COLS])


_RATE_NAMES = ["minutes_per_game", "goals_per90", "assists_per90", "g_plus_a_per90", "yellow_per90", "red_per90"]


def _rates_sql() -> str:
    parts = []
    for w in WINDOWS:
        m, g = f"{w}_minutes_played", f"{w}_games_played"
        n90 = f"({m} / 90.0)"

        def sdiv(num, den):
            return f"CASE WHEN {den} = 0 OR {den} IS NULL THEN 0.0 ELSE {num} / {den} END"
        parts.append(f"ROUND({sdiv(m, g)}, 6) AS {w}_minutes_per_game")
        parts.append(f"ROUND({sdiv(f'{w}_goals', n90)}, 6) AS {w}_goals_per90")
        parts.append(f"ROUND({sdiv(f'{w}_assists', n90)}, 6) AS {w}_assists_per90")
        parts.append(f"ROUND({sdiv(f'({w}_goals + {w}_assists)', n90)}, 6) AS {w}_g_plus_a_per90")
        parts.append(f"ROUND({sdiv(f'{w}_yellow_cards', n90)}, 6) AS {w}_yellow_per90")
        parts.append(f"ROUND({sdiv(f'{w}_red_cards', n90)}, 6) AS {w}_red_per90")
        parts.append(f"CAST(CASE WHEN {m} > 0 THEN 1 ELSE 0 END AS INTEGER) AS {w}_played_any_minutes")
    return ",\n       ".join(parts)


@register("lookback_rates", f"""{LOOKBACK_SQL_CTE}
SELECT o_orderkey,
       {_rates_sql()}
FROM lb
""")
def lookback_rates(spark, sf):
    # window sums of 2-decimal amounts are normalised to 6 decimals before the
    # rates, so both engines divide bit-identical inputs whatever their
    # summation order
    lb = written(lookback_frame(spark, sf), "lookback", SCAN_BYTES)
    lb = lb.withColumns({f"{w}_{m}": r6(F.col(f"{w}_{m}")) for w in WINDOWS for m in MEASURES})
    lb = add_rate_features(lb, list(WINDOWS))
    cols = []
    for w in WINDOWS:
        cols += [r6(F.col(f"{w}_{n}")).alias(f"{w}_{n}") for n in _RATE_NAMES]
        cols.append(F.col(f"{w}_played_any_minutes"))
    return lb.select("o_orderkey", *cols)


# ---------------------------------------------------------------------------
# Model rows: anchors ⟕ entity attributes, tenure "age", log target
# ---------------------------------------------------------------------------

AGE_EDGES = [0, 1, 2, 3, 4, 5, 100]   # tenure years; the reference bins ages with [0, 18, …, 100)
GROUP_KEYS = ["position", "age_bin"]


def model_base(spark: SparkSession, sf: str) -> DataFrame:
    """The anchor table, written once per input folder and read back (see
    :func:`tidewater.session.written_table`): every split, baseline and
    diagnostic starts from it, as the reference's steps start from its
    feature file."""
    return written_table(spark, f"anchors:{sf}", lambda: build_model_base(spark, sf), sf)


def build_model_base(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with customer label, nation, tenure age, bin and log target."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    df = (o.join(first, "o_custkey", "left")
          .join(c, o["o_custkey"] == c["c_custkey"], "left")
          .join(n, c["c_nationkey"] == n["n_nationkey"], "left"))
    df = df.select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.to_date("o_orderdate").alias("anchor_date"),
        F.col("o_totalprice").alias("value"),
        log_target("o_totalprice").alias("target_log"),
        clean_category("c_mktsegment").alias("position"),
        clean_category("n_name").alias("nationality"),
        age_years("o_orderdate", "first_date").alias("age"),
    )
    return add_age_bin(df, "age", AGE_EDGES)


_CUTOFFS: dict[tuple, tuple] = {}


def _split(spark: SparkSession, sf: str):
    """Cutoff and split statistics of the model rows, from one aggregate by day (kept per
    application and input folder, like a training artifact)."""
    key = (spark.sparkContext.applicationId, sf, input_stamp(spark, sf))
    if key not in _CUTOFFS:
        _CUTOFFS[key] = split_summary(model_base(spark, sf).select("anchor_date"), "anchor_date", 0.8)
    return _CUTOFFS[key]


def cutoff_for(spark: SparkSession, sf: str):
    """E5 cutoff of the model rows."""
    return _split(spark, sf)[0]


def split_frames(spark: SparkSession, sf: str):
    base = model_base(spark, sf)
    train, test, cutoff = time_split(base, "anchor_date", cutoff=cutoff_for(spark, sf), raw_col="o_orderdate")
    return train, test, cutoff


def scored(spark: SparkSession, sf: str, side: str = "test") -> DataFrame:
    """Rows of one side with the position × age-bin median prediction (G11) and EUR errors.

    Both sides are scored by one fit and written once per input: the diagnostics
    run several statistics passes (sums, exact medians, decile edges) over them,
    each a pruned scan."""
    def build():
        train, _, cutoff = split_frames(spark, sf)
        base = model_base(spark, sf).where(F.col("anchor_date").isNotNull())
        pred = fit_predict_group_median(train, base, "target_log", GROUP_KEYS)
        late = F.col("anchor_date") >= F.lit(cutoff)
        return add_error_columns(pred, "pred_log", "value").withColumn(
            "side", F.when(late, "test").otherwise("train"))

    return written_table(spark, f"scored:{sf}", build, sf).where(F.col("side") == side).drop("side")


def _age_bin_sql(col: str = "age") -> str:
    parts = [f"WHEN {col} >= {AGE_EDGES[i]} AND {col} < {AGE_EDGES[i + 1]} THEN {i}" for i in range(len(AGE_EDGES) - 1)]
    return "CASE " + " ".join(parts) + " END"


BASE_SQL = f"""
  base0 AS (
    SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS anchor_date, o.o_totalprice AS value,
           ln(1 + o.o_totalprice) AS target_log,
           regexp_replace(COALESCE(c.c_mktsegment, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS position,
           regexp_replace(COALESCE(n.n_name, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS nationality,
           date_diff('day', CAST(fo.first_date AS DATE), CAST(o.o_orderdate AS DATE)) / 365.25 AS age
    FROM orders o
    LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_date FROM orders GROUP BY o_custkey) fo
           ON fo.o_custkey = o.o_custkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
  base AS (SELECT *, {_age_bin_sql()} AS age_bin FROM base0),
  ranked AS (SELECT anchor_date, row_number() OVER (ORDER BY anchor_date) - 1 AS rn FROM base),
  cut AS (SELECT anchor_date AS cutoff FROM ranked
          WHERE rn = (SELECT CAST(FLOOR(COUNT(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM base)),
  train AS (SELECT base.* FROM base, cut WHERE anchor_date < cutoff),
  test AS (SELECT base.* FROM base, cut WHERE anchor_date >= cutoff),
  gmed AS (SELECT median(target_log) AS m FROM train),
  grp AS (SELECT position, age_bin, median(target_log) AS pred_log FROM train
          WHERE position IS NOT NULL AND age_bin IS NOT NULL GROUP BY position, age_bin)"""


def _scored_sql(side: str) -> str:
    return f"""
  {side}_pred AS (
    SELECT t.*, COALESCE(g.pred_log, gmed.m) AS pred_log FROM {side} t CROSS JOIN gmed
    LEFT JOIN grp g ON g.position = t.position AND g.age_bin = t.age_bin),
  {side}_err AS (
    SELECT *, GREATEST(exp(pred_log) - 1, 0) AS pred_eur, GREATEST(value, 0) AS actual_eur,
           GREATEST(exp(pred_log) - 1, 0) - GREATEST(value, 0) AS signed_err_eur,
           abs(GREATEST(exp(pred_log) - 1, 0) - GREATEST(value, 0)) AS abs_err_eur
    FROM {side}_pred)"""


SCORED_SQL = "WITH " + BASE_SQL.strip() + "," + _scored_sql("test") + "," + _scored_sql("train")


def r4(c):
    return F.round(c, 4)


# ---------------------------------------------------------------------------
# Valid-row view and its count
# ---------------------------------------------------------------------------

@register("model_rows_count", """
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM orders WHERE o_totalprice IS NOT NULL AND o_totalprice >= 0
""")
def model_rows_count(spark, sf):
    o = read_table(spark, sf, "orders", ["o_totalprice"])
    view = o.where(F.col("o_totalprice").isNotNull() & (F.col("o_totalprice") >= 0))
    view.createOrReplaceTempView("v_model_rows")
    return spark.sql("SELECT COUNT(*) AS n_rows FROM v_model_rows")


# ---------------------------------------------------------------------------
# Time split
# ---------------------------------------------------------------------------

@register("time_split", "WITH " + BASE_SQL.strip() + """
SELECT cutoff AS cutoff_date,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM train) AS n_train,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM test) AS n_test
FROM cut
""")
def time_split_query(spark, sf):
    cutoff, sides = _split(spark, sf)
    count = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0)).alias(f"n_{side}")
    return sides.agg(count("train"), count("test")).select(F.lit(cutoff).alias("cutoff_date"), "n_train", "n_test")


@register("split_stats", "WITH " + BASE_SQL.strip() + """
SELECT CASE WHEN anchor_date < cutoff THEN 'train' ELSE 'test' END AS side,
       CAST(COUNT(*) AS BIGINT) AS n, MIN(anchor_date) AS date_min, MAX(anchor_date) AS date_max
FROM base, cut GROUP BY 1
""")
def split_stats_query(spark, sf):
    return _split(spark, sf)[1]


# ---------------------------------------------------------------------------
# baselines
# ---------------------------------------------------------------------------

@register("group_median_table", "WITH " + BASE_SQL.strip() + """
SELECT position, age_bin, ROUND(pred_log, 6) AS median_target_log FROM grp
""")
def group_median_table(spark, sf):
    train, _, _ = split_frames(spark, sf)
    return group_medians(train, "target_log", GROUP_KEYS, out="m").select(
        "position", "age_bin", r6(F.col("m")).alias("median_target_log"))


@register("baseline_metrics", SCORED_SQL + """
SELECT 'global_median' AS model,
       ROUND(sqrt(avg(pow(gmed.m - target_log, 2))), 6) AS rmse_log,
       ROUND(avg(abs(gmed.m - target_log)), 6) AS mae_log,
       ROUND(avg(abs((exp(gmed.m) - 1) - (exp(target_log) - 1))), 4) AS mae_eur
FROM test CROSS JOIN gmed
UNION ALL
SELECT 'position_age_median' AS model,
       ROUND(sqrt(avg(pow(pred_log - target_log, 2))), 6) AS rmse_log,
       ROUND(avg(abs(pred_log - target_log)), 6) AS mae_log,
       ROUND(avg(abs((exp(pred_log) - 1) - (exp(target_log) - 1))), 4) AS mae_eur
FROM test_pred
""")
def baseline_metrics(spark, sf):
    train, test, _ = split_frames(spark, sf)
    medians, overall = median_tables(train, "target_log", GROUP_KEYS)
    both = predict_group_median(test, medians, GROUP_KEYS, overall).withColumn("pred_all", F.lit(overall))
    found = metrics_by_variant(both, "target_log", {"global_median": "pred_all", "position_age_median": "pred_log"})
    return found.select(F.col("variant").alias("model"), r6(F.col("rmse_log")).alias("rmse_log"),
                        r6(F.col("mae_log")).alias("mae_log"), r4(F.col("mae_eur")).alias("mae_eur"))


# ---------------------------------------------------------------------------
# Error analysis on the test side
# ---------------------------------------------------------------------------

@register("error_summary", SCORED_SQL + """
SELECT CAST(COUNT(*) AS BIGINT) AS n_test_rows, CAST((SELECT cutoff FROM cut) AS VARCHAR) AS cutoff_date,
       ROUND(avg(abs_err_eur), 4) AS mae_eur, ROUND(median(abs_err_eur), 4) AS median_abs_err_eur,
       ROUND(avg(signed_err_eur), 4) AS mean_signed_err_eur
FROM test_err
""")
def error_summary_query(spark, sf):
    s = error_summary(scored(spark, sf))
    return s.select("n_test_rows", F.lit(iso_date(cutoff_for(spark, sf))).alias("cutoff_date"),
                    r4(F.col("mae_eur")).alias("mae_eur"), r4(F.col("median_abs_err_eur")).alias("median_abs_err_eur"),
                    r4(F.col("mean_signed_err_eur")).alias("mean_signed_err_eur"))


def _by_group_sql(col: str) -> str:
    return SCORED_SQL + f"""
SELECT {col}, CAST(COUNT(actual_eur) AS BIGINT) AS n, ROUND(avg(abs_err_eur), 4) AS mae_eur,
       ROUND(median(abs_err_eur), 4) AS median_abs_err, ROUND(avg(signed_err_eur), 4) AS mean_signed_err
FROM test_err GROUP BY {col}
"""


def _by_group(spark, sf, col):
    g = error_by_group(scored(spark, sf), col)
    return g.select(col, "n", *[r4(F.col(c)).alias(c) for c in ["mae_eur", "median_abs_err", "mean_signed_err"]])


@register("error_by_position", _by_group_sql("position"))
def error_by_position(spark, sf):
    return _by_group(spark, sf, "position")


@register("error_by_league", _by_group_sql("nationality"))
def error_by_league(spark, sf):
    return _by_group(spark, sf, "nationality")


_TOP_COLS = "o_orderkey, anchor_date, position, nationality"


@register("top_errors", SCORED_SQL + f"""
SELECT * FROM (
  (SELECT 'over' AS kind, {_TOP_COLS}, ROUND(actual_eur, 4) AS actual_eur, ROUND(pred_eur, 4) AS pred_eur,
          ROUND(signed_err_eur, 4) AS signed_err_eur, ROUND(abs_err_eur, 4) AS abs_err_eur
   FROM test_err ORDER BY signed_err_eur DESC, o_orderkey LIMIT 50)
  UNION ALL
  (SELECT 'under' AS kind, {_TOP_COLS}, ROUND(actual_eur, 4) AS actual_eur, ROUND(pred_eur, 4) AS pred_eur,
          ROUND(signed_err_eur, 4) AS signed_err_eur, ROUND(abs_err_eur, 4) AS abs_err_eur
   FROM test_err ORDER BY signed_err_eur ASC, o_orderkey LIMIT 50))
""")
def top_errors(spark, sf):
    s = scored(spark, sf)
    cols = ["o_orderkey", "anchor_date", "position", "nationality"]
    vals = [r4(F.col(c)).alias(c) for c in ["actual_eur", "pred_eur", "signed_err_eur", "abs_err_eur"]]
    over = top_n(s, "signed_err_eur", 50, True, ["o_orderkey"]).select(F.lit("over").alias("kind"), *cols, *vals)
    under = top_n(s, "signed_err_eur", 50, False, ["o_orderkey"]).select(F.lit("under").alias("kind"), *cols, *vals)
    return over.unionByName(under)


def _deciles_sql(pred: str, source: str) -> str:
    return f"""
  edges AS (SELECT DISTINCT unnest(quantile_cont({pred}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e
            FROM {source}),
  binned AS (SELECT s.*, GREATEST((SELECT COUNT(*) FROM edges WHERE edges.e < s.{pred}) - 1, 0) AS decile
             FROM {source} s)"""


@register("calibration_deciles", SCORED_SQL + "," + _deciles_sql("pred_eur", "test_err") + """
SELECT CAST(decile AS INTEGER) AS decile, ROUND(avg(pred_eur), 4) AS pred_mean,
       ROUND(avg(actual_eur), 4) AS actual_mean, CAST(COUNT(actual_eur) AS BIGINT) AS n
FROM binned GROUP BY decile
""")
def calibration_deciles(spark, sf):
    cal = calibration_table(scored(spark, sf), "pred_eur", "actual_eur", 10)
    return cal.select("decile", r4(F.col("pred_mean")).alias("pred_mean"),
                      r4(F.col("actual_mean")).alias("actual_mean"), "n")


@register("residual_histogram", SCORED_SQL + """,
  r AS (SELECT pred_log - target_log AS resid FROM test_pred),
  mm AS (SELECT min(resid) AS lo, max(resid) AS hi FROM r)
SELECT CAST(LEAST(FLOOR((resid - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, CAST(COUNT(*) AS BIGINT) AS n
FROM r CROSS JOIN mm GROUP BY 1
""")
def residual_histogram(spark, sf):
    s = scored(spark, sf).withColumn("resid", F.col("pred_log") - F.col("target_log"))
    return histogram(s, "resid", 60).select("bin", "n")


# ---------------------------------------------------------------------------
# Smearing bias corrections
# ---------------------------------------------------------------------------

_SMEAR_SQL = SCORED_SQL + """,
  sm AS (SELECT avg(exp(target_log - pred_log)) AS s FROM train_pred),
  gs AS (SELECT nationality, avg(exp(target_log - pred_log)) AS s FROM train_pred
         WHERE nationality IS NOT NULL GROUP BY nationality)"""


def _variant_sql(variants: str, extra: str = "") -> str:
    return _SMEAR_SQL + f""",
  v AS ({variants})
SELECT variant, CAST(COUNT(actual_eur) AS BIGINT) AS n, ROUND(avg(abs(p - actual_eur)), 4) AS mae_eur, ROUND(median(abs(p - actual_eur)), 4) AS median_abs_err_eur,
       ROUND(avg(p - actual_eur), 4) AS mean_signed_err_eur{extra}
FROM v GROUP BY variant
"""


def _variants_out(df):
    return df.select("variant", "n", *[r4(F.col(c)).alias(c) for c in
                                  ["mae_eur", "median_abs_err_eur", "mean_signed_err_eur"]])


@register("smearing_global", _variant_sql(
    "SELECT 'baseline' AS variant, actual_eur, pred_eur AS p FROM test_err UNION ALL "
    "SELECT 'bias_corrected' AS variant, actual_eur, GREATEST(pred_eur * sm.s, 0) AS p FROM test_err CROSS JOIN sm",
    ", ROUND((SELECT s FROM sm), 6) AS smearing_factor"))
def smearing_global(spark, sf):
    bc = global_bias_correction(scored(spark, sf, "train"), scored(spark, sf), actual="value")
    return _variants_out(bc.comparison).withColumn("smearing_factor", F.round(F.lit(bc.factor), 6))


@register("calibration_bias_corrected", _SMEAR_SQL + """,
  bc AS (SELECT GREATEST(pred_eur * sm.s, 0) AS pred_bc, actual_eur FROM test_err CROSS JOIN sm),""" +
          _deciles_sql("pred_bc", "bc").rstrip() + """
SELECT CAST(decile AS INTEGER) AS decile, ROUND(avg(pred_bc), 4) AS pred_mean,
       ROUND(avg(actual_eur), 4) AS actual_mean, CAST(COUNT(actual_eur) AS BIGINT) AS n
FROM binned GROUP BY decile
""")
def calibration_bias_corrected(spark, sf):
    cal = global_bias_correction(scored(spark, sf, "train"), scored(spark, sf), actual="value").calibration
    return cal.select("decile", r4(F.col("pred_mean")).alias("pred_mean"),
                      r4(F.col("actual_mean")).alias("actual_mean"), "n")


@register("groupwise_smearing_factors", _SMEAR_SQL + """
SELECT nationality, ROUND(s, 6) AS smearing_factor FROM gs
""")
def groupwise_smearing_factors(spark, sf):
    t = group_smearing(scored(spark, sf, "train"), "nationality", "target_log", "pred_log")
    return t.select("nationality", r6(F.col("smearing_factor")).alias("smearing_factor"))


@register("smearing_groupwise", _variant_sql(
    "SELECT 'baseline' AS variant, actual_eur, pred_eur AS p FROM test_err UNION ALL "
    "SELECT 'groupwise_bias_corrected' AS variant, t.actual_eur, GREATEST(t.pred_eur * COALESCE(gs.s, sm.s), 0) AS p "
    "FROM test_err t LEFT JOIN gs ON gs.nationality = t.nationality CROSS JOIN sm",
    ", ROUND((SELECT s FROM sm), 6) AS global_fallback_smearing"))
def smearing_groupwise(spark, sf):
    bc = groupwise_bias_correction(scored(spark, sf, "train"), scored(spark, sf), group="nationality", actual="value")
    return _variants_out(bc.comparison).withColumn("global_fallback_smearing", F.round(F.lit(bc.factor), 6))


# ---------------------------------------------------------------------------
# Residual-quantile prediction intervals
# ---------------------------------------------------------------------------

_INTERVAL_SQL = SCORED_SQL + """,
  q AS (SELECT quantile_cont(target_log - pred_log, 0.1) AS q10, quantile_cont(target_log - pred_log, 0.5) AS q50,
               quantile_cont(target_log - pred_log, 0.9) AS q90 FROM train_pred),
  iv AS (SELECT t.o_orderkey, GREATEST(exp(pred_log + q10) - 1, 0) AS pred_eur_lower,
                GREATEST(exp(pred_log + q50) - 1, 0) AS pred_eur_median,
                GREATEST(exp(pred_log + q90) - 1, 0) AS pred_eur_upper, GREATEST(value, 0) AS actual_eur
         FROM test_pred t CROSS JOIN q)"""


@register("prediction_intervals", _INTERVAL_SQL + """
SELECT ROUND(q10, 6) AS q10, ROUND(q50, 6) AS q50, ROUND(q90, 6) AS q90,
       CAST((SELECT COUNT(*) FROM iv) AS BIGINT) AS n_test,
       ROUND((SELECT avg(CASE WHEN actual_eur >= pred_eur_lower AND actual_eur <= pred_eur_upper THEN 1.0 ELSE 0.0 END)
              FROM iv), 6) AS empirical_coverage,
       CAST(0.8 AS DOUBLE) AS target_coverage, '10-90' AS "interval"
FROM q
""")
def prediction_intervals_query(spark, sf):
    _, summary, _ = prediction_intervals(scored(spark, sf, "train"), scored(spark, sf), actual="value")
    return summary.select(r6(F.col("q10")).alias("q10"), r6(F.col("q50")).alias("q50"), r6(F.col("q90")).alias("q90"),
                          "n_test", r6(F.col("empirical_coverage")).alias("empirical_coverage"),
                          "target_coverage", "interval")


@register("interval_rows", _INTERVAL_SQL + """
SELECT o_orderkey, ROUND(pred_eur_lower, 4) AS pred_eur_lower, ROUND(pred_eur_median, 4) AS pred_eur_median,
       ROUND(pred_eur_upper, 4) AS pred_eur_upper, ROUND(actual_eur, 4) AS actual_eur
FROM iv
""")
def interval_rows(spark, sf):
    _, _, rows = prediction_intervals(scored(spark, sf, "train"), scored(spark, sf), actual="value")
    return rows.select("o_orderkey", *[r4(F.col(c)).alias(c) for c in
                                       ["pred_eur_lower", "pred_eur_median", "pred_eur_upper", "actual_eur"]])


# ---------------------------------------------------------------------------
# Group performance with a lookup
# ---------------------------------------------------------------------------

def _games(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_quantity", "l_linenumber", "l_returnflag"])
    g = clean_games(li.select(F.col("l_suppkey").alias("club_id"), F.col("l_orderkey").alias("game_id"),
                              F.col("l_quantity").alias("own_goals"), F.col("l_linenumber").alias("opponent_goals"),
                              (F.col("l_returnflag") == "R").cast("int").alias("is_win")),
                    ["club_id", "game_id"], ["own_goals", "opponent_goals"])
    return g


def _perf(spark, sf):
    return group_performance(_games(spark, sf), "club_id", "game_id", "own_goals", "opponent_goals", "is_win")


def _dim(spark, sf):
    """A dimension with real gaps: ``labels`` has some of the keys."""
    return read_table(spark, sf, "labels", ["doc_id"]).select(
        F.col("doc_id").alias("club_id"), F.concat(F.lit("Label "), F.col("doc_id").cast("string")).alias("name"))


def _patched(spark, sf, perf):
    """The dimension patched for the first three keys that the anti join finds missing."""
    gaps = missing_keys(perf, _dim(spark, sf), "club_id").orderBy("club_id").limit(3)
    return patched_dimension(_dim(spark, sf), "club_id", "name", [r["club_id"] for r in gaps.collect()])


_PERF_SQL = """
WITH perf AS (
  SELECT l_suppkey AS club_id, CAST(COUNT(l_orderkey) AS BIGINT) AS games_played,
         CAST(SUM(CAST(TRUNC(l_quantity) AS INTEGER)) AS BIGINT) AS goals_scored,
         CAST(SUM(l_linenumber) AS BIGINT) AS goals_conceded,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS wins
  FROM lineitem WHERE l_suppkey IS NOT NULL AND l_orderkey IS NOT NULL GROUP BY l_suppkey),
base AS (SELECT doc_id AS club_id, 'Label ' || CAST(doc_id AS VARCHAR) AS name FROM labels),
gaps AS (SELECT DISTINCT p.club_id FROM perf p WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.club_id = p.club_id)),
dim AS (SELECT club_id, name FROM base
        UNION ALL SELECT club_id, 'Club ' || CAST(club_id AS VARCHAR) AS name
                  FROM (SELECT club_id FROM gaps ORDER BY club_id LIMIT 3) g)"""


@register("group_performance", _PERF_SQL + """
SELECT club_id, games_played, goals_scored, goals_conceded, wins,
       ROUND(CAST(wins AS DOUBLE) / games_played * 100, 6) AS win_rate FROM perf
""")
def group_performance_query(spark, sf):
    p = _perf(spark, sf)
    return p.select("club_id", "games_played", "goals_scored", "goals_conceded", "wins",
                    r6(F.col("win_rate")).alias("win_rate"))


@register("named_top_groups", _PERF_SQL + """
SELECT p.club_id, COALESCE(d.name, 'Unknown Club') AS name, ROUND(CAST(wins AS DOUBLE) / games_played * 100, 6) AS win_rate
FROM perf p LEFT JOIN dim d ON d.club_id = p.club_id
ORDER BY win_rate DESC, p.club_id LIMIT 10
""")
def named_top_groups(spark, sf):
    perf = _perf(spark, sf)
    named = attach_names(perf, _patched(spark, sf, perf), "club_id", "name")
    return top_n(named, "win_rate", 10, True, ["club_id"]).select(
        "club_id", "name", r6(F.col("win_rate")).alias("win_rate"))


@register("missing_keys", _PERF_SQL + """
SELECT club_id FROM gaps
""")
def missing_keys_query(spark, sf):
    return missing_keys(_perf(spark, sf), _dim(spark, sf), "club_id")


# ---------------------------------------------------------------------------
# Rare-category collapse
# ---------------------------------------------------------------------------

@register("collapse_categories", """
WITH lp AS (SELECT regexp_replace(COALESCE(p.p_brand, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS p_brand,
                   regexp_replace(COALESCE(p.p_type, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS p_type
            FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
  b AS (SELECT p_brand AS v, row_number() OVER (ORDER BY COUNT(*) DESC, p_brand) AS rk FROM lp GROUP BY p_brand),
  t AS (SELECT p_type AS v, row_number() OVER (ORDER BY COUNT(*) DESC, p_type) AS rk FROM lp GROUP BY p_type)
SELECT CASE WHEN p_brand IN (SELECT v FROM b WHERE rk <= 10) THEN p_brand ELSE 'Other' END AS p_brand,
       CASE WHEN p_type IN (SELECT v FROM t WHERE rk <= 3) THEN p_type ELSE 'Other' END AS p_type,
       CAST(COUNT(*) AS BIGINT) AS n
FROM lp GROUP BY 1, 2
""")
def collapse_categories(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_partkey"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type"])
    lp = li.join(p, li["l_partkey"] == p["p_partkey"], "inner").select("p_brand", "p_type")
    c = collapse_rare_categories(lp, {"p_brand": 10, "p_type": 3})
    return c.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))


@register("category_counts", """
SELECT regexp_replace(COALESCE(n.n_name, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS nationality, CAST(COUNT(*) AS BIGINT) AS n
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1
""")
def category_counts_query(spark, sf):
    c = read_table(spark, sf, "customer", ["c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(F.col("n_name").alias("nationality"))
    return category_counts(j, "nationality")


# ---------------------------------------------------------------------------
# profiling
# ---------------------------------------------------------------------------

def _docs_labels(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    lab = read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return d.join(lab, "doc_id", "left")


_DL_SQL = """
WITH dl AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
  nc AS (SELECT * FROM (
    SELECT 'doc_id' AS "column", COUNT(*) - COUNT(doc_id) AS null_count, COUNT(*) AS n FROM dl UNION ALL
    SELECT 'text', COUNT(*) - COUNT(text), COUNT(*) FROM dl UNION ALL
    SELECT 'lang', COUNT(*) - COUNT(lang), COUNT(*) FROM dl UNION ALL
    SELECT 'source', COUNT(*) - COUNT(source), COUNT(*) FROM dl UNION ALL
    SELECT 'n_chars', COUNT(*) - COUNT(n_chars), COUNT(*) FROM dl UNION ALL
    SELECT 'quality', COUNT(*) - COUNT(quality), COUNT(*) FROM dl UNION ALL
    SELECT 'toxic', COUNT(*) - COUNT(toxic), COUNT(*) FROM dl))"""


@register("null_profile", _DL_SQL + """
SELECT "column", ROUND(CAST(null_count AS DOUBLE) / n, 3) AS null_pct FROM nc
ORDER BY CAST(null_count AS DOUBLE) / n DESC, "column" LIMIT 10
""")
def null_profile(spark, sf):
    return null_fraction_top(_docs_labels(spark, sf), 10, 3)


@register("null_counts", _DL_SQL + """
SELECT "column", CAST(null_count AS BIGINT) AS null_count FROM nc WHERE null_count > 0
""")
def null_counts_query(spark, sf):
    return null_counts(_docs_labels(spark, sf))


@register("sparse_columns", _DL_SQL + """
SELECT "column", ROUND(CAST(null_count AS DOUBLE) / n, 6) AS null_ratio FROM nc WHERE CAST(null_count AS DOUBLE) / n > 0.5
""")
def sparse_columns_query(spark, sf):
    s = null_stats(_docs_labels(spark, sf))
    return s.where(F.col("null_ratio") > 0.5).select("column", r6(F.col("null_ratio")).alias("null_ratio"))


_ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations"]


def _table_profile_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", CAST(COUNT(*) AS BIGINT) AS rows, "
        f"CAST((SELECT COUNT(*) FROM (DESCRIBE {t})) AS INTEGER) AS cols FROM {t}" for t in _ALL_TABLES)


@register("table_profile", _table_profile_sql())
def table_profile(spark, sf):
    return profile_tables(spark, [(t, read_table(spark, sf, t)) for t in _ALL_TABLES])


# ---------------------------------------------------------------------------
# Cleaning expressions
# ---------------------------------------------------------------------------

ACCT_RANGE = (0.0, 9000.0)       # stands in for the 140–220 cm height range
ACCT_BUCKETS = (3000.0, 6000.0)  # stands in for the 170 / 185 cm thresholds


@register("clean_customers", """
WITH c AS (SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name
           FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
  k AS (SELECT *, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS acct,
               CASE WHEN c_acctbal >= 0 THEN n_name END AS last_name FROM c)
SELECT c_custkey, acct AS acctbal_clean,
       CASE WHEN acct IS NULL OR isnan(acct) THEN 'Unknown' WHEN acct < 3000 THEN 'Short'
            WHEN acct <= 6000 THEN 'Average' ELSE 'Tall' END AS acctbal_bucket,
       regexp_replace(COALESCE(c_mktsegment, 'Unknown'), '^\\s+|\\s+$', '', 'g') AS segment,
       CASE WHEN c_name IS NOT NULL AND last_name IS NOT NULL THEN c_name || ' ' || last_name ELSE c_mktsegment END
         AS full_name
FROM k
""")
def clean_customers(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    j = j.withColumns({"acctbal_clean": null_outside("c_acctbal", *ACCT_RANGE),
                       "last_name": F.when(F.col("c_acctbal") >= 0, F.col("n_name"))})
    return j.select("c_custkey", "acctbal_clean",
                    three_way_bucket("acctbal_clean", *ACCT_BUCKETS).alias("acctbal_bucket"),
                    clean_category("c_mktsegment").alias("segment"),
                    full_name("c_name", "last_name", "c_mktsegment").alias("full_name"))


def _exact_sql(col: str) -> str:
    v = f"lower(regexp_replace(CAST({col} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
    return (f"CASE WHEN {col} IS NULL THEN 'Unknown' WHEN {v} IN ('right', 'r') THEN 'Right' "
            f"WHEN {v} IN ('left', 'l') THEN 'Left' WHEN {v} IN ('both', 'b') THEN 'Both' ELSE 'Other' END")


@register("label_maps", f"""
SELECT l_orderkey, l_linenumber, {_exact_sql('l_returnflag')} AS returnflag_label,
       {_exact_sql('l_linestatus')} AS linestatus_label
FROM lineitem
""")
def label_maps(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])
    return li.select("l_orderkey", "l_linenumber",
                     exact_label_map("l_returnflag", FOOT_EXACT).alias("returnflag_label"),
                     exact_label_map("l_linestatus", FOOT_EXACT).alias("linestatus_label"))


def _substring_sql(col: str) -> str:
    v = f"lower(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))"
    return (f"CASE WHEN contains({v}, 'left') THEN 'Left' WHEN contains({v}, 'right') THEN 'Right' "
            f"WHEN contains({v}, 'both') OR contains({v}, 'ambi') THEN 'Both' ELSE NULL END")


def _keyword_sql(col: str) -> str:
    v = f"lower({col})"
    parts = [f"CASE WHEN {col} IS NULL THEN 'Unknown'"]
    for label, words in POSITION_RULES:
        cond = " OR ".join(f"contains({v}, '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return " ".join(parts) + " ELSE 'Other' END"


@register("keyword_buckets", f"""
SELECT p_partkey, {_keyword_sql('p_name')} AS name_bucket, {_keyword_sql('p_type')} AS type_bucket,
       {_substring_sql('p_name')} AS name_side
FROM part
""")
def keyword_buckets(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_type"])
    return p.select("p_partkey", keyword_bucket("p_name", POSITION_RULES).alias("name_bucket"),
                    keyword_bucket("p_type", POSITION_RULES).alias("type_bucket"),
                    substring_label_map("p_name", FOOT_SUBSTRING).alias("name_side"))


AGE_WINDOW = (0.0, 5.0)   # the reference keeps ages 12–50


@register("age_at_anchor", """
WITH j AS (SELECT l.l_orderkey, l.l_linenumber,
                  date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) / 365.25 AS age
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
           WHERE l.l_shipdate IS NOT NULL AND o.o_orderdate IS NOT NULL)
SELECT l_orderkey, l_linenumber, ROUND(age, 6) AS age FROM j WHERE age BETWEEN 0 AND 5
""")
def age_at_anchor(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    a = add_age_at_anchor(j, "l_shipdate", "o_orderdate", "age", AGE_WINDOW)
    return a.select("l_orderkey", "l_linenumber", r6(F.col("age")).alias("age"))


AS_OF = "2002-01-01"


@register("completed_years", f"""
SELECT o_orderkey, CAST(FLOOR(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') / 365) AS BIGINT) AS years
FROM orders
""")
def completed_years_query(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", completed_years("o_orderdate", F.lit(AS_OF)).alias("years"))


# ---------------------------------------------------------------------------
# E1 at microsecond grain: event lookback (7 and 14 days before each event)
# ---------------------------------------------------------------------------

@register("event_lookback", """
SELECT e1.event_id, e1.user_id,
       CAST(COUNT(CASE WHEN e2.ts >= e1.ts - INTERVAL 7 DAY THEN 1 END) AS BIGINT) AS d7_n,
       ROUND(COALESCE(SUM(CASE WHEN e2.ts >= e1.ts - INTERVAL 7 DAY THEN e2.value END), 0.0), 6) AS d7_value,
       CAST(COUNT(e2.event_id) AS BIGINT) AS d14_n,
       ROUND(COALESCE(SUM(e2.value), 0.0), 6) AS d14_value
FROM events e1 LEFT JOIN events e2
  ON e2.user_id = e1.user_id AND e2.ts < e1.ts AND e2.ts >= e1.ts - INTERVAL 14 DAY
GROUP BY e1.event_id, e1.user_id
""")
def event_lookback(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "value"])
    lb = lookback_aggregate(ev.select("event_id", "user_id", "ts"), ev, entity="user_id", anchor_time="ts",
                            measures={"value": F.col("value")}, windows={"d7": 7, "d14": 14}, count_name="n",
                            unit="micros")
    return lb.select("event_id", "user_id", "d7_n", r6(F.col("d7_value")).alias("d7_value"),
                     "d14_n", r6(F.col("d14_value")).alias("d14_value"))


# ---------------------------------------------------------------------------
# Median / most-frequent imputation and population-std scaling
# ---------------------------------------------------------------------------

@register("impute_and_scale", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acct,
                  CASE WHEN c_acctbal >= 1000 THEN c_mktsegment END AS seg FROM customer),
  med AS (SELECT median(acct) AS m FROM c),
  md AS (SELECT seg FROM c WHERE seg IS NOT NULL GROUP BY seg ORDER BY COUNT(*) DESC, seg LIMIT 1),
  imp AS (SELECT c_custkey, COALESCE(acct, (SELECT m FROM med)) AS acct_imputed,
                 COALESCE(seg, (SELECT seg FROM md)) AS segment_imputed FROM c),
  st AS (SELECT avg(acct_imputed) AS mu, stddev_pop(acct_imputed) AS sd FROM imp)
SELECT c_custkey, ROUND(acct_imputed, 6) AS acct_imputed,
       ROUND((acct_imputed - st.mu) / CASE WHEN st.sd > 0 THEN st.sd ELSE 1 END, 6) AS acct_scaled, segment_imputed
FROM imp CROSS JOIN st
""")
def impute_and_scale(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    c = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acct"),
                 F.when(F.col("c_acctbal") >= 1000, F.col("c_mktsegment")).alias("seg"))
    prep = fit_preprocessing(c, ["acct"], ["seg"])
    t = prep.transform(c)
    return t.select("c_custkey", r6(F.col("acct")).alias("acct_imputed"), r6(F.col("__z_acct")).alias("acct_scaled"),
                    F.col("seg").alias("segment_imputed"))


# ---------------------------------------------------------------------------
# Request validation and scoring bands
# ---------------------------------------------------------------------------

REQ_AGE_LIMITS = (0.5, 6.0)   # the reference accepts ages 16–50
REQ_WINDOWS = ["w180", "w365"]


def anchor_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """Anchor table + 180/365-day lookback totals: the v1 feature table, written
    once per input folder and shared by the request, scoring and model queries."""
    def build():
        return lookback_aggregate(model_base(spark, sf), facts(spark, sf), entity="o_custkey",
                                  anchor_time="anchor_date", fact_time="l_shipdate", measures=measure_columns(),
                                  windows=WINDOWS, count_name="games_played")
    return written_table(spark, f"anchor-lookback:{sf}", build, sf)


def requests_frame(spark: SparkSession, sf: str) -> DataFrame:
    """One score request per order: tenure age, label, per-window totals, group label."""
    return anchor_lookback(spark, sf).withColumnRenamed("nationality", "player_club_domestic_competition_id")


def _validation_sql() -> str:
    lo, hi = REQ_AGE_LIMITS
    parts = [f"""SELECT o_orderkey, 'age' AS field,
       CASE WHEN age IS NULL OR isnan(age) OR isinf(age) THEN 'Age must be a finite number'
            ELSE 'Age must be between {lo:g} and {hi:g}' END AS message
FROM req WHERE age IS NULL OR isnan(age) OR isinf(age) OR age < {lo} OR age > {hi}"""]
    for w in REQ_WINDOWS:
        for label, stats in STAT_GROUPS:
            for s in stats:
                c = f"{w}_{s}"
                parts.append(f"""SELECT o_orderkey, '{c}' AS field,
       CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN '{label} must be a finite number'
            ELSE '{label} cannot be negative' END AS message
FROM req WHERE {c} IS NULL OR isnan({c}) OR isinf({c}) OR {c} < 0""")
    for col, label in (("position", "Position"), ("player_club_domestic_competition_id", "Competition ID")):
        parts.append(f"""SELECT o_orderkey, '{col}' AS field, '{label} must be a non-empty string' AS message
FROM req WHERE {col} IS NULL OR regexp_replace({col}, '^\\s+|\\s+$', '', 'g') = ''""")
    return "\nUNION ALL\n".join(parts)


_REQ_SQL = "WITH " + LOOKBACK_SQL_CTE.strip()[len("WITH "):] + "," + BASE_SQL + """,
  req AS (SELECT b.o_orderkey, b.age, b.position, b.nationality AS player_club_domestic_competition_id,
                 b.age_bin, lb.* EXCLUDE (o_orderkey, o_custkey, anchor_date, o_totalprice)
          FROM base b JOIN lb ON lb.o_orderkey = b.o_orderkey)"""


@register("validate_requests", _REQ_SQL + "\n" + _validation_sql())
def validate_requests_query(spark, sf):
    _, rejected = validate_requests(requests_frame(spark, sf), age_limits=REQ_AGE_LIMITS, windows=REQ_WINDOWS)
    return rejection_rows(rejected, "o_orderkey")


def _fmt_eur_sql(v: str) -> str:
    return (f"CASE WHEN {v} >= 1e9 THEN 'EUR ' || printf('%.2f', {v} / 1e9) || 'B' "
            f"WHEN {v} >= 1e6 THEN 'EUR ' || printf('%.2f', {v} / 1e6) || 'M' "
            f"WHEN {v} >= 1e3 THEN 'EUR ' || printf('%.0f', {v} / 1e3) || 'K' "
            f"ELSE 'EUR ' || printf('%.0f', {v}) END")


@register("score_bands", SCORED_SQL.replace("WITH ", "WITH " + LOOKBACK_SQL_CTE.strip()[len("WITH "):] + ",", 1)
          + """,
  req AS (SELECT b.o_orderkey, b.age, b.position, b.nationality AS player_club_domestic_competition_id,
                 b.age_bin, lb.* EXCLUDE (o_orderkey, o_custkey, anchor_date, o_totalprice)
          FROM base b JOIN lb ON lb.o_orderkey = b.o_orderkey),
  q AS (SELECT quantile_cont(target_log - pred_log, 0.1) AS q10, quantile_cont(target_log - pred_log, 0.9) AS q90
        FROM train_pred),
  valid AS (SELECT * FROM req WHERE age BETWEEN 0.5 AND 6.0),
  sc AS (SELECT v.o_orderkey, COALESCE(g.pred_log, gmed.m) AS pred_log FROM valid v CROSS JOIN gmed
         LEFT JOIN grp g ON g.position = v.position AND g.age_bin = v.age_bin),
  iv AS (SELECT o_orderkey, exp(pred_log) AS v, LEAST(exp(pred_log + q10), exp(pred_log + q90)) AS lo,
                GREATEST(exp(pred_log + q10), exp(pred_log + q90)) AS hi FROM sc CROSS JOIN q),
  lv AS (SELECT *, CASE WHEN v < 2000000 THEN 'Development or depth option' WHEN v < 10000000 THEN 'Rotation-level asset'
                        WHEN v < 30000000 THEN 'First-team starter profile' WHEN v < 70000000 THEN 'High-value starter'
                        ELSE 'Elite market asset' END AS valuation_band,
                   CASE WHEN v <= 0 THEN 'high' WHEN (hi - lo) / v < 1.5 THEN 'low' WHEN (hi - lo) / v < 3.0 THEN 'medium'
                        ELSE 'high' END AS uncertainty_level FROM iv)
SELECT o_orderkey, ROUND(v, 4) AS predicted_value_eur, ROUND(lo, 4) AS ci_lower, ROUND(hi, 4) AS ci_upper,
       valuation_band, uncertainty_level,
       'Estimated market value is ' || """ + _fmt_eur_sql("v") + """ || ' with a 80% interval from ' || """
          + _fmt_eur_sql("lo") + " || ' to ' || " + _fmt_eur_sql("hi") + """ || '. This sits in the ''' ||
       valuation_band || ''' tier with ' || uncertainty_level || ' uncertainty.' AS summary
FROM lv
""")
def score_bands(spark, sf):
    train, _, _ = split_frames(spark, sf)
    resid = scored(spark, sf, "train")
    q10, q90 = quantile_values(resid.select((F.col("target_log") - F.col("pred_log")).alias("r")), "r", [0.1, 0.9])
    valid, _ = validate_requests(requests_frame(spark, sf), age_limits=REQ_AGE_LIMITS, windows=REQ_WINDOWS)
    pred = fit_predict_group_median(train, valid, "target_log", GROUP_KEYS)
    out = scout_columns(point_and_interval(pred, q10, q90), coverage_label(0.1, 0.9))
    return out.select("o_orderkey", r4(F.col("predicted_value_eur")).alias("predicted_value_eur"),
                      r4(F.col("ci_lower")).alias("ci_lower"), r4(F.col("ci_upper")).alias("ci_upper"),
                      "valuation_band", "uncertainty_level", "summary")


# ---------------------------------------------------------------------------
# Consolidated report
# ---------------------------------------------------------------------------

def _fmt_eur_abs_sql(v: str) -> str:
    return (f"CASE WHEN abs({v}) >= 1e9 THEN 'EUR ' || printf('%.2f', {v} / 1e9) || 'B' "
            f"WHEN abs({v}) >= 1e6 THEN 'EUR ' || printf('%.2f', {v} / 1e6) || 'M' "
            f"WHEN abs({v}) >= 1e3 THEN 'EUR ' || printf('%.0f', {v} / 1e3) || 'K' "
            f"ELSE 'EUR ' || printf('%.0f', {v}) END")


_REPORT_SQL = _INTERVAL_SQL + """,
  es AS (SELECT COUNT(*) AS n_test_rows, avg(abs_err_eur) AS mae, median(abs_err_eur) AS med,
                avg(signed_err_eur) AS mse FROM test_err),
  ivs AS (SELECT avg(CASE WHEN actual_eur >= pred_eur_lower AND actual_eur <= pred_eur_upper THEN 1.0 ELSE 0.0 END)
                 AS emp FROM iv),
  o AS (SELECT es.*, ivs.emp, CAST((SELECT cutoff FROM cut) AS VARCHAR) AS cutoff_date,
               CASE WHEN mse <= -GREATEST(mae * 0.1, 50000.0) THEN 'underprediction'
                    WHEN mse >= GREATEST(mae * 0.1, 50000.0) THEN 'overprediction' ELSE 'roughly_unbiased' END AS dir,
               ROUND(ivs.emp - 0.8, 4) AS gap FROM es CROSS JOIN ivs),
  flags AS (SELECT CASE WHEN gap <= -0.02 THEN '""" + COVERAGE_FLAGS["below"] + """'
                        WHEN gap >= 0.02 THEN '""" + COVERAGE_FLAGS["above"] + """'
                        ELSE '""" + COVERAGE_FLAGS["close"] + """' END AS coverage_flag,
                   CASE dir WHEN 'underprediction' THEN '""" + BIAS_FLAGS["underprediction"] + """'
                            WHEN 'overprediction' THEN '""" + BIAS_FLAGS["overprediction"] + """'
                            ELSE '""" + BIAS_FLAGS["roughly_unbiased"] + """' END AS bias_flag FROM o),
  pos AS (SELECT * FROM (SELECT position AS grp, COUNT(actual_eur) AS n, avg(abs_err_eur) AS mae,
                 median(abs_err_eur) AS med, avg(signed_err_eur) AS mse FROM test_err GROUP BY position)
          QUALIFY row_number() OVER (ORDER BY mae DESC, n DESC, grp) <= 3),
  lea AS (SELECT * FROM (SELECT nationality AS grp, COUNT(actual_eur) AS n, avg(abs_err_eur) AS mae,
                 median(abs_err_eur) AS med, avg(signed_err_eur) AS mse FROM test_err
                 WHERE lower(nationality) <> 'unknown' GROUP BY nationality)
          QUALIFY row_number() OVER (ORDER BY mae DESC, n DESC, grp) <= 3)"""


@register("report_overall", _REPORT_SQL + """
SELECT CAST(n_test_rows AS BIGINT) AS n_test_rows, cutoff_date, ROUND(mae, 4) AS mae_eur,
       ROUND(med, 4) AS median_abs_err_eur, ROUND(mse, 4) AS mean_signed_err_eur, dir AS bias_direction,
       '10-90' AS "interval", CAST(0.8 AS DOUBLE) AS target_coverage, ROUND(emp, 6) AS empirical_coverage, gap AS coverage_gap,
       coverage_flag, bias_flag
FROM o CROSS JOIN flags
""")
def report_overall_query(spark, sf):
    o = _report_overall_frame(spark, sf)
    return o.select("n_test_rows", "cutoff_date", r4(F.col("mae_eur")).alias("mae_eur"),
                    r4(F.col("median_abs_err_eur")).alias("median_abs_err_eur"),
                    r4(F.col("mean_signed_err_eur")).alias("mean_signed_err_eur"), "bias_direction", "interval",
                    "target_coverage", r6(F.col("empirical_coverage")).alias("empirical_coverage"), "coverage_gap",
                    "coverage_flag", "bias_flag")


def _report_inputs(spark, sf):
    test = scored(spark, sf)
    tables = error_tables(test, ["position", "nationality"])
    es = tables.summary().withColumn("cutoff_date", F.lit(iso_date(cutoff_for(spark, sf))))
    _, iv, _ = prediction_intervals(scored(spark, sf, "train"), test, actual="value")
    return es, iv, tables.by_group("position"), tables.by_group("nationality")


def _report_overall_frame(spark, sf):
    es, iv, _, _ = _report_inputs(spark, sf)
    return report_overall(es, iv)


@register("report_risks", _REPORT_SQL + """
SELECT 'position' AS section, CAST(row_number() OVER (ORDER BY mae DESC, n DESC, grp) AS INTEGER) AS rank,
       grp AS "group", CAST(n AS BIGINT) AS samples, ROUND(mae, 4) AS mae_eur, ROUND(med, 4) AS median_abs_err_eur,
       ROUND(mse, 4) AS mean_signed_err_eur FROM pos
UNION ALL
SELECT 'league', CAST(row_number() OVER (ORDER BY mae DESC, n DESC, grp) AS INTEGER), grp, CAST(n AS BIGINT),
       ROUND(mae, 4), ROUND(med, 4), ROUND(mse, 4) FROM lea
""")
def report_risks(spark, sf):
    _, _, bp, bl = _report_inputs(spark, sf)
    w = Window.orderBy(F.desc("mae_eur"), F.desc("samples"), F.asc("group"))

    def fmt(df, section):
        return df.select(F.lit(section).alias("section"), F.row_number().over(w).alias("rank"), "group", "samples",
                         *[r4(F.col(c)).alias(c) for c in ["mae_eur", "median_abs_err_eur", "mean_signed_err_eur"]])
    return fmt(top_group_risks(bp, "position"), "position").unionByName(
        fmt(top_group_risks(bl, "nationality", exclude_unknown=True), "league"))


@register("report_lines", _REPORT_SQL + """,
  lines AS (
    SELECT 'overall' AS section, 0 AS position, 'Test rows' AS label, format('{:,}', n_test_rows) AS value FROM o
    UNION ALL SELECT 'overall', 1, 'Cutoff date', cutoff_date FROM o
    UNION ALL SELECT 'overall', 2, 'MAE', """ + _fmt_eur_abs_sql("mae") + """ FROM o
    UNION ALL SELECT 'overall', 3, 'Median absolute error', """ + _fmt_eur_abs_sql("med") + """ FROM o
    UNION ALL SELECT 'overall', 4, 'Mean signed error', """ + _fmt_eur_abs_sql("mse") + """ || ' (' || dir || ')' FROM o
    UNION ALL SELECT 'overall', 5, 'Interval coverage', printf('%.1f', emp * 100) || '% vs target ' ||
                     printf('%.1f', 0.8 * 100) || '%' FROM o
    UNION ALL SELECT 'risk_flags', 0, 'flag', coverage_flag FROM flags
    UNION ALL SELECT 'risk_flags', 1, 'flag', bias_flag FROM flags
    UNION ALL SELECT 'risk_flags', 2, 'flag', 'Highest position-level error is in ' || grp ||
                     ' profiles, so that subgroup deserves a closer look.'
              FROM pos QUALIFY row_number() OVER (ORDER BY mae DESC, n DESC, grp) = 1
    UNION ALL SELECT 'risk_flags', 3, 'flag', COALESCE((SELECT 'League-level error is highest in ' || grp ||
                     ', which is worth checking for sample or feature gaps.' FROM lea
                     QUALIFY row_number() OVER (ORDER BY mae DESC, n DESC, grp) = 1), '""" + LEAGUE_FALLBACK.replace("'", "''") + """')
    UNION ALL SELECT 'positions', CAST(row_number() OVER (ORDER BY mae DESC, n DESC, grp) - 1 AS INTEGER), grp,
                     'MAE ' || """ + _fmt_eur_abs_sql("mae") + """ || ' across ' || CAST(n AS VARCHAR) || ' rows' FROM pos
    UNION ALL SELECT 'leagues', CAST(row_number() OVER (ORDER BY mae DESC, n DESC, grp) - 1 AS INTEGER), grp,
                     'MAE ' || """ + _fmt_eur_abs_sql("mae") + """ || ' across ' || CAST(n AS VARCHAR) || ' rows' FROM lea)
SELECT section, CAST(position AS INTEGER) AS position, label, value FROM lines
""")
def report_lines_query(spark, sf):
    es, iv, bp, bl = _report_inputs(spark, sf)
    rep = build_report(spark, "star", es, iv, bp, "position", bl, "nationality")
    return report_lines(rep)


# ---------------------------------------------------------------------------
# Ridge model on the lookback features (rows-only)
# ---------------------------------------------------------------------------

NUMERIC_INPUTS = ["age", "acctbal"] + [f"{w}_{m}" for w in WINDOWS for m in ["games_played", *MEASURES]] + \
    [f"{w}_{r}" for w in WINDOWS for r in _RATE_NAMES + ["played_any_minutes"]]
CATEGORICAL_INPUTS = ["position", "nationality", "region", "acctbal_bucket"]


def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    """v3-style feature table: anchors + entity attributes + lookback totals,
    rate columns and collapsed categories (L1: v1 → v2 → v3)."""
    base = model_base(spark, sf)
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    attrs = (c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
             .join(r, F.col("n_regionkey") == r["r_regionkey"], "left")
             .select(F.col("c_custkey").alias("o_custkey"),
                     F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
                     clean_category("r_name").alias("region")))
    # collapse lists are fitted on the anchor rows (the lookback keeps them 1:1)
    keep = fit_top_categories(base.select("nationality"), {"nationality": 10})
    v1 = anchor_lookback(spark, sf).join(attrs, "o_custkey", "left")
    v1 = v1.withColumn("acctbal_bucket", three_way_bucket("acctbal", *ACCT_BUCKETS))
    v2 = add_rate_features(v1, list(WINDOWS))
    return apply_collapse(v2, keep)


_MODELS: dict[tuple, object] = {}


def _ridge_setup(spark: SparkSession, sf: str):
    key = (spark.sparkContext.applicationId, sf, input_stamp(spark, sf))
    if key not in _MODELS:
        feats = materialize(feature_frame(spark, sf))
        cutoff = cutoff_for(spark, sf)
        train, test, _ = time_split(feats, "anchor_date", cutoff=cutoff, raw_col="o_orderdate")
        gram = fit_gram(train, "target_log", NUMERIC_INPUTS, CATEGORICAL_INPUTS)
        _MODELS[key] = (feats, train, test, gram.solve(alpha=1.0), gram)
    return _MODELS[key][:4]


def _gram(spark: SparkSession, sf: str):
    """The Gram matrix of the model's training rows, which every fit of its columns solves."""
    _ridge_setup(spark, sf)
    return _MODELS[spark.sparkContext.applicationId, sf, input_stamp(spark, sf)][4]


@register("ridge_coefficients")
def ridge_coefficients(spark, sf):
    _, _, _, model = _ridge_setup(spark, sf)
    return top_coefficients(model, spark, 25)


ABLATION_MODES = ["full", "no_nationality", "no_context", "performance_only"]


def ablation_columns(mode: str) -> list[str]:
    return select_feature_group(NUMERIC_INPUTS + CATEGORICAL_INPUTS, mode, nationality=["nationality"], context=["region"],
                                core=["age", "position"])


@register("ablation")
def ablation(spark, sf):
    _, _, test, full = _ridge_setup(spark, sf)
    gram = _gram(spark, sf)
    models = {mode: full if mode == "full" else gram.solve(ablation_columns(mode)) for mode in ABLATION_MODES}
    scored_test = full.predict_all(test, {f"pred_{mode}": m for mode, m in models.items()})
    found = metrics_by_variant(scored_test, "target_log", {mode: f"pred_{mode}" for mode in models})
    counts = F.create_map(*[F.lit(x) for mode in models for x in (mode, len(ablation_columns(mode)))])
    return found.select(F.col("variant").alias("experiment"), counts[F.col("variant")].alias("n_features_input"),
                        "rmse_log", "mae_log", "mae_eur").orderBy("rmse_log")


@register("ridge_explain")
def ridge_explain(spark, sf):
    _, train, test, model = _ridge_setup(spark, sf)
    q10, q90 = quantile_values(model.predict(train).select((F.col("target_log") - F.col("pred_log")).alias("r")),
                               "r", [0.1, 0.9])
    ex = model.contributions(test, top_k=3)
    out = scout_columns(point_and_interval(ex, q10, q90), coverage_label(0.1, 0.9))
    return out.select("o_orderkey", "pred_log", "predicted_value_eur", "ci_lower", "ci_upper",
                      "baseline_log_value", "top_positive", "top_negative", "key_positives", "key_risks",
                      "valuation_band", "uncertainty_level", "summary")


@register("ridge_error_analysis")
def ridge_error_analysis(spark, sf):
    _, _, test, model = _ridge_setup(spark, sf)
    scored_test = model.predict(test, missing="zero")   # the diagnostics' fillna(0) path (G8)
    ea = error_analysis(scored_test, actual="value", group_cols=["position"], key_cols=["o_orderkey"],
                        keep_cols=["o_orderkey", "position"])
    return ea.summary.withColumn("cutoff_date", F.lit(iso_date(cutoff_for(spark, sf))))


# ---------------------------------------------------------------------------
# Streaming scorer over request files derived from the orders
# ---------------------------------------------------------------------------

@register("stream_scoring")
def stream_scoring(spark, sf):
    feats, train, _, model = _ridge_setup(spark, sf)
    q10, q90 = quantile_values(model.predict(train).select((F.col("target_log") - F.col("pred_log")).alias("r")),
                               "r", [0.1, 0.9])
    root = scratch_path(spark, "stream-scoring")
    req_cols = ["age", "position", "player_club_domestic_competition_id"] + \
        [f"{w}_{t}" for w in WINDOWS for t in ["games_played", *MEASURES]]
    reqs = feats.select(F.col("o_orderkey").cast("string").alias("request_id"),
                        F.col("nationality").alias("player_club_domestic_competition_id"),
                        *[c for c in req_cols if c != "player_club_domestic_competition_id"])
    requests_as_json(reqs, "request_id").write.mode("overwrite").text(f"{root}/in", compression="snappy")
    schema = reqs.schema
    qs = start_scoring(spark, f"{root}/in", schema, model, q10, q90, f"{root}/out", f"{root}/ckpt",
                       coverage_label=coverage_label(0.1, 0.9), age_limits=REQ_AGE_LIMITS)
    drain(qs)
    return sink_table(spark, f"{root}/out", "scored")


@register("calibration_groupwise", _SMEAR_SQL + """,
  gw AS (SELECT GREATEST(t.pred_eur * COALESCE(gs.s, sm.s), 0) AS pred_gw, t.actual_eur
         FROM test_err t LEFT JOIN gs ON gs.nationality = t.nationality CROSS JOIN sm),""" +
          _deciles_sql("pred_gw", "gw").rstrip() + """
SELECT CAST(decile AS INTEGER) AS decile, ROUND(avg(pred_gw), 4) AS pred_mean,
       ROUND(avg(actual_eur), 4) AS actual_mean, CAST(COUNT(actual_eur) AS BIGINT) AS n
FROM binned GROUP BY decile
""")
def calibration_groupwise(spark, sf):
    cal = groupwise_bias_correction(scored(spark, sf, "train"), scored(spark, sf), group="nationality", actual="value").calibration
    return cal.select("decile", r4(F.col("pred_mean")).alias("pred_mean"),
                      r4(F.col("actual_mean")).alias("actual_mean"), "n")


@register("interval_distribution", _INTERVAL_SQL + """,
  s AS (SELECT 'actual' AS series, actual_eur AS x FROM iv
        UNION ALL SELECT 'predicted_median' AS series, pred_eur_median AS x FROM iv),
  mm AS (SELECT series, min(x) AS lo, max(x) AS hi FROM s GROUP BY series)
SELECT s.series, CAST(LEAST(FLOOR((x - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, CAST(COUNT(*) AS BIGINT) AS n
FROM s JOIN mm ON mm.series = s.series GROUP BY 1, 2
""")
def interval_distribution(spark, sf):
    """Data behind the actual-vs-predicted-median distribution chart (D19, 50 bins each)."""
    _, _, rows = prediction_intervals(scored(spark, sf, "train"), scored(spark, sf), actual="value")
    rows = materialize(rows.select("actual_eur", "pred_eur_median"))
    a = histogram(rows, "actual_eur", 50).select(F.lit("actual").alias("series"), "bin", "n")
    p = histogram(rows, "pred_eur_median", 50).select(F.lit("predicted_median").alias("series"), "bin", "n")
    return a.unionByName(p)
