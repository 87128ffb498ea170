"""The workflow's steps on given tables brought into the reference's layout: feature versions
(L1, A12), the entity cleaning job (L6), artifacts written and read with stated schemas (A8,
A9, A11), and groups that a table lacks (B31)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import clean_entities
from ..operators.model import RidgeModel
from ..operators.stats import error_tables
from ..session import scratch_path, sized_shuffles, written
from ..sources.readers import read_artifact, read_table, version_tag
from ..sources.sinks import save_model, write_summary, write_table
from .star_queries import SCORED_SQL, _ridge_setup, r4, r6, register, scored
from .workflow import build_features, default_group

_PLAYERS_SQL = """
  births AS (SELECT o_custkey AS player_id, MIN(CAST(o_orderdate AS DATE)) - 7300 AS dob FROM orders GROUP BY 1),
  players AS (
    SELECT c.c_custkey AS player_id, b.dob, n.n_name AS country,
           CASE WHEN 135 + c.c_custkey % 90 BETWEEN 140 AND 220 THEN CAST(135 + c.c_custkey % 90 AS DOUBLE) END AS height_in_cm,
           CASE c.c_custkey % 3 WHEN 0 THEN 'Right' WHEN 1 THEN 'Left' END AS foot
    FROM customer c LEFT JOIN births b ON b.player_id = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""


def players_frame(spark, sf) -> DataFrame:
    """Customers as raw player rows: texts with blanks, heights out of range, a sparse column."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    births = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"]).groupBy("o_custkey").agg(
        F.date_sub(F.to_date(F.min("o_orderdate")), 7300).cast("string").alias("date_of_birth"))
    key = F.col("c_custkey")
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(births, key == F.col("o_custkey"), "left")
    return rows.select(
        key.alias("player_id"), F.lit("Customer").alias("first_name"), F.when(key % 4 != 0, F.substring("c_name", -6, 6)).alias("last_name"),
        F.col("c_name").alias("name"), "date_of_birth", F.col("c_mktsegment").alias("position"), F.lit(None).cast("string").alias("sub_position"),
        F.when(key % 3 == 0, "right ").when(key % 3 == 1, " LEFT").otherwise("none").alias("foot"), (135 + key % 90).cast("string").alias("height_in_cm"),
        F.col("n_name").alias("country_of_birth"), F.col("n_name").alias("country_of_citizenship"), F.when(key % 5 == 0, "agent").alias("agent_name"))


def _raw_frames(spark, sf):
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    valuations = orders.select("o_orderkey", F.col("o_custkey").alias("player_id"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("market_value_in_eur"),
                               F.col("o_orderpriority").alias("player_club_domestic_competition_id"))
    items = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate", "l_quantity", "l_linenumber"])
    appearances = items.join(orders.select("o_orderkey", "o_custkey"), items["l_orderkey"] == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("player_id"), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("minutes_played"),
        F.col("l_linenumber").alias("goals"), F.lit(None).cast("string").alias("assists"))
    return players_frame(spark, sf), valuations, appearances


_FEATURES_SQL = f"""
WITH {_PLAYERS_SQL.strip()},
  a AS (SELECT o.o_orderkey, o.o_custkey AS player_id, CAST(o.o_orderdate AS DATE) AS date, o.o_totalprice AS value, p.*  EXCLUDE (player_id),
               date_diff('day', p.dob, CAST(o.o_orderdate AS DATE)) / 365.25 AS age
        FROM orders o JOIN players p ON p.player_id = o.o_custkey WHERE o.o_totalprice > 0),
  anchors AS (SELECT * FROM a WHERE age BETWEEN 12 AND 50),
  f AS (SELECT o.o_custkey AS e, CAST(l.l_shipdate AS DATE) AS d, l.l_quantity AS m, l.l_linenumber AS g
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
  lb AS (SELECT x.o_orderkey, COUNT(CASE WHEN f.d >= x.date - 180 THEN 1 END) AS n180, COUNT(f.d) AS n365,
                COALESCE(SUM(CASE WHEN f.d >= x.date - 180 THEN f.m END), 0) AS m180, COALESCE(SUM(CASE WHEN f.d >= x.date - 180 THEN f.g END), 0) AS g180,
                COALESCE(SUM(f.g), 0) AS g365
         FROM anchors x LEFT JOIN f ON f.e = x.player_id AND f.d < x.date AND f.d >= x.date - 365 GROUP BY x.o_orderkey),
  kept AS (SELECT country FROM anchors GROUP BY country ORDER BY COUNT(*) DESC, country LIMIT 10)"""


@register("workflow_features", _FEATURES_SQL + """
SELECT x.o_orderkey, x.player_id, x.date, ROUND(x.age, 6) AS age, x.height_in_cm, COALESCE(x.foot, 'Other') AS foot,
       CASE WHEN x.height_in_cm IS NULL THEN 'Unknown' WHEN x.height_in_cm < 170 THEN 'Short' WHEN x.height_in_cm <= 185 THEN 'Average' ELSE 'Tall' END AS height_bucket,
       CASE WHEN x.country IN (SELECT country FROM kept) THEN x.country ELSE 'Other' END AS country_of_birth,
       CAST(n180 AS BIGINT) AS w180_games_played, CAST(n365 AS BIGINT) AS w365_games_played, ROUND(m180, 4) AS w180_minutes_played, CAST(g365 AS DOUBLE) AS w365_goals,
       ROUND(CASE WHEN m180 = 0 THEN 0 ELSE g180 / (m180 / 90.0) END, 6) AS w180_goals_per90, CAST(0 AS DOUBLE) AS w365_assists, ROUND(ln(1 + x.value), 6) AS target_log
FROM anchors x JOIN lb ON lb.o_orderkey = x.o_orderkey
""")
def workflow_features(spark, sf):
    """Feature table v3 from raw rows: entity base, age filter, lookback totals with an absent and
    an unreadable measure, rates, collapsed categories."""
    out = build_features(*_raw_frames(spark, sf), "v3", {"country_of_birth": 10})
    return written(out.select(
        "o_orderkey", "player_id", "date", r6(F.col("age")).alias("age"), "height_in_cm", "foot", "height_bucket", "country_of_birth", "w180_games_played",
        "w365_games_played", r4(F.col("w180_minutes_played")).alias("w180_minutes_played"), "w365_goals", r6(F.col("w180_goals_per90")).alias("w180_goals_per90"),
        "w365_assists", r6(F.col("target_log")).alias("target_log")), "workflow-features")


@register("feature_versions", _FEATURES_SQL + """
SELECT v AS version, v AS tag, (SELECT CAST(COUNT(*) AS BIGINT) FROM anchors) AS n_rows, CAST(rates AS INTEGER) AS n_rate_columns,
       (SELECT CAST(CASE WHEN v = 'v3' THEN LEAST(COUNT(DISTINCT country), 11) ELSE COUNT(DISTINCT country) END AS BIGINT) FROM anchors) AS n_countries
FROM (VALUES ('v1', 0), ('v2', 14), ('v3', 14)) t(v, rates)
""")
def feature_versions(spark, sf):
    """Each version written and read back by the tag in its path: rows stay, columns come."""
    raw, out, first = _raw_frames(spark, sf), None, None
    for version in ("v1", "v2", "v3"):
        built = build_features(*raw, version, {"country_of_birth": 10}, first)
        with sized_shuffles(built):
            path = write_table(built, f"{scratch_path(spark, 'features')}/version={version}")
        table = spark.read.parquet(path)
        first = table if first is None else first       # the later versions add to v1's rows
        rates = [c for c in table.columns if c.endswith(("_per90", "_per_game", "_any_minutes"))]
        one = table.agg(F.lit(version).alias("version"), F.lit(version_tag(path)).alias("tag"), F.count(F.lit(1)).alias("n_rows"),
                        F.lit(len(rates)).alias("n_rate_columns"), F.count_distinct("country_of_birth").alias("n_countries"))
        out = one if out is None else out.unionByName(one)
    return out


@register("cleaned_entities", f"""
WITH {_PLAYERS_SQL.strip()}
SELECT p.player_id, CASE WHEN p.player_id % 4 <> 0 THEN 'Customer ' || right(c.c_name, 6) ELSE c.c_name END AS full_name, p.foot,
       CAST(FLOOR(date_diff('day', p.dob, DATE '2000-01-01') / 365) AS INTEGER) AS age,
       CAST(135 + p.player_id % 90 AS DOUBLE) AS height_in_cm,
       CASE WHEN 135 + p.player_id % 90 < 170 THEN 'Short' WHEN 135 + p.player_id % 90 <= 185 THEN 'Average' ELSE 'Tall' END AS height_category, false AS has_agent
FROM players p JOIN customer c ON c.c_custkey = p.player_id WHERE p.dob IS NOT NULL AND 135 + p.player_id % 90 BETWEEN 150 AND 210
""")
def cleaned_entities(spark, sf):
    """The entity cleaning job on raw player rows."""
    out = clean_entities(players_frame(spark, sf).drop("sub_position"), as_of=F.lit(dt.date(2000, 1, 1)))
    return out.select("player_id", "full_name", "foot", F.col("age").cast("int").alias("age"), "height_in_cm", "height_category", F.lit("agent_name" in out.columns).alias("has_agent"))


SUMMARY_SCHEMA = "n_test_rows bigint, mae_eur double, median_abs_err_eur double, mean_signed_err_eur double"
BREAKDOWN_SCHEMA = "position string, n bigint, mae_eur double, median_abs_err double, mean_signed_err double"


@register("artifact_round_trip", SCORED_SQL + """
SELECT 'summary' AS artifact, 'all' AS name, CAST(COUNT(*) AS BIGINT) AS n, ROUND(avg(abs_err_eur), 4) AS mae_eur, ROUND(median(abs_err_eur), 4) AS median_abs_err FROM test_err
UNION ALL SELECT 'by position', position, CAST(COUNT(actual_eur) AS BIGINT), ROUND(avg(abs_err_eur), 4), ROUND(median(abs_err_eur), 4) FROM test_err GROUP BY position
UNION ALL SELECT 'absent group', 'Unknown', CAST(COUNT(actual_eur) AS BIGINT), ROUND(avg(abs_err_eur), 4), ROUND(median(abs_err_eur), 4) FROM test_err
UNION ALL SELECT 'model', 'other predictions', CAST(0 AS BIGINT), NULL, NULL
""")
def artifact_round_trip(spark, sf):
    """A summary as JSON and a breakdown as CSV, read with stated schemas; a breakdown by a column
    that the table lacks; and a model saved, loaded and scored again (A8, A9, A11, B31)."""
    rows = default_group(scored(spark, sf), ["league"])
    tables, root = error_tables(rows, ["position", "league"]), scratch_path(spark, "artifacts")
    write_summary(tables.summary(), f"{root}/summary")
    write_table(tables.by_group("position"), f"{root}/by_position", "csv")
    _, _, test, model = _ridge_setup(spark, sf)
    loaded = RidgeModel.load(save_model(model, f"{root}/model"))
    again = loaded.predict(model.predict(test, "before"), "after")
    summary = read_artifact(spark, f"{root}/summary", "lines", SUMMARY_SCHEMA)
    positions = read_artifact(spark, f"{root}/by_position", "csv", BREAKDOWN_SCHEMA)
    parts = [
        summary.select(F.lit("summary").alias("artifact"), F.lit("all").alias("name"), F.col("n_test_rows").alias("n"), "mae_eur", F.col("median_abs_err_eur").alias("median_abs_err")),
        positions.select(F.lit("by position"), "position", "n", "mae_eur", "median_abs_err"),
        tables.by_group("league").select(F.lit("absent group"), "league", "n", "mae_eur", "median_abs_err"),
        again.agg(F.count(F.when(~F.col("before").eqNullSafe(F.col("after")), 1)).alias("n")).select(
            F.lit("model"), F.lit("other predictions"), "n", F.lit(None).cast("double"), F.lit(None).cast("double")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("artifact", "name", "n", r4(F.col("mae_eur")).alias("mae_eur"), r4(F.col("median_abs_err")).alias("median_abs_err"))
