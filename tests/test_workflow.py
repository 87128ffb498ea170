"""The reference's own table layout end to end: CSV in → features v1/v2/v3 → training → diagnostics → report."""

import csv
import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001

from tidewater.operators.report import report_from_artifacts
from tidewater.plans.workflow import (build_features, club_performance, default_group, load_raw, model_inputs, profile_raw,
                                      run_workflow)

POSITIONS = [("Goalkeeper", "Goalkeeper"), ("Defender", "Centre-Back"), ("Midfield", "Central Midfield"),
             ("Attack", "Centre-Forward"), ("Attack", "Right Winger"), ("Defender", "Left-Back")]


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    rnd = random.Random(42)
    d = tmp_path_factory.mktemp("raw")
    players, vals, apps = [], [], []
    for pid in range(1, 41):
        pos, sub = POSITIONS[pid % len(POSITIONS)]
        dob = "" if pid == 7 else str(dt.date(1985, 1, 1) + dt.timedelta(days=rnd.randint(0, 5000)))
        foot = rnd.choice(["right", "Left", "both", "", "R", "weird"])
        height = rnd.choice(["180", "175.5", "130", "", "199", "NA"])
        country = rnd.choice(["England", "Spain", "Brazil", "France", "Elbonia", ""])
        players.append([pid, f"First{pid}", f"Last{pid}", f"Player {pid}", dob, pos, sub, foot, height,
                        country, rnd.choice(["England", "Spain", " Brazil "])])
        base = dt.date(2012, 1, 1)
        for k in range(30):
            day = base + dt.timedelta(days=rnd.randint(0, 3000))
            mv = rnd.choice([0, 50_000, 250_000, 1_000_000, 5_000_000, 20_000_000]) * rnd.uniform(0.5, 1.5)
            vals.append([pid, str(day), f"{mv:.0f}", rnd.randint(1, 30), rnd.choice(["GB1", "ES1", "IT1", "L1", ""])])
        for k in range(60):
            day = base + dt.timedelta(days=rnd.randint(-400, 3000))
            apps.append([pid, str(day), rnd.choice(["90", "45", "", "x"]), rnd.randint(0, 2), rnd.randint(0, 1),
                         rnd.randint(0, 1), rnd.choice([0, 0, 1])])
    _write(d / "players.csv", ["player_id", "first_name", "last_name", "name", "date_of_birth", "position",
                               "sub_position", "foot", "height_in_cm", "country_of_citizenship",
                               "country_of_birth"], players)
    _write(d / "player_valuations.csv", ["player_id", "date", "market_value_in_eur", "current_club_id",
                                         "player_club_domestic_competition_id"], vals)
    _write(d / "appearances.csv", ["player_id", "date", "minutes_played", "goals", "assists", "yellow_cards",
                                   "red_cards"], apps)
    games = [[g, rnd.randint(1, 12), rnd.randint(1, 12), rnd.choice(["1", "", "3"]), rnd.choice(["0", "2", ""]),
              rnd.randint(0, 1)] for g in range(300)] + [[999, "", 3, 1, 1, 1]]
    _write(d / "club_games.csv", ["game_id", "club_id", "opponent_id", "own_goals", "opponent_goals", "is_win"], games)
    _write(d / "clubs.csv", ["club_id", "name"], [[c, f"FC {c}"] for c in range(3, 11)])
    return str(d)


def test_features_v3_shape_and_lookback(spark, raw_dir):
    raw = load_raw(spark, raw_dir)
    v3 = build_features(raw["players"], raw["player_valuations"], raw["appearances"], "v3")
    assert len(model_inputs(v3)) == 36
    v1 = build_features(raw["players"], raw["player_valuations"], raw["appearances"], "v1").toPandas()
    # one anchor checked by hand against the raw CSVs
    a = pd.read_csv(os.path.join(raw_dir, "appearances.csv"), parse_dates=["date"])
    row = v1.sort_values(["player_id", "date"]).iloc[5]
    d = pd.Timestamp(row["date"])
    sel = a[(a.player_id == row["player_id"]) & (a.date < d) & (a.date >= d - pd.Timedelta(days=180))]
    assert row["w180_games_played"] == len(sel)
    assert row["w180_minutes_played"] == pd.to_numeric(sel.minutes_played, errors="coerce").fillna(0).sum()
    # the player without a birth date and the zero valuations are gone
    assert 7 not in set(v1.player_id) and (v1.market_value_in_eur > 0).all()
    assert v1.age.between(12, 50).all()


def test_club_performance(spark, raw_dir):
    raw = load_raw(spark, raw_dir)
    perf, top10, miss = club_performance(raw["club_games"], raw["clubs"], patch_keys=[1, 2])
    assert perf.where(F.col("club_id").isNull()).count() == 0           # the row without a club id is dropped
    assert top10.count() == 10
    assert sorted(r[0] for r in miss.collect()) == [11, 12]
    assert top10.where(F.col("name") == "Unknown Club").count() <= 2


def test_profile_raw(spark, raw_dir):
    prof = profile_raw(spark, raw_dir)
    tables = {r["table"] for r in prof.collect()}
    assert tables == {"players", "player_valuations", "appearances", "club_games", "clubs"}


def test_profile_raw_reports_each_table(spark, tmp_path):
    assert profile_raw(spark, str(tmp_path)).count() == 0
    _write(str(tmp_path / "good.csv"), ["a", "b"], [[1, ""], [2, "x"]])
    (tmp_path / "bad.csv").mkdir()
    got = {r["table"]: r for r in profile_raw(spark, str(tmp_path)).collect()}
    assert got["good"]["rows"] == 2 and got["good"]["error"] is None and got["bad"]["error"]


def test_run_workflow_writes_artifacts(spark, raw_dir, tmp_path):
    paths = run_workflow(spark, raw_dir, str(tmp_path / "out"))
    for key in ["features", "model", "metrics", "ablation", "error_summary", "error_by_position", "calibration",
                "bias_comparison", "groupwise_smearing", "calibration_groupwise", "interval_summary",
                "interval_rows", "report", "club_performance", "players_clean"]:
        assert key in paths
    metrics = spark.read.json(paths["metrics"]).collect()
    feats = spark.read.parquet(paths["features"])
    m = metrics[0]
    assert m["n_train"] + m["n_test"] == feats.where(F.col("target_log").isNotNull()).count()
    assert m["train_date_min"] <= m["train_date_max"] < m["cutoff_date"] == m["test_date_min"] <= m["test_date_max"]
    by_pos = [float(r["mae_eur"]) for r in spark.read.option("header", True).csv(paths["error_by_position"]).collect()]
    assert by_pos == sorted(by_pos, reverse=True)
    cal = [int(r["decile"]) for r in spark.read.option("header", True).csv(paths["calibration"]).collect()]
    assert cal == sorted(cal)
    variants = spark.read.option("header", True).csv(paths["bias_comparison"]).collect()
    assert {int(r["n"]) for r in variants} == {m["n_test"]}
    games = spark.read.option("header", True).csv(paths["club_games_clean"])
    assert games.count() == 300 and games.where(F.col("own_goals").isNull()).count() == 0
    assert {r["model"] for r in metrics} == {"baseline_global_median", "baseline_position_age", "ridge_model_full"}
    abl = spark.read.option("header", True).csv(paths["ablation"]).collect()
    assert [r["experiment"] for r in abl] and {r["experiment"] for r in abl} == {
        "full", "no_nationality", "no_context", "performance_only"}
    n_inputs = {r["experiment"]: int(r["n_features_input"]) for r in abl}
    assert n_inputs == {"full": 36, "no_nationality": 34, "no_context": 33, "performance_only": 28}
    rows = spark.read.option("header", True).csv(paths["interval_rows"])
    assert rows.count() > 0 and "pred_eur_median" in rows.columns
    rep = spark.read.json(paths["report"]).first()
    assert rep["overall"]["interval"] == "10-90" and len(rep["risk_flags"]) == 4
    assert rep["generated_from"]["error_by_league"] == "error_by_league_v3"
    again = report_from_artifacts(spark, str(tmp_path / "out" / "artifacts"), "v3").first()
    assert again["overall"]["n_test_rows"] == m["n_test"] and again["model_version"] == "v3"
    with pytest.raises(FileNotFoundError):
        report_from_artifacts(spark, str(tmp_path / "out" / "artifacts"), "v9")


def test_workflow_resumes_at_the_failed_step(spark, raw_dir, tmp_path, monkeypatch):
    import tidewater.plans.workflow as workflow
    from tidewater.session import scratch_mark

    def lost(*args, **kw):
        raise RuntimeError("executor lost")

    out, before = str(tmp_path / "out"), scratch_mark(spark)
    whole = workflow.global_bias_correction
    monkeypatch.setattr(workflow, "global_bias_correction", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        workflow.run_workflow(spark, raw_dir, out)
    monkeypatch.setattr(workflow, "global_bias_correction", whole)
    model_file = os.path.getmtime(os.path.join(out, "artifacts", "ridge_model_v3", "meta"))
    paths, ran = workflow.run_steps(spark, raw_dir, out)
    assert ran == ["bias", "intervals", "report", "tables"]
    assert os.path.getmtime(os.path.join(out, "artifacts", "ridge_model_v3", "meta")) == model_file
    again, ran = workflow.run_steps(spark, raw_dir, out)
    assert ran == [] and again == paths and scratch_mark(spark) == before
    # other inputs: everything is made again
    assert workflow.Steps(spark, f"{out}/_steps", "another stamp").done("features") is None


def test_only_stated_columns_are_inputs(spark, raw_dir):
    raw = load_raw(spark, raw_dir, infer=True)
    feats = build_features(raw["players"], raw["player_valuations"], raw["appearances"], "v3")
    wide = feats.withColumn("agent_id", F.lit(3)).withColumn("note", F.lit("x"))
    assert model_inputs(wide) == model_inputs(feats) and "agent_id" not in model_inputs(wide)


def test_absent_group_columns_are_one_group(spark):
    df = default_group(spark.createDataFrame([(1, "x")], "a int, position string"), ["position", "league"])
    assert df.first().asDict() == {"a": 1, "position": "x", "league": "Unknown"}


def test_later_versions_start_from_the_written_first_one(spark, monkeypatch):
    from tidewater.plans import star_queries, workflow, workflow_queries  # noqa: F401 - registers the queries

    calls = []
    real = workflow.lookback_aggregate
    monkeypatch.setattr(workflow, "lookback_aggregate", lambda *a, **k: calls.append(1) or real(*a, **k))
    rows = {r["version"]: r for r in star_queries.QUERIES["feature_versions"](spark, SF001).collect()}
    assert len(calls) == 1
    assert [rows[v]["n_rate_columns"] for v in ("v1", "v2", "v3")] == [0, 14, 14]
    assert len({r["n_rows"] for r in rows.values()}) == 1


def test_workflow_features_shuffles_follow_the_input(spark, monkeypatch):
    """Few shuffle partitions in the session: the written table gets one per share of the input."""
    from tidewater import session
    from tidewater.plans import star_queries, workflow_queries

    monkeypatch.setattr(session, "PARTITION_BYTES", 1 << 10)
    key, seen = "spark.sql.shuffle.partitions", []
    real = session.sized_shuffles

    def spied(df):
        class Spy:
            def __enter__(self):
                self.inner = real(df)
                self.inner.__enter__()
                seen.append(int(spark.conf.get(key)))

            def __exit__(self, *e):
                return self.inner.__exit__(*e)
        return Spy()
    monkeypatch.setattr(session, "sized_shuffles", spied)
    before = spark.conf.get(key)
    out = workflow_queries.workflow_features(spark, SF001)
    assert max(seen) > int(before) and spark.conf.get(key) == before
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_scans_of_a_written_table_are_split(spark, tmp_path, monkeypatch):
    """What a scan's task sums up ahead of a shuffle doesn't grow with the files."""
    from tidewater import session

    spark.range(600_000).select(F.rand(1).alias("x")).repartition(1).write.option("parquet.block.size", 256 << 10).parquet(str(tmp_path / "in"))
    monkeypatch.setattr(session, "SCAN_BYTES", 512 << 10)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    table = session.written_table(spark, f"split:{tmp_path}", lambda: spark.read.parquet(str(tmp_path / "in")).select(
        "x", F.spark_partition_id().alias("task")))
    assert table.count() == 600_000 and table.select("task").distinct().count() >= 8
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == kept
