"""Sources, sinks, readiness checks and the streaming scorer's two sinks."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators.model import fit_ridge
from tidewater.operators.scoring import NotReadyError, assert_ready, score_requests, scoring_frame
from tidewater.sources.readers import (MissingColumnsError, discover_tables, load_table, parse_requests, read_artifact,
                                       read_csv_typed, read_requests, request_schema, require_columns,
                                       require_paths, version_tag)
from tidewater.sources.sinks import write_summary, write_table
from tidewater.streaming.scoring_stream import drain, sink_table, start_scoring


def test_csv_typed_null_tokens_and_bad_values(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,v,d,s\n1,2.5,2020-01-02,x\n2,NA,notadate,NULL\n3,abc,2021-13-01,\n4,7.0,2021-02-03,  y\n")
    df = read_csv_typed(spark, str(p), {"id": "bigint", "v": "double", "d": "date"})
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["v"] == 2.5 and str(rows[1]["d"]) == "2020-01-02"
    assert rows[2]["v"] is None and rows[2]["d"] is None and rows[2]["s"] is None
    assert rows[3]["v"] is None and rows[3]["d"] is None and rows[3]["s"] is None
    assert rows[4]["s"] == "  y"


def test_drop_malformed(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("a,b\n1,2\n3,4,5\n6,7\n")
    df = read_csv_typed(spark, str(p), {"a": "int", "b": "int"}, drop_malformed=True)
    assert sorted(r["a"] for r in df.collect()) == [1, 6]
    assert df.count() == 2 and df.select("b").count() == 2 and df.agg({"b": "sum"}).first()[0] == 9


def test_inferred_types_and_quoted_newlines(spark, tmp_path):
    p = tmp_path / "i.csv"
    p.write_text('a,b,c,d,e\n1,2.5,2020-01-02,x,\n-3,NA,2021-02-03,"two\nlines",\n')
    df = read_csv_typed(spark, str(p), {"b": "string"}, infer=True, multi_line=True)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "date", "d": "string", "e": "string"}
    assert df.count() == 2 and sorted(r["d"] for r in df.collect()) == ["two\nlines", "x"]


def test_drain_fails_on_timeout(spark, tmp_path):
    rate = spark.readStream.format("rate").load().writeStream.format("noop").start()
    with pytest.raises(TimeoutError):
        drain([rate], timeout_s=1)
    assert not rate.isActive


def test_guards_and_discovery(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["a", "zz"])
    with pytest.raises(FileNotFoundError):
        require_paths(spark, [str(tmp_path / "nope.csv")])
    for n in ("b.csv", "a.csv", "c.txt"):
        (tmp_path / n).write_text("x\n1\n")
    assert [p.rsplit("/", 1)[-1] for p in discover_tables(spark, str(tmp_path))] == ["a.csv", "b.csv"]
    assert version_tag("data/features/player_value_features_v3.csv") == "v3"
    assert version_tag("out/features/version=v2") == "v2" and version_tag("x/foo.csv") == "run"


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5)], "n bigint, s string, x double")
    write_summary(df.select(F.struct("n", "s").alias("o"), "x"), str(tmp_path / "j"))
    back = read_artifact(spark, str(tmp_path / "j"), "json").first()
    assert back["o"]["n"] == 1 and back["x"] == 2.5
    write_table(df, str(tmp_path / "c"), "csv")
    assert read_artifact(spark, str(tmp_path / "c"), "csv").first()["s"] == "a"


def test_requests_from_files_and_inline(spark, tmp_path):
    rec = {"request_id": "r1", "age": 21.0, "position": "Attack", "w180_games_played": 3.0,
           "player_club_domestic_competition_id": "GB1"}
    (tmp_path / "r1.json").write_text(json.dumps(rec))
    got = read_requests(spark, str(tmp_path / "*.json")).first()
    assert got["request_id"] == "r1" and got["w180_games_played"] == 3.0 and got["w365_goals"] is None
    inline = spark.createDataFrame([(json.dumps(rec),)], "body string")
    assert parse_requests(inline, "body").first()["position"] == "Attack"


def _model(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        t = {f"w{w}_{m}": float(rng.integers(0, 20)) for w in (180, 365)
             for m in ("games_played", "minutes_played", "goals", "assists", "yellow_cards", "red_cards")}
        rows.append((str(i), float(rng.uniform(17, 35)), str(rng.choice(["Attack", "Defender"])), *t.values(),
                     str(rng.choice(["GB1", "ES1"])), float(rng.normal(14, 1))))
    schema = request_schema()
    names = [f.name for f in schema.fields] + ["target_log"]
    df = spark.createDataFrame(rows, names)
    num = ["age"] + [c for c in names if c.startswith("w")]
    return df, fit_ridge(df, "target_log", num, ["position", "player_club_domestic_competition_id"])


def test_assert_ready(spark):
    df, model = _model(spark)
    assert assert_ready(None, -1.0, 1.0, 0.8).reason == "model_not_loaded"
    assert assert_ready(model, float("nan"), 1.0, 0.8).reason == "prediction_intervals_not_loaded"
    assert assert_ready(model, -1.0, 1.0, 0.0).reason == "prediction_intervals_not_loaded"
    assert assert_ready(model, -1.0, 1.0, 0.8, sample=df.limit(1)).status == "healthy"


def test_stream_scoring_two_sinks(spark, tmp_path):
    df, model = _model(spark)
    reqs = df.drop("target_log").withColumn(
        "age", F.when(F.col("request_id").isin("0", "1"), F.lit(70.0)).otherwise(F.col("age")))
    src = tmp_path / "in"
    reqs.select(F.to_json(F.struct(*reqs.columns)).alias("v")).write.text(str(src))
    qs = start_scoring(spark, str(src), request_schema(), model, -1.4, 1.5, str(tmp_path / "out"),
                       str(tmp_path / "ckpt"))
    drain(qs)
    scored, rejected = (sink_table(spark, str(tmp_path / "out"), name) for name in ("scored", "rejected"))
    assert scored.count() == 118 and scored.where(F.col("score_error").isNotNull()).count() == 0
    assert sorted(r["request_id"] for r in rejected.collect()) == ["0", "1"]
    assert {r["message"] for r in rejected.collect()} == {"Age must be between 16 and 50"}


def test_stream_malformed_and_repeated_lines_and_restart(spark, tmp_path, monkeypatch):
    df, model = _model(spark)
    reqs = df.drop("target_log")
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    lines = [r.v for r in reqs.select(F.to_json(F.struct(*reqs.columns)).alias("v")).collect()]
    odd = lines[5].replace('"request_id":"5"', '"request_id":"500"').replace('"age":', '"age":"old","was":')
    nameless = lines[6].replace('"request_id":"6",', "")
    (src / "a.json").write_text("\n".join([*lines[:60], lines[0], "{not json", "{not json", odd, nameless]))

    def run():
        drain(start_scoring(spark, str(src), request_schema(), model, -1.4, 1.5, out, str(tmp_path / "ckpt")))

    def tables():
        scored, rejected = (sink_table(spark, out, name) for name in ("scored", "rejected"))
        return (sorted(r["request_id"] or "-" for r in scored.collect()),
                sorted((r["request_id"] or "-", r["field"], r["message"]) for r in rejected.collect()))

    # the second write of a batch fails: the stream stops, and starts again at this batch
    import tidewater.streaming.scoring_stream as stream
    whole = stream.split_batch

    def broken(*args):
        scored, rejected = whole(*args)
        return scored, rejected.withColumn("message", F.raise_error(F.lit("lost")).cast("string"))

    monkeypatch.setattr(stream, "split_batch", broken)
    with pytest.raises(Exception, match="lost|scoring|STREAM"):
        run()
    monkeypatch.setattr(stream, "split_batch", whole)
    run()
    first = tables()
    assert first[0] == sorted([*[str(i) for i in range(60)], "-"])
    assert first[1] == [("-", "body", "Request must be one JSON object"), ("500", "age", "Age must be a finite number")]
    # repeats in a later file, and a restart without new files
    (src / "b.json").write_text("\n".join([lines[3], lines[70], lines[70], "[1, 2"]))
    run()
    run()
    scored, rejected = tables()
    assert scored == sorted([*first[0], "70"])
    assert [r[1] for r in rejected].count("body") == 2 and len(rejected) == 3


def test_load_table_replaces_and_publishes_valid_rows(spark, tmp_path):
    p, out = tmp_path / "t.csv", str(tmp_path / "loaded")
    p.write_text("id,target\n1,2.5\n2,\n3,4,5\n4,1.5\n")
    for _ in range(2):          # a second load replaces the first
        table = load_table(spark, str(p), out, "rows_to_model", valid="target is not null")
        assert table.count() == 3 and table.select("id").count() == 3
    assert sorted(r["id"] for r in spark.table("rows_to_model").collect()) == [1, 4]
    with pytest.raises(FileNotFoundError):
        load_table(spark, str(tmp_path / "none.csv"), out, "x")


def test_score_requests_readiness_coverage_and_values(spark):
    df, model = _model(spark)
    reqs = df.drop("target_log")
    out, rejected = score_requests(reqs, model, -1.4, 1.5, explain=True, interval_coverage=0.8080)
    assert rejected.count() == 0
    rows = {r["request_id"]: r for r in out.collect()}
    given = {r["request_id"]: r for r in reqs.collect()}
    assert {r["interval_coverage"] for r in rows.values()} == {0.8080}
    seen = 0
    for k, r in rows.items():
        for e in [*r["top_positive"], *r["top_negative"]]:
            want = given[k][e["feature"]]
            if "=" in e["transformed_feature"]:
                assert e["transformed_feature"] == f"{e['feature']}={e['feature_value']}" and want == e["feature_value"]
            else:
                assert float(e["feature_value"]) == want
            seen += 1
    assert seen > 300
    for bad in ((None, -1.0, 1.0, 0.8), (model, float("nan"), 1.0, 0.8), (model, -1.0, 1.0, 0.0)):
        with pytest.raises(NotReadyError):
            score_requests(reqs, *bad[:3], interval_coverage=bad[3])


def test_scoring_frame_fills(spark):
    df, _ = _model(spark)
    row = scoring_frame(df.limit(1)).first()
    assert row["height_in_cm"] is None and row["foot"] is None
    zero = scoring_frame(df.limit(1), missing="zero").first()
    assert zero["height_in_cm"] == 0.0 and zero["current_club_id"] == 0.0 and zero["foot"] == ""
    with pytest.raises(ValueError):
        scoring_frame(df, missing="none")


def test_zero_fill_equals_zeros_given(spark):
    df, model = _model(spark)
    gaps = df.withColumn("w365_goals", F.lit(None).cast("double"))
    zeros = df.withColumn("w365_goals", F.lit(0.0))
    a = {r["request_id"]: r["pred_log"] for r in model.predict(gaps, missing="zero").collect()}
    b = {r["request_id"]: r["pred_log"] for r in model.predict(zeros).collect()}
    assert a == pytest.approx(b)
    ex = model.contributions(gaps, top_k=50, missing="zero").first()
    values = {e["feature"]: e["feature_value"] for e in [*ex["top_positive"], *ex["top_negative"]]}
    assert values["w365_goals"] == "0.0"


def test_explanations_are_one_literal_in_the_plan(spark):
    df, model = _model(spark)
    plan = model.contributions(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan.lower() and "Python" not in plan


def test_request_files_are_small_enough_for_all_cores(spark, tmp_path, monkeypatch):
    """Compressed request files can't be split: they are as many as the table has parts of a size."""
    import tidewater.plans.model_queries as queries
    table, folder = str(tmp_path / "t"), str(tmp_path / "in")
    spark.range(20_000).select(F.col("id").cast("string").alias("request_id"), F.rand(1).alias("age")).coalesce(1).write.option(
        "parquet.block.size", 16_384).parquet(table)
    monkeypatch.setattr(queries, "PARTITION_BYTES", 32_768, raising=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    queries._request_files(spark, table, spark.read.parquet(table), folder)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert len([p for p in (tmp_path / "in" / "set=1").iterdir() if p.name.startswith("part-")]) > 3
    assert spark.read.json(f"{folder}/set=1").select("request_id").distinct().count() == 20_000
