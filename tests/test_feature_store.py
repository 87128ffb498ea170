"""Incremental features and replaced tables: only what is reached is rewritten, readers see no gap."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidewater.operators.feature_store import FeatureStore
from tidewater.operators.lookback import lookback_aggregate
from tidewater.sources.manifest import current_table, read_json, replace_table
from tidewater.sources.readers import load_table

DAY0 = dt.date(2021, 1, 1)


def _rows(seed, n, first, last, entities=12):
    pick = random.Random(seed)
    return [(seed * 10_000 + i, pick.randrange(entities), DAY0 + dt.timedelta(days=pick.randrange(first, last)), float(pick.randrange(90))) for i in range(n)]


def _files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_day_rewrites_its_cells_only_and_equals_a_rebuild(spark, tmp_path):
    facts, anchors = _rows(1, 400, -30, 500), _rows(2, 150, 0, 520)
    store = FeatureStore(str(tmp_path / "s"), entity="e", anchor_time="d", fact_time="d", measures={"m": "m"}, windows={"w30": 30, "w90": 90},
                         count_name="n", entity_buckets=4, block_days=30, finish=lambda df: df.withColumn("twice", F.col("w30_m") * 2))
    frame = lambda rows, kind: spark.createDataFrame(rows, f"{kind}_id long, e long, d date, m double")

    def rebuilt(a, f):
        out = lookback_aggregate(frame(a, "anchor").drop("m"), frame(f, "fact"), entity="e", anchor_time="d", measures={"m": "m"}, windows={"w30": 30, "w90": 90}, count_name="n")
        return sorted(map(tuple, out.withColumn("twice", F.col("w30_m") * 2).select("anchor_id", "w30_n", "w30_m", "w90_n", "w90_m", "twice").collect()))

    def stored():
        return sorted(map(tuple, store.features(spark, ["anchor_id", "w30_n", "w30_m", "w90_n", "w90_m", "twice"]).collect()))

    store.add(spark, "first", frame(anchors, "anchor").drop("m"), frame(facts, "fact"))
    assert stored() == rebuilt(anchors, facts)
    before = _files(store.feature_path)
    # one day of facts of two entities, and one new anchor
    day = DAY0 + dt.timedelta(days=200)
    new_facts = [(90_000, 3, day, 7.0), (90_001, 5, day, 1.0)]
    new_anchors = [(90_002, 3, day + dt.timedelta(days=2), 0.0), (90_003, None, day, 0.0), (90_004, 3, None, 0.0)]
    cells = store.add(spark, "day 200", frame(new_anchors, "anchor").drop("m"), frame(new_facts, "fact"))
    assert stored() == rebuilt([*anchors, new_anchors[0]], [*facts, *new_facts])
    after = _files(store.feature_path)
    touched = {(r.cell_bucket, r.cell_block) for r in cells.collect()}
    of = lambda path: tuple(int(part.split("=")[1]) for part in path.split(os.sep) if part.startswith("cell_"))
    kept = {p for p in before if of(p) not in touched}
    assert kept and all(after[p] == before[p] for p in kept)
    assert len(touched) <= 2 * 4 and not any(p in after for p in before if of(p) in touched)
    # the same batch again changes nothing; a late fact does
    store.add(spark, "day 200", frame(new_anchors, "anchor").drop("m"), frame(new_facts, "fact"))
    late = [(90_010, 3, DAY0 + dt.timedelta(days=100), 50.0)]
    store.add(spark, "late", facts=frame(late, "fact"))
    assert stored() == rebuilt([*anchors, new_anchors[0]], [*facts, *new_facts, *late])
    assert store.add(spark, "nothing") is None


def test_reader_sees_the_old_or_the_new_table(spark, tmp_path):
    out = str(tmp_path / "t")
    first = replace_table(spark.range(10).withColumnRenamed("id", "a"), out, {"odd": F.col("a") % 2 == 1})
    assert (first["rows"], first["odd"]) == (10, 5)
    reader = current_table(spark, out)
    replace_table(spark.range(3).withColumnRenamed("id", "a"), out)
    assert reader.count() == 10 and current_table(spark, out).count() == 3     # opened before the switch
    try:
        replace_table(spark.range(5).withColumn("a", F.raise_error(F.lit("bad row")).cast("int")), out)
    except Exception:  # noqa: BLE001
        pass
    assert current_table(spark, out).count() == 3                              # a load that failed leaves the old one
    replace_table(spark.range(4).withColumnRenamed("id", "a"), out)
    state = read_json(spark, f"{out}/_current.json")
    assert state["rows"] == 4 and len(state["earlier"]) == 1                   # older states are deleted
    assert not os.path.exists(os.path.join(out, first["folder"]))


def test_load_counts_without_a_scan(spark, tmp_path):
    p, out = tmp_path / "t.csv", str(tmp_path / "loaded")
    p.write_text("id,target\n1,2.5\n2,\n3,4,5\n4,1.5\n")
    load_table(spark, str(p), out, "rows_to_model", valid="target is not null")
    state = read_json(spark, f"{out}/_current.json")
    assert (state["rows"], state["valid"]) == (3, 2)


def test_files_follow_the_cells_not_the_tasks(spark, tmp_path):
    """Each written cell has its rows in few files however many tasks the tables come from."""
    schema = "e long, d date, m double, row_id long"
    rows = [(e, d, m, i) for i, e, d, m in _rows(3, 3000, 0, 200, entities=40)]
    facts, anchors = spark.createDataFrame(rows, schema).repartition(9), spark.createDataFrame(rows[:900], schema).repartition(9)
    store = FeatureStore(str(tmp_path / "s"), entity="e", anchor_time="d", fact_time="d", measures={"m": "m"}, windows={"w30": 30},
                         count_name="n", entity_buckets=2, block_days=100)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(keep, ("-1", "false")):
            spark.conf.set(k, v)
        store.add(spark, "1", anchors.drop("m"), facts)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    cells = 2 * 2
    assert cells <= len(_files(f"{tmp_path}/s/facts")) <= 2 * cells
    assert cells <= len(_files(store.feature_path)) <= 2 * cells
    assert store.features(spark, ["row_id"]).distinct().count() == 900
