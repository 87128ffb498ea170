"""Lookback window operator: equivalence with the join form, skew, known answers, plan shape."""

import datetime as dt
import math
import random
import re

from pyspark.sql import functions as F

from tidewater.operators.lookback import bucket_width, lookback_aggregate
from tidewater.functions.scalar import try_double


def lookback_by_join(anchors, facts, *, anchor_key, entity, anchor_time, fact_time, measures, days, prefix,
                     count_name="games_played"):
    """Brute-force oracle: every (anchor, fact) pair of an entity, then a date mask (small data only)."""
    a = anchors.select(anchor_key, entity, F.to_date(anchor_time).alias("__d"))
    fa = facts.select(F.col(entity).alias("__fe"), F.to_date(fact_time).alias("__fd"),
                      *[F.coalesce(try_double(F.col(c)), F.lit(0.0)).alias(n) for n, c in measures.items()])
    j = a.join(fa, (a[entity] == fa["__fe"]) & (fa["__fd"] < a["__d"]) & (fa["__fd"] >= F.date_sub(a["__d"], days)),
               "left")
    return j.groupBy(anchor_key).agg(
        F.count("__fd").alias(f"{prefix}_{count_name}"),
        *[F.coalesce(F.sum(n), F.lit(0.0)).alias(f"{prefix}_{n}") for n in measures])

from conftest import SF01


def _random_frames(spark, seed=7, hot_share=0.4):
    rnd = random.Random(seed)
    base = dt.date(2020, 1, 1)
    anchors, facts = [], []
    for i in range(400):
        e = 0 if rnd.random() < hot_share else rnd.randint(1, 20)    # entity 0 holds a large share
        anchors.append((i, e, base + dt.timedelta(days=rnd.randint(0, 1500))))
    for j in range(3000):
        e = 0 if rnd.random() < hot_share else rnd.randint(1, 20)
        facts.append((j, e, base + dt.timedelta(days=rnd.randint(-400, 1500)), float(rnd.randint(0, 90)),
                      None if rnd.random() < 0.05 else float(rnd.randint(0, 3))))
    a = spark.createDataFrame(anchors, "aid long, e long, d date")
    f = spark.createDataFrame(facts, "fid long, e long, fd date, minutes double, goals double")
    return a, f


def test_equals_join_form_with_hot_entity(spark):
    a, f = _random_frames(spark)
    got = lookback_aggregate(a, f, entity="e", anchor_time="d", fact_time="fd",
                             measures={"minutes": "minutes", "goals": "goals"}, windows={"w180": 180, "w365": 365})
    for prefix, days in (("w180", 180), ("w365", 365)):
        ref = lookback_by_join(a, f.withColumnRenamed("fd", "d2"), anchor_key="aid", entity="e", anchor_time="d",
                               fact_time="d2", measures={"minutes": "minutes", "goals": "goals"}, days=days,
                               prefix=prefix)
        j = got.select("aid", *[F.col(f"{prefix}_{m}").alias(f"g_{m}") for m in ["games_played", "minutes",
                                                                                  "goals"]]).join(ref, "aid")
        bad = j.where((F.col("g_games_played") != F.col(f"{prefix}_games_played"))
                      | (F.abs(F.col("g_minutes") - F.col(f"{prefix}_minutes")) > 1e-9)
                      | (F.abs(F.col("g_goals") - F.col(f"{prefix}_goals")) > 1e-9))
        assert j.count() == 400
        assert bad.count() == 0


def test_same_day_excluded_and_window_edge(spark):
    a = spark.createDataFrame([(1, 1, dt.date(2021, 7, 1))], "aid long, e long, d date")
    f = spark.createDataFrame([
        (1, dt.date(2021, 7, 1), 10.0),     # same day: excluded
        (1, dt.date(2021, 6, 30), 1.0),     # yesterday: in
        (1, dt.date(2021, 1, 2), 100.0),    # exactly 180 days before: in (>= t - N)
        (1, dt.date(2021, 1, 1), 1000.0),   # 181 days before: out of w180, in w365
        (2, dt.date(2021, 6, 30), 5.0),     # other entity
    ], "e long, d date, m double")
    r = lookback_aggregate(a, f, entity="e", anchor_time="d", measures={"m": "m"}).first()
    assert (r["w180_games_played"], r["w180_m"]) == (2, 101.0)
    assert (r["w365_games_played"], r["w365_m"]) == (3, 1101.0)


def test_anchor_without_facts_kept(spark):
    a = spark.createDataFrame([(1, 9, dt.date(2021, 7, 1)), (2, None, dt.date(2021, 7, 1))], "aid long, e long, d date")
    f = spark.createDataFrame([(1, dt.date(2021, 6, 30), 1.0)], "e long, d date, m double")
    rows = lookback_aggregate(a, f, entity="e", anchor_time="d", measures={"m": "m"}).orderBy("aid").collect()
    assert [(r["aid"], r["w180_games_played"], r["w365_m"]) for r in rows] == [(1, 0, 0.0), (2, 0, 0.0)]


def test_known_answers_sf001(spark):
    from tidewater.plans.star_queries import lookback_frame
    s = lookback_frame(spark, SF01).agg(F.count("*").alias("n"), F.sum("w180_games_played").alias("n180"),
                                        F.sum("w180_minutes_played").alias("q180"),
                                        F.sum("w365_games_played").alias("n365")).first()
    assert (s["n"], s["n180"], s["n365"]) == (15000, 46063, 89557)
    assert round(s["q180"]) == 1174463


def test_no_python_and_one_window_node_at_day_grain(spark):
    from tidewater.plans.star_queries import lookback_frame
    plan = lookback_frame(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    txt = lookback_frame(spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    assert txt.count("Window [") == 1 and "Expand" not in txt and "Generate" not in txt


def test_bucket_widths():
    day = 86_400_000_000
    assert bucket_width([180, 365]) == 1 and bucket_width([7]) == 1
    for lengths in ([7 * day, 14 * day], [day], [90 * 86_400, 3 * 86_400], [13, 11], [4099 * 8]):
        w = bucket_width(lengths)
        assert all(n % w == 0 for n in lengths) and (max(lengths) // w <= 512 or w == math.gcd(*lengths))


def _brute(anchors, facts, n):
    """(count, exact sum) of each anchor's window, in whole time units."""
    out = {}
    for i, e, t in anchors:
        own = [v for e2, t2, v in facts if e2 == e and t - n <= t2 < t]
        out[i] = (len(own), math.fsum(own))
    return out


def test_tiny_and_huge_values_neither_round_nor_cancel(spark):
    t0 = dt.datetime(2024, 1, 1)
    times = [0, 1, 86_399, 86_400, 200_000, 604_799, 604_800, 604_801, 1_000_000, 1_209_600, 1_300_000, 2_000_000]
    values = [1e27, 1e-13, 2e-13, 5.0, 1e27, 3e-13, 4e-13, 1e-13, 7e-13, 2.5, 1e-13, 1e-13]
    facts = [(0, s, v) for s, v in zip(times, values)] + [(1, 5, 1e-13)]
    anchors = [(i, 0, s) for i, s in enumerate([*times, 3_000_000, 604_802, 1_200_000])] + [(90, 1, 6), (91, 2, 6)]
    stamp = lambda s: t0 + dt.timedelta(seconds=s)
    f = spark.createDataFrame([(e, stamp(s), v) for e, s, v in facts], "e long, ts timestamp_ntz, v double")
    a = spark.createDataFrame([(i, e, stamp(s)) for i, e, s in anchors], "aid long, e long, ts timestamp_ntz")
    for unit in ("micros", "second"):
        got = lookback_aggregate(a, f, entity="e", anchor_time="ts", measures={"v": "v"}, windows={"d1": 1, "d7": 7, "d14": 14}, count_name="n", unit=unit)
        rows = {r["aid"]: r for r in got.collect()}
        for prefix, days in (("d1", 1), ("d7", 7), ("d14", 14)):
            for i, (n, total) in _brute(anchors, facts, days * 86_400).items():
                assert rows[i][f"{prefix}_n"] == n
                assert math.isclose(rows[i][f"{prefix}_v"], total, rel_tol=1e-12), (unit, prefix, i)


def test_random_windows_at_every_grain(spark):
    rnd = random.Random(3)
    facts = [(rnd.choice([0, 0, 0, 1, 2]), rnd.randrange(-400 * 86_400, 60 * 86_400), float(rnd.randrange(1, 9))) for _ in range(1500)]
    anchors = [(i, rnd.choice([0, 0, 1, 2, 3]), rnd.randrange(-300 * 86_400, 80 * 86_400)) for i in range(200)]
    # before and after the epoch: negative and positive places
    stamp = lambda s: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
    f = spark.createDataFrame([(e, stamp(s), v) for e, s, v in facts], "e long, ts timestamp_ntz, v double")
    a = spark.createDataFrame([(i, e, stamp(s)) for i, e, s in anchors], "aid long, e long, ts timestamp_ntz")
    for unit, grain in (("day", 86_400), ("second", 1), ("micros", 1)):
        got = lookback_aggregate(a, f, entity="e", anchor_time="ts", measures={"v": "v"}, windows={"a": 3, "b": 30, "c": 90}, count_name="n", unit=unit)
        rows = {r["aid"]: r for r in got.collect()}
        cut = lambda rows: [(i, e, s // grain) for i, e, s in rows]
        for prefix, days in (("a", 3), ("b", 30), ("c", 90)):
            want = _brute(cut(anchors), [(e, s // grain, v) for e, s, v in facts], days * 86_400 // grain)
            assert {i: (r[f"{prefix}_n"], r[f"{prefix}_v"]) for i, r in rows.items()} == want


def test_microsecond_grain_matches_bruteforce(spark):
    rnd = random.Random(1)
    t0 = dt.datetime(2024, 1, 1)
    ev = [(i, 0 if rnd.random() < 0.6 else rnd.randint(1, 4),
           t0 + dt.timedelta(seconds=rnd.randint(0, 30 * 86400), microseconds=rnd.choice([0, 1, 999999])),
           float(rnd.randint(1, 50)) / 4) for i in range(600)]
    ev.append((600, 0, ev[0][2], 1.0))                 # same timestamp as another event: excluded both ways
    df = spark.createDataFrame(ev, "event_id long, user_id long, ts timestamp_ntz, value double")
    got = lookback_aggregate(df.select("event_id", "user_id", "ts"), df, entity="user_id", anchor_time="ts",
                             measures={"value": "value"}, windows={"d7": 7}, count_name="n", unit="micros")
    rows = {r["event_id"]: (r["d7_n"], r["d7_value"]) for r in got.collect()}
    for i, u, t, _ in ev:
        sel = [v for j, u2, t2, v in ev if u2 == u and t - dt.timedelta(days=7) <= t2 < t]
        assert rows[i][0] == len(sel) and abs(rows[i][1] - sum(sel)) < 1e-9


def test_windows_sum_for_points_only(spark):
    """Rows of facts have empty frames: the window sums over the frames of points, whose rows
    lie after all facts; times before 1970 and a point on a fact's day come out right."""
    from tidewater.operators.lookback import _run_sums
    totals = spark.createDataFrame([(1, -5, 1.5), (1, 0, 2.0), (1, 3, 4.0), (2, 3, 8.0)], "__e long, __b long, v double")
    points = spark.createDataFrame([(1, -5), (1, 0), (1, 3), (1, 4), (2, 500)], "__e long, __at long")
    out = _run_sums(totals, points, {"a": 5, "b": 400}, ["v"])
    assert sorted(map(tuple, out.collect())) == [(1, -5, None, None), (1, 0, 1.5, 1.5), (1, 3, 2.0, 3.5), (1, 4, 6.0, 7.5), (2, 500, None, None)]
    frames = re.findall(r"RangeFrame, (-?\d+), (-?\d+)", out._jdf.queryExecution().optimizedPlan().toString())
    assert frames and all(int(high) < -10**17 for _, high in frames)
