"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is materialised with a no-op write (``format("noop")``) so the
full plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import star_queries as Q  # noqa: E402
from tidewater.session import local_session, release_scratch  # noqa: E402

HEADLINE = [
    "lookback_totals", "lookback_rates", "event_lookback", "time_split", "baseline_metrics", "error_by_position",
    "calibration_deciles", "smearing_groupwise", "prediction_intervals", "collapse_categories", "group_performance",
    "null_profile", "validate_requests", "score_bands", "report_lines", "ablation", "ridge_explain",
]

SHARED = {
    "shared_anchors": Q.model_base,
    "shared_cutoff": Q.cutoff_for,
    "shared_lookback": Q.anchor_lookback,
    "shared_scored": Q.scored,
    "shared_ridge_fit": Q._ridge_setup,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="tidewater-bench")
    names = sys.argv[1:] or HEADLINE
    # warm-up (not timed): JVM start, class loading and JIT of the scan / join /
    # aggregate / window code paths, on the smallest test tables
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        Q.QUERIES["lookback_totals"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    # tables that several queries start from, each on a line of its own: what follows
    # doesn't depend on the order of the queries
    for name, build in SHARED.items():
        t0 = time.perf_counter()
        build(spark, sf_dir)
        times[name] = round(time.perf_counter() - t0, 3)
    for name in names:
        fn = Q.QUERIES[name]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    release_scratch(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
