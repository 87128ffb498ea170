"""Trailing-window ("lookback") aggregates before each dated anchor row.

Semantics (C2 + D1 + C3): for every anchor row (entity e, time t) and every
window length N, count the fact rows of the same entity with
``t - N <= fact_time < t`` and sum their measures; anchors without facts get
0. Same-time facts are excluded, which is what makes the features safe from
leakage.

Plan (E1), the same at every grain, by additive time buckets:

1. facts are pre-aggregated per (entity, time unit) — a partial+final hash
   aggregate — and then per (entity, bucket), with a bucket width that divides
   every window length and leaves at most ``BUCKETS`` buckets in the longest
   (at day grain a bucket is a day);
2. a window is the end of its first bucket, a run of whole buckets, and the
   start of the anchor's bucket. The two edges are running sums inside
   (entity, bucket), from either end;
3. the run of whole buckets between them is a frame of at most ``BUCKETS`` bucket
   totals, for all window lengths in one window node.

Every number is a sum of the facts in its window only: nothing is subtracted, so
small and huge measures neither cancel nor round each other away. Each step is
partitioned by (entity, bucket), or by entity over rows that are at most one per
bucket: an entity with a third of all facts spreads over its buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import try_double

#: Buckets that the longest window may have.
BUCKETS = 512
#: Buckets between the place of a total and that of a point of the same time: more than times span.
AFTER = 1 << 60

UNIT_PER_DAY = {"day": 1, "second": 86_400, "micros": 86_400 * 1_000_000}

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def time_units(df: DataFrame, col: str, unit: str) -> Column:
    """Integer time in ``unit`` (days since epoch, seconds or microseconds).

    Timezone-free for ``TIMESTAMP_NTZ`` and ``DATE`` columns."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if unit == "day":
        return F.unix_date(F.to_date(c))
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)
    elif isinstance(dtype, T.DateType):
        micros = F.unix_date(c).cast("bigint") * F.lit(86_400_000_000)
    else:
        micros = F.unix_micros(c.cast("timestamp"))
    if unit == "micros":
        return micros
    if unit == "second":
        return F.floor(micros / F.lit(1_000_000)).cast("bigint")
    raise ValueError(f"unknown unit {unit!r}")


def bucket_width(lengths: Iterable[int]) -> int:
    """The smallest common divisor of all lengths that cuts the longest into at most ``BUCKETS``."""
    lengths = list(lengths)
    common, longest = math.gcd(*lengths), max(lengths)
    parts = max(1, min(common, BUCKETS * common // longest))
    return common // next(d for d in range(parts, 0, -1) if common % d == 0)


def _stacked(rows: DataFrame, at: str, points: DataFrame, spans: Mapping[str, int], names: list[str]) -> DataFrame:
    """``__e, __p, __kind, __at, __w``, measures: the rows of ``rows`` (kind 1), and for each
    point (kind 0) its own place (``__w`` null) and that of each window's begin."""
    starts = F.array(*[F.struct(F.lit(w).cast("int").alias("w"), F.lit(back).cast("bigint").alias("back"))
                       for w, back in [(None, 0), *enumerate(spans.values())]])
    marks = points.select("__e", "__at", F.explode(starts).alias("s")).select(
        "__e", (F.col("__at") - F.col("s.back")).alias("__p"), F.lit(0).alias("__kind"), "__at", F.col("s.w").alias("__w"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in names])
    facts = rows.select("__e", F.col(at).alias("__p"), F.lit(1).alias("__kind"), F.lit(None).cast("bigint").alias("__at"),
                        F.lit(None).cast("int").alias("__w"), *names)
    return facts.unionByName(marks)


def _running(part: list[Column]) -> tuple:
    """Running sums from the start of a part up to before a point, and from its end down to a
    point: points come before facts of the same place in the one and after them in the other."""
    rows = (Window.unboundedPreceding, Window.currentRow)
    return (Window.partitionBy(*part).orderBy("__p", "__kind").rowsBetween(*rows),
            Window.partitionBy(*part).orderBy(F.desc("__p"), F.desc("__kind")).rowsBetween(*rows))


def _run_sums(totals: DataFrame, points: DataFrame, spans: Mapping[str, int], names: list[str]) -> DataFrame:
    """``__e, __at, {prefix}{name}``: sums over the buckets ``[at - L, at)`` for each prefix's L.
    One sort by (entity, bucket) and one window node for all lengths; a frame has one row per
    bucket at most, and an entity as many rows as it has buckets and distinct points. Points
    come ``AFTER`` all totals, with frames that reach back over it: the frames of totals, which
    nobody reads, are empty and are not summed."""
    marks = points.select("__e", (F.col("__at") + F.lit(AFTER)).alias("__p"), *[F.lit(None).cast(totals.schema[c].dataType).alias(c) for c in names])
    stacked = totals.select("__e", F.col("__b").alias("__p"), *names).unionByName(marks)
    ordered = Window.partitionBy("__e").orderBy("__p")
    sums = [F.sum(c).over(ordered.rangeBetween(-AFTER - length, -AFTER - 1)).alias(f"{prefix}{c}") for prefix, length in spans.items() for c in names]
    found = stacked.select("__e", "__p", *sums).where(F.col("__p") >= AFTER // 2)
    return found.select("__e", (F.col("__p") - F.lit(AFTER)).alias("__at"), *[f"{prefix}{c}" for prefix in spans for c in names])


def _edge_sums(facts: DataFrame, points: DataFrame, spans: Mapping[str, int], width: int, names: list[str]) -> DataFrame:
    """``__e, __at, {prefix}{name}``: sums over the facts of a window that lie in the bucket of
    its begin, and in the bucket of its end (the anchor's)."""
    stacked = _stacked(facts, "__t", points, spans, names).withColumn("__bucket", F.floor(F.col("__p") / F.lit(width)))
    up, down = _running([F.col("__e"), F.col("__bucket")])
    marks = stacked.withColumns({f"__up{c}": F.sum(c).over(up) for c in names} | {f"__down{c}": F.sum(c).over(down) for c in names})
    return marks.where(F.col("__kind") == 0).groupBy("__e", "__at").agg(*[
        F.sum(F.when(F.col("__w").isNull(), F.col(f"__up{c}")).when(F.col("__w") == i, F.col(f"__down{c}"))).alias(f"{prefix}{c}")
        for i, prefix in enumerate(spans) for c in names])


def lookback_aggregate(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    entity: str,
    anchor_time: str,
    fact_time: str | None = None,
    fact_entity: str | None = None,
    measures: Mapping[str, str | Column] | None = None,
    windows: Mapping[str, int] | None = None,
    count_name: str = "games_played",
    unit: str = "day",
    by: Callable[[Column, Column], Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Add ``{prefix}_{count_name}`` and ``{prefix}_{measure}`` columns to ``anchors``.

    ``windows`` maps a prefix to a window length in days (e.g. ``{"w180": 180}``).
    ``measures`` maps output names to fact columns/expressions; non-numeric or
    missing values count as 0 (B18). Anchor rows are never dropped. ``unit`` is the
    grain at which times are compared: ``day``, ``second`` or ``micros``. ``by`` names columns
    that follow from an entity and a time in units: written under
    :func:`tidewater.session.partitioned_joins` the rows come out partitioned and, unless
    few, sorted by them, without a shuffle of their own; those that ``anchors`` has stay."""
    windows = dict(windows or {"w180": 180, "w365": 365})
    measures = dict(measures or {})
    fact_time = fact_time or anchor_time
    fact_entity = fact_entity or entity
    names = ["__n"] + [f"__m_{name}" for name in measures]
    lengths = {prefix: days * UNIT_PER_DAY[unit] for prefix, days in windows.items()}
    width = bucket_width(lengths.values())

    f = facts.select(
        F.col(fact_entity).alias("__e"),
        time_units(facts, fact_time, unit).cast("bigint").alias("__t"),
        *[F.coalesce(try_double(m if isinstance(m, Column) else F.col(m)), F.lit(0.0)).alias(f"__m_{name}")
          for name, m in measures.items()],
    ).where(F.col("__e").isNotNull() & F.col("__t").isNotNull())
    per_time = f.groupBy("__e", "__t").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(f"__m_{name}").alias(f"__m_{name}") for name in measures],
    )
    keys = (
        anchors.select(F.col(entity).alias("__e"), time_units(anchors, anchor_time, unit).cast("bigint").alias("__at"))
        .where(F.col("__e").isNotNull() & F.col("__at").isNotNull()).distinct()
    )
    if width == 1:
        per_key = _run_sums(per_time.withColumnRenamed("__t", "__b"), keys, lengths, names)
    else:
        bucket = F.floor(F.col("__t") / F.lit(width))
        totals = per_time.groupBy("__e", bucket.alias("__b")).agg(*[F.sum(c).alias(c) for c in names])
        # whole buckets: between the bucket of the begin and the anchor's
        inner = {prefix: length // width - 1 for prefix, length in lengths.items() if length > width}
        edges = _edge_sums(per_time, keys, lengths, width, names).withColumn("__tb", F.floor(F.col("__at") / F.lit(width)))
        per_key = edges
        if inner:
            tails = keys.select("__e", F.floor(F.col("__at") / F.lit(width)).alias("__at")).distinct()
            runs = _run_sums(totals, tails, inner, names)
            runs = runs.select(F.col("__e"), F.col("__at").alias("__tb"), *[F.col(f"{p}{c}").alias(f"__run_{p}{c}") for p in inner for c in names])
            per_key = edges.join(runs, ["__e", "__tb"], "left").withColumns({
                f"{p}{c}": F.coalesce(F.col(f"{p}{c}"), F.lit(0)) + F.coalesce(F.col(f"__run_{p}{c}"), F.lit(0)) for p in inner for c in names})
    outputs = {f"{prefix}{c}": f"{prefix}_{count_name if c == '__n' else c[len('__m_'):]}" for prefix in windows for c in names}
    per_key = per_key.select("__e", F.col("__at").alias("__t"), *[F.col(c).alias(out) for c, out in outputs.items()])

    # back to every anchor row; the right side is unique per key
    keyed = anchors.withColumn("__e", F.col(entity)).withColumn("__t", time_units(anchors, anchor_time, unit).cast("bigint"))
    parts = dict(by(F.col("__e").cast(anchors.schema[entity].dataType), F.col("__t"))) if by else {}
    if parts:
        keyed, per_key = (side.withColumns(parts).repartition(*parts) for side in (keyed, per_key))
    joined = keyed.join(per_key, on=[*parts, "__e", "__t"], how="left")
    return joined.withColumns({
        out: F.coalesce(F.col(out), F.lit(0).cast("bigint") if c.endswith("__n") else F.lit(0.0)) for c, out in outputs.items()
    }).drop("__e", "__t", *[c for c in parts if c not in anchors.columns])
