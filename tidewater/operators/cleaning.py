"""Row/column cleaning operators (B1, B4–B8, B14–B20, L6), parameterised by column names.

Defaults are the reference's rule values; every one is a parameter so the
same operators clean any entity table. All are narrow projections/filters:
no shuffle, pushed into the scan where Catalyst can.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (age_years, clean_category, completed_years, exact_label_map, full_name,
                                null_outside, safe_date, substring_label_map, three_way_bucket, try_double)
from .profiling import drop_sparse_columns

# The reference's label maps, ranges and keyword rules.
FOOT_EXACT = [("Right", ["right", "r"]), ("Left", ["left", "l"]), ("Both", ["both", "b"])]
FOOT_SUBSTRING = [("Left", ["left"]), ("Right", ["right"]), ("Both", ["both", "ambi"])]
HEIGHT_KEEP_RANGE = (140.0, 220.0)      # values outside become NULL (feature build)
HEIGHT_DROP_RANGE = (150.0, 210.0)      # rows outside are dropped (player cleaning)
HEIGHT_BUCKETS = (170.0, 185.0)         # < 170 Short, <= 185 Average, else Tall
AGE_RANGE = (12.0, 50.0)
POSITION_RULES = [
    ("GK", ["goalkeeper", "keeper", "gk"]),
    ("DEF", ["defender", "back", "centre-back", "center-back", "cb", "lb", "rb", "lwb", "rwb", "wing-back"]),
    ("MID", ["midfield", "midfielder", "dm", "cm", "am", "wing", "wide"]),
    ("FWD", ["forward", "striker", "second striker", "centre-forward", "center-forward", "cf", "st", "winger"]),
]
ENTITY_BASE_COLUMNS = ["player_id", "date_of_birth", "position", "sub_position", "foot", "height_in_cm",
                       "country_of_citizenship", "country_of_birth"]
TEXT_COLUMNS = ["position", "sub_position", "country_of_citizenship", "country_of_birth"]


def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist (B1)."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.na.drop(subset=list(subset))


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with a strictly positive numeric value (B3 + B5)."""
    x = try_double(col)
    return df.withColumn(col, x).where(F.col(col) > 0)


def keep_between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Keep rows with lo <= x <= hi; NULL/NaN rows are dropped."""
    return df.where(try_double(col).between(lo, hi))


def default_numeric(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """Numeric facts: parse, missing → default; absent columns created as default."""
    return df.withColumns({c: (F.coalesce(try_double(c), F.lit(default)) if c in df.columns else F.lit(default))
                           for c in cols})


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*cols)


def entity_base(df: DataFrame, *, key: str = "player_id", birth: str = "date_of_birth", foot: str = "foot",
                height: str = "height_in_cm", text_cols: Sequence[str] = TEXT_COLUMNS,
                keep: Sequence[str] | None = None, height_range=HEIGHT_KEEP_RANGE,
                buckets=HEIGHT_BUCKETS) -> DataFrame:
    """Entity attributes safe at any anchor date (the feature build's entity base).

    Existing columns only (B1); birth date parse-or-NULL (B2); exact foot
    map (B9); height out of range → NULL (B6) and bucketed (B11); text
    categories NULL → Unknown and stripped (B12)."""
    base = select_existing(df, keep or [key, birth, *text_cols[:2], foot, height, *text_cols[2:]])
    cols = {}
    if birth in base.columns:
        cols[birth] = safe_date(birth)
    if foot in base.columns:
        cols[foot] = exact_label_map(foot, FOOT_EXACT)
    if height in base.columns:
        cols[height] = null_outside(height, *height_range)
    base = base.withColumns(cols)
    extra = {}
    if height in base.columns:
        extra["height_bucket"] = three_way_bucket(height, *buckets)
    for c in text_cols:
        if c in base.columns:
            extra[c] = clean_category(c)
    return base.withColumns(extra)


def add_age_at_anchor(df: DataFrame, date: str = "date", birth: str = "date_of_birth", out: str = "age",
                      age_range=AGE_RANGE) -> DataFrame:
    """Age at the anchor date in years (days / 365.25); rows without dates or
    outside the age range dropped (B4, B15, B8)."""
    d = df.na.drop(subset=[date, birth]).withColumn(out, age_years(date, birth))
    return d.where(F.col(out).between(*age_range))


def clean_entities(df: DataFrame, *, first: str = "first_name", last: str = "last_name", name: str = "name",
                   foot: str = "foot", birth: str = "date_of_birth", height: str = "height_in_cm",
                   sparse_threshold: float = 0.5, as_of=None, height_range=HEIGHT_DROP_RANGE,
                   buckets=HEIGHT_BUCKETS) -> DataFrame:
    """Entity-table cleaning job (L6): drop sparse columns (B14), full name
    (B13), substring foot map (B10), birth date parse + drop missing (B2, B4),
    completed-years age (B16), height filter (B7) and height category (B11)."""
    out = drop_sparse_columns(df, sparse_threshold)
    if all(c in out.columns for c in (first, last, name)):
        out = out.withColumn("full_name", full_name(first, last, name))
    if foot in out.columns:
        out = out.withColumn(foot, substring_label_map(foot, FOOT_SUBSTRING))
    out = out.withColumn(birth, safe_date(birth)).where(F.col(birth).isNotNull())
    out = out.withColumn("age", completed_years(birth, as_of))
    out = out.withColumn(height, try_double(height))
    out = keep_between(out, height, *height_range)
    return out.withColumn("height_category", three_way_bucket(height, *buckets, missing=None))
