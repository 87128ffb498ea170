"""Feature derivation: rate features, rare-category collapse, feature-group selection
(B23, B24, B26, D8, C8, E8) and the versioned feature builder (L1).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_category, positive_flag, safe_divide
from ..sources.readers import require_columns

# Fixed names of the per-window totals the rate features are built from.
TOTALS = ("games_played", "minutes_played", "goals", "assists", "yellow_cards", "red_cards")


# Derived column → (totals summed on top, what they are divided by).
RATES: dict[str, tuple[tuple[str, ...], str]] = {
    "minutes_per_game": (("minutes_played",), "games_played"),
    "goals_per90": (("goals",), "span"),
    "assists_per90": (("assists",), "span"),
    "g_plus_a_per90": (("goals", "assists"), "span"),
    "yellow_per90": (("yellow_cards",), "span"),
    "red_per90": (("red_cards",), "span"),
}


def rate_columns(prefix: str, per: float = 90.0) -> dict[str, Column]:
    """Column expressions of the derived columns of one window (B23, B24): the table
    ``RATES`` with ``span`` as the minutes in units of ``per``, and the activity flag."""
    total = {t: F.col(f"{prefix}_{t}") for t in TOTALS}
    divisors = {**total, "span": safe_divide(total["minutes_played"], per)}
    out = {}
    for name, (top, divisor) in RATES.items():
        amount = total[top[0]]
        for extra in top[1:]:
            amount = amount + total[extra]
        out[f"{prefix}_{name}"] = safe_divide(amount, divisors[divisor])
    out[f"{prefix}_played_any_minutes"] = positive_flag(total["minutes_played"])
    return out


def add_rate_features(df: DataFrame, prefixes: Sequence[str] = ("w180", "w365"), per: float = 90.0) -> DataFrame:
    """Add the derived rate columns of every window in one projection."""
    cols: dict[str, Column] = {}
    for p in prefixes:
        require_columns(df, [f"{p}_{t}" for t in TOTALS], what=p)
        cols.update(rate_columns(p, per))
    return df.withColumns(cols)


def category_counts(df: DataFrame, col: str, missing: str = "Unknown") -> DataFrame:
    """Frequencies of the cleaned category."""
    return df.groupBy(clean_category(col, missing).alias(col)).agg(F.count(F.lit(1)).alias("n"))



def collapse_rare_categories(
    df: DataFrame,
    specs: Mapping[str, int],
    other_label: str = "Other",
    missing: str = "Unknown",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Keep each column's ``top_k`` values (after NULL→Unknown + strip), rest → Other.

    The kept values come from :func:`fit_top_categories`; only k values per column reach
    the driver, and they are applied with ``isin`` (k is small by definition). ``fit_on``
    lets the counts come from the training side only (the reference counts all rows, §8.7)."""
    keep = fit_top_categories(fit_on if fit_on is not None else df, specs, missing)
    return apply_collapse(df, keep, other_label, missing)


#: Values that a column's sketch tracks. Any value in more than 7 / TRACKED of the rows is
#: sure to be among its candidates (the sketch's error is 3.5 / map size at most, twice).
TRACKED = 10_000


def fit_top_categories(src: DataFrame, specs: Mapping[str, int], missing: str = "Unknown",
                       tracked: int = TRACKED) -> dict[str, list[str]]:
    """Each column's ``top_k`` cleaned values by count, ties by value.

    Exact heavy hitters by a mergeable frequent-items sketch per column, so that no list of
    all values is ever shuffled. A column whose values the sketch could all keep is counted
    by it alone, in one pass for all such columns; of the others the sketch only names
    candidates (:func:`heavy_values`)."""
    for c in specs:
        require_columns(src, [c])
    names = {f"c{i}": c for i, c in enumerate(specs)}
    raw = src.select(*[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(n) for n, c in names.items()])
    sketched = raw.agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(F.expr(f"approx_top_k({n}, {tracked}, {tracked})").alias("items"), F.approx_count_distinct(n).alias("values")).alias(n)
        for n in names])
    items = sketched.select("rows", F.explode(F.array(*[F.struct(F.lit(n).alias("col"), F.col(n).alias("s")) for n in names])).alias("e"))
    # never more values than a sketch has places: its counts are exact and add up
    held = F.aggregate("e.s.items", F.lit(0).cast("bigint"), lambda total, x: total + x["count"])
    whole = (held == F.col("rows")) & (F.col("e.s.values") < tracked // 2)
    listed = items.select(F.col("e.col").alias("col"), whole.alias("whole"), F.explode("e.s.items").alias("x"))
    counts = listed.groupBy("col", "whole", clean_category("x.item", missing).alias("value")).agg(F.sum("x.count").alias("n"))
    limits = F.create_map(*[F.lit(x) for n, c in names.items() for x in (n, specs[c])])
    place = F.row_number().over(Window.partitionBy("col").orderBy(F.desc("n"), F.asc("value")))
    best = counts.withColumn("place", place).where(F.col("place") <= limits[F.col("col")]).collect()
    found = {n: [r["value"] for r in sorted(best, key=lambda r: r["place"]) if r["col"] == n] for n in names}
    kept = {r["col"] for r in best if r["whole"]}
    rest = {c: specs[c] for n, c in names.items() if n not in kept}
    return {c: found[n] for n, c in names.items() if n in kept} | (heavy_values(src, rest, missing, tracked) if rest else {})


def heavy_values(src: DataFrame, specs: Mapping[str, int], missing: str = "Unknown", tracked: int = TRACKED) -> dict[str, list[str]]:
    """:func:`fit_top_categories` of columns with very many values, in one job: a sketch of the
    cleaned values names at most ``tracked`` candidates, which are then counted exactly. The
    counts prove the answer: a value that is no candidate has at most as many rows as all
    candidates leave over, and at most the sketch's error. Where that doesn't put it below
    the k-th, the column's values are all counted instead."""
    cols = list(specs)
    names = [f"c{i}" for i in range(len(cols))]
    cleaned = src.select(*[clean_category(c, missing).alias(n) for n, c in zip(names, cols)])
    sketched = cleaned.agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"approx_top_k({n}, {tracked}, {tracked})").alias(n) for n in names])
    # tracked values per column at most
    candidates = sketched.select("rows", F.explode(F.array(*[
        F.struct(F.lit(n).alias("col"), F.col(f"{n}.item").alias("items")) for n in names])).alias("s")).select(
        "rows", F.col("s.col").alias("col"), F.explode("s.items").alias("value"))
    long = cleaned.unpivot([], names, "col", "value")
    counts = long.join(F.broadcast(candidates), ["col", "value"]).groupBy("col", "value", "rows").agg(F.count(F.lit(1)).alias("n"))
    by_column = Window.partitionBy("col")
    place = F.row_number().over(by_column.orderBy(F.desc("n"), F.asc("value")))
    limits = F.create_map(*[F.lit(x) for c, n in zip(cols, names) for x in (n, specs[c])])
    best = counts.withColumns({"place": place, "left": F.col("rows") - F.sum("n").over(by_column)}).where(F.col("place") <= limits[F.col("col")])
    found: dict[str, list] = {n: [] for n in names}
    for r in sorted(best.collect(), key=lambda r: r["place"]):
        found[r["col"]].append(r)
    out = {}
    for c, n in zip(cols, names):
        own, k = found[n], specs[c]
        least = own[-1]["n"] if len(own) >= k and own else 0
        sure = own and (own[0]["left"] < max(least, 1) or (least and least > 7 * own[0]["rows"] / tracked))
        out[c] = [r["value"] for r in own] if sure else count_top(cleaned.select(n), n, k)
    return out


def count_top(df: DataFrame, col: str, k: int) -> list[str]:
    """The ``k`` most frequent values of a column by counting all of them."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return [r[col] for r in counts.orderBy(F.desc("n"), F.asc(col)).limit(k).collect()]


def apply_collapse(df: DataFrame, keep: Mapping[str, Sequence[str]], other_label: str = "Other",
                   missing: str = "Unknown") -> DataFrame:
    """Values outside the kept lists → ``other_label`` (C8); the lists are small by definition."""
    out = {}
    for c, values in keep.items():
        v = clean_category(c, missing)
        out[c] = F.when(v.isin(list(values)), v).otherwise(F.lit(other_label))
    return df.withColumns(out)


# ---------------------------------------------------------------------------
# Feature groups for ablations
# ---------------------------------------------------------------------------

# Fixed names: ablation mode → groups of columns it leaves out, or the groups it is made of.
DROPPED = {"full": (), "no_nationality": ("nationality",), "no_context": ("nationality", "context")}
MADE_OF = {"performance_only": ("core", "windows")}


def select_feature_group(
    columns: Sequence[str],
    mode: str | None,
    *,
    nationality: Sequence[str] = ("country_of_birth", "country_of_citizenship"),
    context: Sequence[str] = ("player_club_domestic_competition_id",),
    core: Sequence[str] = ("age", "position"),
    window_prefixes: Sequence[str] = ("w180_", "w365_"),
) -> list[str]:
    """The columns that a mode of the tables ``DROPPED`` and ``MADE_OF`` feeds to the model
    (none: all); an input column belongs to a group by its name or its window's prefix."""
    chosen = "full" if mode is None else mode
    by_prefix = [c for c in columns if c.startswith(tuple(window_prefixes))]
    groups = {"nationality": nationality, "context": context, "core": core, "windows": by_prefix}
    if chosen in MADE_OF:
        wanted = set().union(*(groups[g] for g in MADE_OF[chosen]))
        return [c for c in columns if c in wanted]
    if chosen not in DROPPED:
        raise ValueError(f"no ablation mode {chosen!r}; known are {sorted({**DROPPED, **MADE_OF})}")
    left_out = {c for g in DROPPED[chosen] for c in groups[g]}
    return [c for c in columns if c not in left_out]
