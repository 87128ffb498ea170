"""Column-level building blocks (all JVM-side Catalyst expressions, no UDFs).

Every function takes and returns ``pyspark.sql.Column`` objects so it can be
used inside ``select``/``withColumns`` and stays inside whole-stage codegen.
Parsing and division use the ``try_*`` family: ANSI mode is on by default in
Spark 4 and a plain cast or ``/`` would fail the whole job on one bad value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_WS_TRIM = r"^\s+|\s+$"


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# Parsing / coercion
# ---------------------------------------------------------------------------

def try_double(col: ColumnOrName) -> Column:
    """Text or number → double; unparsable and NaN become NULL."""
    x = _c(col).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def try_int(col: ColumnOrName, default: int | None = None, dtype: str = "int") -> Column:
    """Text/number → int via double (``try_cast('2.0' as int)`` is NULL)."""
    x = try_double(col).try_cast(dtype)
    return F.coalesce(x, F.lit(default).cast(dtype)) if default is not None else x


def safe_timestamp(col: ColumnOrName) -> Column:
    """Parse-or-NULL date/time (B2); non-text inputs pass through unchanged."""
    return F.try_to_timestamp(_c(col).cast("string"))


def safe_date(col: ColumnOrName) -> Column:
    return F.to_date(safe_timestamp(col))


def strip_ws(col: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace incl. tabs and newlines (``trim`` keeps tabs)."""
    return F.regexp_replace(_c(col), _WS_TRIM, "")


# ---------------------------------------------------------------------------
# Arithmetic
# ---------------------------------------------------------------------------

def finite_or(col: ColumnOrName, default: float = 0.0) -> Column:
    """Replace NULL, NaN and ±inf by ``default``."""
    x = _c(col).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(x)


def safe_divide(numer: ColumnOrName, denom: ColumnOrName | float | int) -> Column:
    """Element-wise division that yields 0 where the denominator is 0/missing
    or the quotient is missing or infinite (B22). Scalar or column denominator."""
    n = _c(numer).cast("double")
    if isinstance(denom, (int, float)):
        if float(denom) == 0.0:
            return F.lit(0.0)
        return finite_or(n / F.lit(float(denom)))
    d = _c(denom).cast("double")
    return finite_or(F.try_divide(n, F.when(d != 0, d)))


def clip_lower(col: ColumnOrName, lower: float = 0.0) -> Column:
    """pandas ``clip(lower=…)``: NULL stays NULL (Spark ``greatest`` would skip it)."""
    x = _c(col)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(x.cast("double"), F.lit(float(lower))))


def safe_expm1(col: ColumnOrName) -> Column:
    """Back-transform a log1p value, clipped at 0."""
    return clip_lower(F.expm1(_c(col)))


def log_target(col: ColumnOrName) -> Column:
    """log1p target."""
    return F.log1p(_c(col).cast("double"))


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """part / whole × 100, NULL when whole is 0."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100.0)


def positive_flag(col: ColumnOrName) -> Column:
    """1 when value > 0 else 0 (NULL → 0)."""
    return F.coalesce((_c(col) > 0).cast("int"), F.lit(0))


# ---------------------------------------------------------------------------
# Dates (B15, B16)
# ---------------------------------------------------------------------------

def age_years(date: ColumnOrName, birth: ColumnOrName, days_per_year: float = 365.25) -> Column:
    """Age at a date in fractional years = whole days / 365.25."""
    return F.date_diff(F.to_date(_c(date)), F.to_date(_c(birth))).cast("double") / F.lit(days_per_year)


def completed_years(birth: ColumnOrName, as_of: ColumnOrName | None = None, days_per_year: int = 365) -> Column:
    """Whole 365-day years from birth to ``as_of`` (default today)."""
    ref = F.current_date() if as_of is None else F.to_date(_c(as_of))
    return F.floor(F.date_diff(ref, F.to_date(_c(birth))) / F.lit(days_per_year)).cast("bigint")


# ---------------------------------------------------------------------------
# Label maps and buckets
# ---------------------------------------------------------------------------

def null_outside(col: ColumnOrName, lo: float, hi: float) -> Column:
    """Keep the value when lo <= x <= hi, else NULL; the row is kept."""
    x = try_double(col)
    return F.when(x.between(lo, hi), x)


def exact_label_map(col: ColumnOrName, mapping: Sequence[tuple[str, Sequence[str]]],
                    missing: str = "Unknown", other: str = "Other") -> Column:
    """NULL → ``missing``; lower(strip(x)) in a token set → label; else ``other``."""
    x = _c(col)
    v = F.lower(strip_ws(x.cast("string")))
    expr = F.when(x.isNull(), F.lit(missing))
    for label, tokens in mapping:
        expr = expr.when(v.isin(list(tokens)), F.lit(label))
    return expr.otherwise(F.lit(other))


def substring_label_map(col: ColumnOrName, mapping: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """First rule whose any token is a substring of lower(strip(x)) wins; else NULL."""
    v = F.lower(strip_ws(_c(col).cast("string")))
    expr = None
    for label, tokens in mapping:
        cond = None
        for tok in tokens:
            c = v.contains(tok)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def three_way_bucket(col: ColumnOrName, low: float, high: float,
                     labels: tuple[str, str, str] = ("Short", "Average", "Tall"),
                     missing: str | None = "Unknown") -> Column:
    """< low → labels[0]; <= high → labels[1]; else labels[2]; NULL/NaN → ``missing``."""
    x = _c(col).cast("double")
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(missing).cast("string"))
        .when(x < low, F.lit(labels[0]))
        .when(x <= high, F.lit(labels[1]))
        .otherwise(F.lit(labels[2]))
    )


def clean_category(col: ColumnOrName, missing: str = "Unknown") -> Column:
    """Missing → ``missing``, then strip whitespace."""
    return strip_ws(F.coalesce(_c(col).cast("string"), F.lit(missing)))


def full_name(first: ColumnOrName, last: ColumnOrName, fallback: ColumnOrName) -> Column:
    """"first last" when both present, else ``fallback`` (may be NULL)."""
    f, l = _c(first), _c(last)
    return F.when(f.isNotNull() & l.isNotNull(), F.concat_ws(" ", f.cast("string"), l.cast("string"))).otherwise(
        _c(fallback).cast("string"))


def keyword_bucket(col: ColumnOrName, rules: Sequence[tuple[str, Sequence[str]]],
                   missing: str = "Unknown", other: str = "Other") -> Column:
    """Ordered keyword classification on lower(x): first matching rule wins."""
    x = _c(col)
    v = F.lower(x.cast("string"))
    expr = F.when(x.isNull(), F.lit(missing))
    for label, words in rules:
        cond = None
        for w in words:
            c = v.contains(w)
            cond = c if cond is None else (cond | c)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other))


def fixed_bins(col: ColumnOrName, edges: Sequence[float], as_label: bool = False) -> Column:
    """Left-closed bins [e_i, e_{i+1}); values outside the edges → NULL.

    Returns the bin index, or an interval label such as ``[18, 21)``."""
    x = _c(col).cast("double")
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        val = F.lit(f"[{_fmt_edge(lo)}, {_fmt_edge(hi)})") if as_label else F.lit(i)
        cond = (x >= lo) & (x < hi)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(None).cast("string" if as_label else "int"))


def _fmt_edge(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


# ---------------------------------------------------------------------------
# Report / scoring wording
# ---------------------------------------------------------------------------

# Fixed values that must equal the reference's wording and thresholds.
VALUATION_BANDS = [
    (2_000_000, "Development or depth option"),
    (10_000_000, "Rotation-level asset"),
    (30_000_000, "First-team starter profile"),
    (70_000_000, "High-value starter"),
]
VALUATION_TOP_BAND = "Elite market asset"
CONFIDENCE_NOTES = {
    "low": "Signal is relatively stable for this profile; use as a strong benchmark.",
    "medium": "Signal is directionally useful, but pair with contract and scouting context.",
    "high": "Treat this as a broad range estimate and rely on additional scouting evidence.",
}


def valuation_band(value: ColumnOrName) -> Column:
    """Market tier of a predicted value (H7)."""
    v = _c(value)
    expr = None
    for bound, label in VALUATION_BANDS:
        expr = F.when(v < bound, F.lit(label)) if expr is None else expr.when(v < bound, F.lit(label))
    return expr.otherwise(F.lit(VALUATION_TOP_BAND))


def uncertainty_level(value: ColumnOrName, lower: ColumnOrName, upper: ColumnOrName) -> Column:
    """Relative interval width: < 1.5 low, < 3 medium, else high; value <= 0 → high (H8)."""
    v = _c(value)
    width = F.try_divide(_c(upper) - _c(lower), v)
    return (
        F.when(v <= 0, F.lit("high"))
        .when(width < 1.5, F.lit("low"))
        .when(width < 3.0, F.lit("medium"))
        .otherwise(F.lit("high"))
    )


def confidence_note(level: ColumnOrName) -> Column:
    lv = _c(level)
    expr = None
    for key, note in CONFIDENCE_NOTES.items():
        expr = F.when(lv == key, F.lit(note)) if expr is None else expr.when(lv == key, F.lit(note))
    return expr


def _fixed(x: Column, decimals: int) -> Column:
    # format_number with a pattern rounds HALF_EVEN on the exact binary value
    # and adds no grouping separators, like Python's f"{x:.2f}".
    pattern = "0" if decimals == 0 else "0." + "0" * decimals
    return F.call_function("format_number", x, F.lit(pattern))


def format_eur(value: ColumnOrName, by_magnitude: bool = True) -> Column:
    """Compact money text: B / M / K / plain.

    ``by_magnitude=True`` scales on |value| (report style); False compares the
    signed value (scoring summary style)."""
    v = _c(value).cast("double")
    m = F.abs(v) if by_magnitude else v
    return (
        F.when(m >= 1e9, F.concat(F.lit("EUR "), _fixed(v / 1e9, 2), F.lit("B")))
        .when(m >= 1e6, F.concat(F.lit("EUR "), _fixed(v / 1e6, 2), F.lit("M")))
        .when(m >= 1e3, F.concat(F.lit("EUR "), _fixed(v / 1e3, 0), F.lit("K")))
        .otherwise(F.concat(F.lit("EUR "), _fixed(v, 0)))
    )


def format_pct(value: ColumnOrName) -> Column:
    """Proportion → "12.3%" (H10)."""
    return F.concat(_fixed(_c(value).cast("double") * 100.0, 1), F.lit("%"))


def bias_direction(mean_signed_err: ColumnOrName, mae: ColumnOrName,
                   rel: float = 0.10, floor_abs: float = 50_000.0) -> Column:
    """Threshold max(rel·MAE, floor): under / over / roughly_unbiased."""
    thr = F.greatest(_c(mae) * rel, F.lit(floor_abs))
    s = _c(mean_signed_err)
    return (
        F.when(s <= -thr, F.lit("underprediction"))
        .when(s >= thr, F.lit("overprediction"))
        .otherwise(F.lit("roughly_unbiased"))
    )
