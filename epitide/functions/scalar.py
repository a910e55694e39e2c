"""Row-level column expressions: cleaning, classification, null-aware arithmetic, formatting."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- cleaning -------------------------------------------------------------------------------

def clean_number(c: str | Column, dash_as_zero: bool = True) -> Column:
    """'1,234' -> 1234.0, '%null%' and unparsable text -> null, '-' -> 0."""
    text = F.trim(_c(c))
    parsed = F.regexp_replace(text, ",", "").try_cast("double")
    parsed = F.when(~F.isnan(parsed), parsed)
    if dash_as_zero:
        parsed = F.when(text == "-", F.lit(0.0)).otherwise(parsed)
    return F.when(~text.contains("%null%"), parsed)


def null_if(c: str | Column, *sentinels) -> Column:
    col = _c(c)
    return F.when(~col.isin(*sentinels), col)


def finite(c: str | Column) -> Column:
    """Infinite and NaN ratios become missing."""
    col = _c(c)
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def strip_prefixes(c: str | Column, *prefixes: str) -> Column:
    """Each prefix is removed once, in the given order."""
    out = _c(c)
    for p in prefixes:
        out = F.regexp_replace(out, "^" + re.escape(p), "")
    return out


def strip_suffixes(c: str | Column, *suffixes: str) -> Column:
    out = _c(c)
    for s in suffixes:
        if s:
            out = F.regexp_replace(out, re.escape(s) + "$", "")
    return out


# ---- classification -------------------------------------------------------------------------

def first_match(c: str | Column, rules: Sequence[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """Label of the first rule whose (case-insensitive) pattern is found; else the text itself."""
    col = _c(c)
    out = None
    for pattern, label in rules:
        hit = col.rlike("(?i)" + pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(col if otherwise is None else otherwise)


def prefix_group(c: str | Column, groups: Sequence[tuple[str, str]], other: str = "Other") -> Column:
    """Label by upper-case prefix; where several prefixes fit, the rule listed last wins."""
    col = F.upper(_c(c))
    out = None
    for prefix, label in reversed(list(groups)):
        hit = col.startswith(prefix)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(other))


def any_in(c: str | Column, *needles: str, regex: bool = False) -> Column:
    col = _c(c)
    tests = [col.rlike(n) if regex else col.contains(n) for n in needles]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def all_in(c: str | Column, *needles: str, regex: bool = False) -> Column:
    col = _c(c)
    tests = [col.rlike(n) if regex else col.contains(n) for n in needles]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def relabel(c: str | Column, replacements: Sequence[tuple[str, str]]) -> Column:
    """Chain of regex replacements ($1 refers to the first group)."""
    out = _c(c)
    for pattern, replacement in replacements:
        out = F.regexp_replace(out, pattern, replacement)
    return out


# ---- arithmetic -----------------------------------------------------------------------------

def ratio(num: str | Column, den: str | Column, scale: float = 1.0) -> Column:
    """num / den * scale; null where the denominator is zero."""
    out = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return out if scale == 1.0 else out * F.lit(float(scale))


def clip(c: str | Column, lower: float | Column | None = None, upper: float | Column | None = None) -> Column:
    col = out = _c(c)
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(col.isNotNull(), out)


def subtract(a: str | Column, b: str | Column, fill: float | None = None) -> Column:
    """a - b. With `fill`, one missing side counts as `fill`; both missing stays missing."""
    a, b = _c(a), _c(b)
    if fill is None:
        return a - b
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(fill)) - F.coalesce(b, F.lit(fill)))


def add(a: str | Column, b: str | Column, fill: float | None = None) -> Column:
    a, b = _c(a), _c(b)
    if fill is None:
        return a + b
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(fill)) + F.coalesce(b, F.lit(fill)))


def row_sum(columns: Sequence[str | Column], mode: str = "skip") -> Column:
    """Row-wise sum. skip: nulls count 0; strict: any null gives null; min1: null only if all are."""
    cs = [_c(c).cast("double") for c in columns]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs[1:]), F.coalesce(cs[0], F.lit(0.0)))
    if mode == "skip":
        return total
    if mode == "strict":
        return sum(cs[1:], cs[0])
    if mode == "min1":
        return F.when(F.coalesce(*cs).isNotNull(), total)
    raise ValueError(mode)


def row_count(columns: Sequence[str | Column]) -> Column:
    parts = [_c(c).isNotNull().cast("int") for c in columns]
    return sum(parts[1:], parts[0])


def row_mean(columns: Sequence[str | Column]) -> Column:
    return F.try_divide(row_sum(columns), row_count(columns))


def front(columns: Sequence[str], *to_move: str, first: bool = True) -> list[str]:
    """Column order with the named columns at the front (or back); unknown names are ignored."""
    moved = [c for c in to_move if c in columns]
    rest = [c for c in columns if c not in moved]
    return moved + rest if first else rest + moved


# ---- formatting -----------------------------------------------------------------------------

# Magnitude suffixes and trend arrows in output order.
SUFFIXES = ["", "k", "M", "G", "T", "P"]
ARROWS = ["→", "↗", "↑", "↓", "↘"]


def _decimals(c: Column, places: int) -> Column:
    text = F.format_string(f"%.{places}f", F.bround(c, places))
    return text if places == 0 else F.regexp_replace(text, r"\.?0+$", "")


def sensible_precision(c: str | Column) -> Column:
    """At most three significant digits, trailing zeros trimmed; missing becomes ''."""
    col = _c(c).cast("double")
    size = F.abs(col)
    return (
        F.when(col.isNull() | F.isnan(col), F.lit(""))
        .when(size < 10, _decimals(col, 2))
        .when(size < 100, _decimals(col, 1))
        .when(size == float("inf"), F.lit("INF"))
        .otherwise(_decimals(col, 0))
    )


def human_format(c: str | Column) -> Column:
    """1234567 -> '1.23M'."""
    col = _c(c).cast("double")
    power = sum(((F.abs(col) >= 1000.0 ** k).cast("int") for k in range(2, len(SUFFIXES))),
                (F.abs(col) >= 1000.0).cast("int"))
    scaled = F.when(power == 0, col)
    suffix = F.when(power == 0, F.lit(SUFFIXES[0]))
    for k in range(1, len(SUFFIXES)):
        scaled = scaled.when(power == k, col / F.lit(1000.0 ** k))
        suffix = suffix.when(power == k, F.lit(SUFFIXES[k]))
    return F.concat(sensible_precision(scaled), F.coalesce(suffix, F.lit("")))


def percent_format(c: str | Column) -> Column:
    return F.concat(sensible_precision(c), F.lit("%"))


def population_format(c: str | Column, population: str | Column) -> Column:
    """'12.3%\\n8.5M': share of the population above the count in millions."""
    col = _c(c).cast("double")
    millions = sensible_precision(col / 1e6)
    share = sensible_precision(ratio(col, population, 100))
    return F.when(millions == "0", F.lit("0%")).otherwise(
        F.concat(share, F.lit("%\n"), millions, F.lit("M")))


def trend_arrow(trend: str | Column) -> Column:
    """Arrow for a trend in [-1, 1] (clipped, rounded half-even in half steps); '?' if missing."""
    col = _c(trend).cast("double")
    step = F.bround(clip(col, -1.0, 1.0) * 2, 0).cast("int")
    arrows = F.array(*[F.lit(a) for a in ARROWS])
    return F.when(col.isNull() | F.isnan(col), F.lit("?")).otherwise(
        F.try_element_at(arrows, F.when(step >= 0, step + 1).otherwise(step)))
