"""Rolling and trend operators on panels that are unique per (keys, date)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.model import cols, day_number
from epitide.operators.ordered import average_rank


def _asc(keys, date):
    return Window.partitionBy(*keys).orderBy(date)


def frame(keys: Sequence[str], date: str, n: int, center: bool = False):
    """n-row frame: trailing, or centred (an even n takes one row more before than after)."""
    if center:
        return _asc(keys, date).rowsBetween(-(n // 2), (n - 1) // 2)
    return _asc(keys, date).rowsBetween(-(n - 1), 0)


def rolling(value: str | Column, window, min_periods: int, how=F.avg) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(v).over(window) >= min_periods, how(v).over(window))


def moving_average(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value",
                   n: int = 7, min_periods: int | None = None, center: bool = False, suffix: str = "_ma") -> DataFrame:
    """Row-based moving average. min_periods defaults to the whole window."""
    w = frame(keys, date, n, center)
    need = n if min_periods is None else min_periods
    return df.withColumns({v + suffix: rolling(v, w, need) for v in cols(values)})


def calendar_rolling(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value", days: int = 7,
                     shift: int = 0) -> DataFrame:
    """Mean, median, min and max of the last `days` calendar days; `shift` rows brought back."""
    w = Window.partitionBy(*keys).orderBy(day_number(date)).rangeBetween(-(days - 1), 0)
    stats = {
        f"{value}_mean": F.avg(value).over(w), f"{value}_median": F.percentile(value, F.lit(0.5)).over(w),
        f"{value}_min": F.min(value).over(w), f"{value}_max": F.max(value).over(w),
    }
    out = df.withColumns(stats)
    if shift:
        ahead = _asc(keys, date)
        out = out.withColumns({c: F.lead(c, shift).over(ahead) for c in stats})
    return out


def change_ratio(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value", n: int = 14,
                 out: str = "change") -> DataFrame:
    """Percent change of the n-row mean against the mean n rows earlier."""
    smooth = moving_average(df, keys, date, value, n, suffix="_avg")
    before = F.lag(f"{value}_avg", n).over(_asc(keys, date))
    return smooth.withColumn(out, F.try_divide(F.col(f"{value}_avg") - before, before) * 100)


def half_slope(value: str, keys: Sequence[str], date: str, n: int = 7) -> Column:
    """(middle value - first value) / length of the centred window actually available.

    The collected list holds at most n values.
    """
    w = frame(keys, date, n, center=True)
    items = F.collect_list(F.struct(F.col(value).alias("v"))).over(w)
    size = F.size(items)
    middle = F.try_element_at(items, F.ceil(size / 2).cast("int") + 1)["v"]
    return F.when(F.count(value).over(w) >= n // 2, (middle - F.element_at(items, 1)["v"]) / size)


def increasing(value: str, n: int = 7):
    """Metric for top-n reports: how fast a series rises."""
    return lambda keys, date: half_slope(value, keys, date, n)


def decreasing(value: str, n: int = 7):
    return lambda keys, date: F.try_divide(F.lit(1.0), half_slope(value, keys, date, n))


def smoothed(value: str, n: int = 3):
    """Metric for top-n reports: trailing mean over up to n rows."""
    return lambda keys, date: F.avg(value).over(frame(keys, date, n)) if n else F.col(value)


def fitted_slope(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value", n: int = 7,
                 out: str = "slope") -> DataFrame:
    """Least-squares slope per row over full trailing windows of n rows."""
    numbered = df.withColumn("_rn", F.row_number().over(_asc(keys, date)).cast("double"))
    w = frame(keys, date, n)
    return numbered.withColumn(
        out, F.when(F.count(value).over(w) >= n, F.regr_slope(F.col(value), F.col("_rn")).over(w))).drop("_rn")


def running_from(df: DataFrame, keys: Sequence[str], date: str, values: str | Sequence[str], anchor: Date | str,
                 suffix: str = "_cum") -> DataFrame:
    """Running sums of each wave: only rows from the anchor date on."""
    w = _asc(keys, date).rowsBetween(Window.unboundedPreceding, 0)
    later = df.filter(F.col(date) >= F.lit(anchor).cast("date"))
    return later.withColumns({v + suffix: F.sum(v).over(w) for v in cols(values)})


def percent_of_peak(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value", n: int = 7,
                    out: str = "of_peak") -> DataFrame:
    """Value as percent of the highest n-row mean of the same series."""
    smooth = moving_average(df, keys, date, value, n, suffix="_peak")
    peak = F.max(f"{value}_peak").over(Window.partitionBy(*keys))
    return smooth.withColumn(out, F.try_divide(F.col(value), peak) * 100).drop(f"{value}_peak")


def rank_change(df: DataFrame, entity: str, date: str, value: str, shift: int, width: float | None = None) -> DataFrame:
    """Rank among entities per date (ties averaged) and its change against `shift` rows earlier.

    `width` splits the values of a date, as in `ordered.running_total`, where a date has very many entities.
    """
    ranked = average_rank(df, [date], value, "rank", width)
    return ranked.withColumn("rank_change", F.col("rank") - F.lag("rank", shift).over(_asc([entity], date)))


def trend_lag(n: int, style: str) -> int:
    return ceil(n / 2) if style == "rank" else n // 2
