"""Short linear forecasts of cumulative series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.sources.stage import settle

RATE_DAYS = 14


def _last_and_rate(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """(keys, _t0, _v0, _rate): last valid value and the mean daily gain over the 14 days before it.

    Two aggregations over the panel; the value 14 days earlier is found by an equi-join.
    """
    last = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(date).alias("_t0"), F.max_by(value, date).alias("_v0"))
    before = df.select(*keys, F.date_add(date, RATE_DAYS).alias("_t0"), F.col(value).alias("_vb"))
    return last.join(before, [*keys, "_t0"], "left").withColumn("_rate", (F.col("_v0") - F.col("_vb")) / RATE_DAYS).drop("_vb")


def extrapolate(df: DataFrame, keys: Sequence[str], value: str, ahead: int = 90, date: str = "date",
                out: str = "pred") -> DataFrame:
    """From the last day on: last value plus one day's gain, then one more per day, `ahead` days far."""
    return _extrapolate(settle(df.select(*keys, date, value), "series"), keys, value, ahead, date, out)


def _extrapolate(df: DataFrame, keys: Sequence[str], value: str, ahead: int, date: str, out: str) -> DataFrame:
    base = _last_and_rate(df, keys, date, value)
    days = base.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(ahead))))
    return days.select(*keys, F.date_add("_t0", F.col("_i")).alias(date), F.col("_i").alias("step"),
                       (F.col("_v0") + (F.col("_i") + 1) * F.col("_rate")).alias(out))


def follow_up(df: DataFrame, keys: Sequence[str], first: str, second: str, ahead: int = 90, lag: int = 40,
              date: str = "date", out: str = "pred") -> DataFrame:
    """Both series: the second repeats the first one `lag` days later, starting from its own last value."""
    df = settle(df.select(*keys, date, first, second), "series")
    future = _extrapolate(df, keys, first, ahead, date, f"{first}_{out}")
    # The first series continued into its forecast, moved `lag` days on.
    t0 = df.filter(F.col(first).isNotNull()).groupBy(*keys).agg(F.max(date).alias("_t0"))
    last_second = df.filter(F.col(second).isNotNull()).join(t0, list(keys)).filter(F.col(date) <= F.col("_t0")).groupBy(*keys).agg(
        F.max_by(second, date).alias("_s0"))
    past = df.join(t0, list(keys)).filter((F.col(date) >= F.date_sub("_t0", lag)) & (F.col(date) <= F.col("_t0"))).select(
        *keys, F.date_add(date, lag).alias(date), F.col(first).alias("_shifted"))
    ahead_part = future.filter("step >= 1").select(*keys, F.date_add(date, lag).alias(date), F.col(f"{first}_{out}").alias("_shifted"))
    shifted = past.unionByName(ahead_part)
    start = past.join(t0, list(keys)).filter(F.col(date) == F.col("_t0")).select(*keys, F.col("_shifted").alias("_base"))
    joined = future.join(shifted, [*keys, date], "left").join(start, list(keys), "left").join(last_second, list(keys), "left")
    return joined.select(*keys, date, "step", f"{first}_{out}",
                         (F.col("_shifted") - F.col("_base") + F.col("_s0")).alias(f"{second}_{out}"))


def cap(value: str | Column, current: str | Column, limit: float) -> Column:
    """A forecast stops at the limit, or at the present value where that is already above it."""
    v = F.col(value) if isinstance(value, str) else value
    now = F.col(current) if isinstance(current, str) else current
    return F.when(v.isNotNull(), F.least(v, F.greatest(now, F.lit(float(limit)))))


def required_rate(goal: str | Column, current: str | Column, today: str | Column, target: str) -> Column:
    """Daily gain needed to reach the goal on the target date."""
    g, c, d = (F.col(x) if isinstance(x, str) else x for x in (goal, current, today))
    return F.try_divide(g - c, F.datediff(F.lit(target).cast("date"), d).cast("double"))
