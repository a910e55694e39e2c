"""Exact running totals, ranks and quantiles within keys.

A plain ordered window sends all rows of a key to one task. A caller who knows that keys can be large
passes `width`: the order column is then cut into pieces of that width, rows are totalled per (key,
piece), the totals are accumulated, and the ordered window runs inside each (key, piece). The pieces
depend on the values and the width alone, never on how many rows there are, and nothing is run or
written while the plan is built. Floating amounts are summed as decimals with six places, so that the
results are the same to the last bit for any width and any order of execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equal keys where null equals null."""
    right = b.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys])
    return a.join(right, on, how).drop(*[f"_on_{k}" for k in keys])


def _exact(df: DataFrame, amount: str) -> Column:
    floating = df.schema[amount].dataType.simpleString() in ("double", "float")
    return F.col(amount).cast("decimal(38,6)") if floating else F.col(amount)


def running_total(df: DataFrame, keys: Sequence[str], order: str, amount: str, out: str, width: float | None = None) -> DataFrame:
    """Adds `out`: sum of `amount` over rows of the key up to and including this `order` value.

    `order` must be numeric, not null and unique per key (aggregate first if it is not).
    """
    exact = _exact(df, amount)
    kind = "double" if df.schema[amount].dataType.simpleString() in ("double", "float") else "bigint"
    tagged = df if width is None else df.withColumn("_piece", F.floor(F.col(order) / F.lit(width)))
    parts = list(keys) if width is None else [*keys, "_piece"]
    within = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.sum(exact).over(within), F.lit(0))
    if width is None:
        return tagged.withColumn(out, total.cast(kind))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    base = tagged.groupBy(*parts).agg(F.sum(exact).alias("_sum")).withColumn("_base", F.sum("_sum").over(before)).drop("_sum")
    running = tagged.withColumn("_own", total)
    return join_same(running, base, parts).withColumn(
        out, (F.coalesce(F.col("_base"), F.lit(0)) + F.col("_own")).cast(kind)).drop("_base", "_own", "_piece")


def _counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))


def value_counts(df: DataFrame, keys: Sequence[str], value: str, width: float | None = None) -> DataFrame:
    """(keys, value, _n, _upto): distinct non-null values with their count and running count."""
    return running_total(_counts(df, keys, value), keys, value, "_n", "_upto", width)


def average_rank(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank", width: float | None = None) -> DataFrame:
    """Ascending rank of `value` within keys, ties averaged; missing values have no rank."""
    ranks = value_counts(df, keys, value, width).select(
        *keys, value, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(out))
    return join_same(df, ranks, [*keys, value], "left")


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5, out: str = "median", width: float | None = None) -> DataFrame:
    """Quantile per key with linear interpolation between order statistics, one row per key."""
    return exact_quantiles(df, keys, value, {out: q}, width)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float], width: float | None = None) -> DataFrame:
    """Several quantiles of one value (output name to fraction) from one ordering."""
    counted = value_counts(df, keys, value, width)
    if width is None:
        placed = counted.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    else:
        placed = join_same(counted, _counts(df, keys, value).groupBy(*keys).agg(F.sum("_n").alias("_total")), keys)
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    marks = {name: (F.col("_total") - 1) * F.lit(q) for name, q in wanted.items()}
    low = {n: F.floor(m).between(first, last) for n, m in marks.items()}
    high = {n: F.ceil(m).between(first, last) for n, m in marks.items()}
    near = reduce(lambda x, y: x | y, [*low.values(), *high.values()])
    v = F.col(value).cast("double")
    picks = [x for n, m in marks.items() for x in (
        F.max(F.when(low[n], v)).alias(f"_a_{n}"), F.max(F.when(high[n], v)).alias(f"_b_{n}"), F.max(m - F.floor(m)).alias(f"_f_{n}"))]
    return placed.filter(near).groupBy(*keys).agg(*picks).select(*keys, *[
        (F.col(f"_a_{n}") + (F.col(f"_b_{n}") - F.col(f"_a_{n}")) * F.col(f"_f_{n}")).alias(n) for n in wanted])
