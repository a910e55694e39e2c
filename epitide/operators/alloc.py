"""Shares, allocations and residuals within a date.

Totals per date are aggregated (combining on the map side) and joined back, instead of a window per
date, so a date with very many rows is not gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_total(df: DataFrame, by: Sequence[str], value: str, out: str = "_total", where: Column | None = None) -> DataFrame:
    totals = (df if where is None else df.filter(where)).groupBy(*by).agg(F.sum(value).alias(out))
    return df.join(totals, list(by), "left")


def normalise(df: DataFrame, by: Sequence[str], value: str, total: str | Column, out: str) -> DataFrame:
    """Scale components so that they add up to the reported total."""
    reported = F.col(total) if isinstance(total, str) else total
    return with_total(df, by, value).withColumn(
        out, F.try_divide(F.col(value).cast("double"), F.col("_total")) * reported).drop("_total")


def percent_of_total(df: DataFrame, by: Sequence[str], value: str, out: str, where: Column | None = None) -> DataFrame:
    """Component share of the row total, times 100; rows outside `where` show 0."""
    share = F.try_divide(F.col(value).cast("double"), F.col("_total")) * 100
    return with_total(df, by, value, where=where).withColumn(
        out, share if where is None else F.when(where, share).otherwise(0.0)).drop("_total")


def allocate(df: DataFrame, national: DataFrame, by: Sequence[str], value: str, total: str, out: str) -> DataFrame:
    """Area share times the national total."""
    return normalise(df.join(national.select(*by, total), list(by), "left"), by, value, total, out)


def rescale_rate(df: DataFrame, by: Sequence[str], num: str, den: str, national_rate: str, out: str) -> DataFrame:
    """Area rates scaled so that the pooled rate of the areas equals the national rate."""
    pooled = df.groupBy(*by).agg(F.sum(num).alias("_n"), F.sum(den).alias("_d"))
    rate = F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))
    pool = F.try_divide(F.col("_n").cast("double"), F.col("_d").cast("double"))
    return df.join(pooled, list(by)).withColumn(out, rate * F.try_divide(F.col(national_rate), pool)).drop("_n", "_d")


def unknown_residual(df: DataFrame, by: Sequence[str], value: str, totals: DataFrame, total: str, out: str) -> DataFrame:
    """Reported total minus the known parts, never below zero; a missing total gives missing."""
    known = df.groupBy(*by).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_known"))
    gap = F.col(total) - F.coalesce(F.col("_known"), F.lit(0))
    return totals.join(known, list(by), "left").withColumn(
        out, F.when(gap.isNotNull(), F.greatest(gap, F.lit(0)))).drop("_known")


def stacked(df: DataFrame, by: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Running sum over the categories of a date: the upper edge of each band of a stack."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.coalesce(F.col(value), F.lit(0))).over(w))


def redistribute(df: DataFrame, by: Sequence[str], value: str, undated: DataFrame, amount: str, cutoff: Column, out: str) -> DataFrame:
    """Spread amounts without a date over the dated rows before a cut-off, in proportion to them."""
    totals = df.filter(cutoff).groupBy(*by).agg(F.sum(value).alias("_total"))
    joined = df.join(totals, list(by), "left").join(undated.select(*by, amount), list(by), "left")
    extra = F.try_divide(F.col(value).cast("double"), F.col("_total")) * F.col(amount)
    return joined.withColumn(out, F.col(value) + F.when(cutoff, F.coalesce(extra, F.lit(0.0))).otherwise(0.0)).drop("_total", amount)
