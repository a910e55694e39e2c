"""Quantiles from mergeable sketches: the facts are read once, and any span of days is merged from stored sketches.

A KLL sketch holds about K values of a group whatever its size, and two of them merge into one of the same quality. So a
table of one sketch per key and day serves every later question about months, moving windows or all time, where an exact
quantile would sort the facts again. The rank of an answer is off by about 1.7 / K^0.9 of the rows at most; groups of up
to K rows are exact. Use `ordered.exact_quantiles` where that is not enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400


def day_sketches(df: DataFrame, keys: Sequence[str], date: str, value: str, k: int = K) -> DataFrame:
    """(keys, date, sketch, n): one row per key and day with any value; nulls and NaN are left out."""
    number = F.col(value).cast("double")
    seen = df.filter(number.isNotNull() & ~F.isnan(number))
    return seen.groupBy(*keys, date).agg(F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"), F.count("*").alias("n"))


def merged(sketches: DataFrame, by: Sequence[str | Column], wanted: Mapping[str, float]) -> DataFrame:
    """(by, n, <name>...): quantiles of all sketches of a group, from 0 to 1."""
    whole = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_sketch"), F.sum("n").alias("n"))
    return whole.withColumns({name: F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q))) for name, q in wanted.items()}).drop("_sketch")


def moving(sketches: DataFrame, keys: Sequence[str], date: str, days: int, wanted: Mapping[str, float]) -> DataFrame:
    """(keys, date, n, <name>...) for every day there is a sketch of: quantiles of the `days` days that end with it.

    A sketch is small, so it is sent to each of the windows it is part of; windows of days without a sketch are not made.
    """
    ends = sketches.select(*keys, date, F.lit(True).alias("_is"))
    sent = sketches.select(*keys, F.explode(F.sequence(F.col(date), F.date_add(date, days - 1))).alias(date), "sketch", "n")
    return merged(sent.join(ends, [*keys, date]).drop("_is"), [*keys, date], wanted)
