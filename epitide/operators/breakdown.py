"""Counts of one fact by several dimensions at once, in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.operators import repair, windows
from epitide.operators.ordered import join_same

UNKNOWN = "Unknown"


def breakdowns(df: DataFrame, date: str, dimensions: Mapping[str, Column], amount: Column | None = None) -> DataFrame:
    """(dimension, category, date, n): one scan and one aggregation, however many dimensions are asked for.

    A category that is null is counted as Unknown, so that the categories of a dimension add up to the whole.
    """
    names = list(dimensions)
    columns = [f"_d{i}" for i in range(len(names))]
    rows = df.select(F.col(date), *[F.coalesce(c.cast("string"), F.lit(UNKNOWN)).alias(x) for x, c in zip(columns, dimensions.values())],
                     (F.lit(1) if amount is None else amount).alias("_a"))
    counted = rows.groupingSets([[F.col(c), F.col(date)] for c in columns], *columns, date).agg(F.sum("_a").alias("n"))
    # A set's own column is never null, and the columns of the other sets always are.
    name = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(n)) for c, n in zip(columns, names)])
    return counted.select(name.alias("dimension"), F.coalesce(*columns).alias("category"), date, "n")


def lumped(counts: DataFrame, most: Mapping[str, int], other: str = "Others", leave_out: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The `most` frequent categories of the named dimensions, the rest of them as `other`; some may be left out first.

    Ties go to the lesser name. Ranks are taken over one row per category.
    """
    for dimension, names in (leave_out or {}).items():
        counts = counts.filter((F.col("dimension") != dimension) | ~F.col("category").isin(*names))
    totals = counts.filter(F.col("dimension").isin(*most)).groupBy("dimension", "category").agg(F.sum("n").alias("_n"))
    rank = F.row_number().over(Window.partitionBy("dimension").orderBy(F.col("_n").desc(), "category"))
    limit = F.coalesce(*[F.when(F.col("dimension") == d, k) for d, k in most.items()])
    kept = totals.withColumn("_rank", rank).filter(F.col("_rank") <= limit).select("dimension", "category", F.lit(True).alias("_kept"))
    named = counts.join(kept, ["dimension", "category"], "left")
    category = F.when(F.col("_kept") | ~F.col("dimension").isin(*most), F.col("category")).otherwise(F.lit(other))
    keys = [c for c in counts.columns if c not in ("n", "category")]
    return named.groupBy(*keys, category.alias("category")).agg(F.sum("n").alias("n"))


def shares_over_time(counts: DataFrame, date: str, n: int = 7, min_periods: int = 3) -> DataFrame:
    """Every category on every date (zero where nothing was seen), its centred mean, and that as percent of its dimension."""
    full = repair.densify_grid(counts.select("dimension", "category", date, "n"), ["dimension", "category"], date, 0)
    smooth = windows.moving_average(full, ["dimension", "category"], date, "n", n, min_periods, True, "_ma")
    whole = smooth.groupBy("dimension", date).agg(F.sum("n_ma").alias("_whole"))
    joined = join_same(smooth, whole, ["dimension", date])
    return joined.withColumn("share", F.try_divide(F.col("n_ma"), F.col("_whole")) * 100).drop("_whole")
