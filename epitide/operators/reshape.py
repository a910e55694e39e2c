"""Aggregation and reshaping: crosstabs, banding, roll-ups, top-k lumping, period slices.

Grouped sums and counts combine on the map side, so hot groups do not matter. Pivots are given their
column list (from a dimension or a parameter), which avoids a separate pass and fixes the schema.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.model import cols
from epitide.operators.ordered import exact_quantile

# ---- slices ---------------------------------------------------------------------------------


def _day(d):
    return F.lit(d).cast("date")


def named_periods(df: DataFrame, date: str, periods: Mapping[str, tuple[str | None, str | None]]) -> DataFrame:
    """One copy of each row per named period (start, end; either may be open) it falls in."""
    labels = F.array(*[
        F.when(
            (F.col(date) >= _day(lo) if lo else F.lit(True)) & (F.col(date) <= _day(hi) if hi else F.lit(True)),
            F.lit(name))
        for name, (lo, hi) in periods.items()
    ])
    return df.withColumn("period", F.explode(F.array_compact(labels)))


def last_rows(df: DataFrame, date: str, n: int) -> DataFrame:
    """The n latest rows (top-n per task first, then overall)."""
    return df.orderBy(F.col(date).desc()).limit(n)


def enough_samples(df: DataFrame, counts: DataFrame, date: str, size: str, minimum: float) -> DataFrame:
    """Rows on dates whose total sample size reaches the minimum."""
    big = counts.groupBy(date).agg(F.sum(size).alias("_size")).filter(F.col("_size") >= minimum).select(date)
    return df.join(big, date, "left_semi")


def inverted_rescale(df: DataFrame, value: str, out: str) -> DataFrame:
    """100 at the series minimum, 0 at its maximum; the two bounds are one aggregated row."""
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    with_bounds = df.withColumn("_b", bounds)
    share = F.try_divide(F.col("_b.lo") - F.col(value), F.col("_b.hi") - F.col("_b.lo"))
    return with_bounds.withColumn(out, (1 + share) * 100).drop("_b")


def family_rate(df: DataFrame, by: Sequence[str], members: Sequence[str], num: str, den: str, out: str) -> DataFrame:
    """Summed numerator over summed denominator per member, then the mean of the members, times 100."""
    per = df.groupBy(*by, *members).agg(F.sum(num).alias("_n"), F.sum(den).alias("_d"))
    return per.groupBy(*by).agg((F.avg(F.try_divide(F.col("_n").cast("double"), F.col("_d").cast("double"))) * 100).alias(out))


# ---- grouping -------------------------------------------------------------------------------

def group_stats(df: DataFrame, keys: Sequence[str], value: str, order: str, width: float | None = None) -> DataFrame:
    """sum, count, min, max, mean, last and exact median per key; `width` splits the values of long keys for the median."""
    basic = df.groupBy(*keys).agg(
        F.sum(value).alias("sum"), F.count(value).alias("count"), F.min(value).alias("min"),
        F.max(value).alias("max"), F.avg(value).alias("mean"),
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("last"))
    return basic.join(exact_quantile(df, keys, value, width=width), list(keys), "left")


def count_crosstab(df: DataFrame, index: Sequence[str], category: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Counts per index and category, zero where nothing was seen; rows with a null key are left out."""
    clean = df.dropna(subset=[*index, category])
    out = clean.groupBy(*index).pivot(category, list(values)).count().fillna(0)
    return out.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def value_crosstab(df: DataFrame, index: Sequence[str], category: str, values: Sequence, value: str,
                   how: str = "sum", prefix: str = "", suffix: str = "") -> DataFrame:
    """Aggregated values per index and category; missing cells stay missing."""
    clean = df.dropna(subset=[*index, category])
    agg = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}[how]
    out = clean.groupBy(*index).pivot(category, list(values)).agg(agg(value))
    return out.withColumnsRenamed({str(v): f"{prefix}{v}{suffix}" for v in values})


def wide(df: DataFrame, index: Sequence[str], category: str, values: Sequence, measures: Sequence[str]) -> DataFrame:
    """Several measures per category: columns '<measure> <category>'; absent categories give nulls."""
    aggs = [F.sum(m).alias(m) for m in measures]
    out = df.groupBy(*index).pivot(category, list(values)).agg(*aggs)
    if len(measures) == 1:
        return out.withColumnsRenamed({str(v): f"{measures[0]} {v}" for v in values})
    return out.withColumnsRenamed({f"{v}_{m}": f"{m} {v}" for v in values for m in measures})


# ---- banding --------------------------------------------------------------------------------

UPPER_BOUND = 140


def band_labels(edges: Sequence[int]) -> list[str]:
    starts = [0, *edges]
    ends = [*edges, None]
    return [f"{a}-{b - 1}" if b is not None else f"{a}+" for a, b in zip(starts, ends)]


def band(value: str | Column, edges: Sequence[int], upper: int = UPPER_BOUND) -> Column:
    """Left-closed numeric bands '0-9', '10-19', ..., '70+'; outside [0, upper) is null."""
    v = F.col(value) if isinstance(value, str) else value
    out = None
    for label, hi in zip(band_labels(edges), [*edges, upper]):
        hit = (v >= 0) & (v < hi)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def two_bandings(df: DataFrame, index: Sequence[str], value: str, first: Sequence[int], second: Sequence[int],
                 prefixes: tuple[str, str]) -> DataFrame:
    """Counts of one fact under two bandings, in a single scan and a single aggregation."""
    a, b = band(value, first), band(value, second)
    tests = [(prefixes[0] + x, a == x) for x in band_labels(first)] + [(prefixes[1] + x, b == x) for x in band_labels(second)]
    return df.groupBy(*index).agg(*[F.count(F.when(cond, 1)).alias(name) for name, cond in tests])


def regroup_bands(df: DataFrame, keys: Sequence[str], band_col: str, value: str, mapping: DataFrame) -> DataFrame:
    """Add fine bands up to coarse ones (`mapping`: old band, new band); bands already present win."""
    summed = (
        df.join(mapping.select(F.col("old").alias(band_col), "new"), band_col)
        .groupBy(*keys, F.col("new").alias(band_col)).agg(F.sum(value).alias(value)).withColumn("_p", F.lit(1)))
    both = df.select(*keys, band_col, value).withColumn("_p", F.lit(0)).unionByName(summed)
    return both.groupBy(*keys, band_col).agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col("_p"))).alias(value))


# ---- hierarchy and categories -----------------------------------------------------------------

def roll_up(df: DataFrame, date: str, levels: Sequence[str], values: str | Sequence[str]) -> DataFrame:
    """Sums per date at every level of a hierarchy (finest last) and in total; all-null stays null.

    One grouping-sets aggregation; `level` is the number of hierarchy columns in the row's key.
    """
    sets = [[F.col(date), *[F.col(c) for c in levels[:i]]] for i in range(len(levels) + 1)]
    depth = F.lit(len(levels))
    for c in levels:
        depth = depth - F.grouping(c)
    return df.groupingSets(sets, F.col(date), *[F.col(c) for c in levels]).agg(
        *[F.sum(v).alias(v) for v in cols(values)], depth.cast("int").alias("level"))


def top_categories(df: DataFrame, category: str, k: int, exclude: Sequence[str] = ()) -> DataFrame:
    """The k most frequent categories, ties by name; excluded ones are not considered."""
    return (
        df.filter(F.col(category).isNotNull() & ~F.col(category).isin(*exclude)).groupBy(category).count()
        .orderBy(F.col("count").desc(), category).limit(k).select(category, F.lit(True).alias("_top")))


def lump_others(df: DataFrame, index: Sequence[str], category: str, k: int, keep: Sequence[str] = (),
                ignore: Sequence[str] = (), other: str = "Others") -> DataFrame:
    """Counts by category with all but the top k lumped as `other`.

    `keep` categories are left out of the report, `ignore` ones out of the top k but counted as other.
    """
    top = top_categories(df, category, k, [*keep, *ignore])
    named = df.filter(F.col(category).isNotNull() & ~F.col(category).isin(*keep)).join(top, category, "left")
    label = F.when(F.col("_top"), F.col(category)).otherwise(F.lit(other))
    return named.groupBy(*index, label.alias(category)).agg(F.count("*").alias("n"))


def spread(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """min, mean and max over several columns and all rows of a key (reference ranges)."""
    long = df.unpivot(list(keys), list(columns), "_column", "_v")
    return long.groupBy(*keys).agg(F.min("_v").alias("min"), F.avg("_v").alias("mean"), F.max("_v").alias("max"))


def weighted_rate(populations: DataFrame, risks: DataFrame, entity: Sequence[str], band_col: str, size: str,
                  risk: str, out: str) -> DataFrame:
    """Population-weighted rate per entity: sum of band share times band risk, by one aggregation."""
    joined = populations.join(risks, band_col, "left")
    return joined.groupBy(*entity).agg(
        F.try_divide(F.sum(F.col(size) * F.col(risk)), F.sum(size)).alias(out), F.sum(size).alias("total"))


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a label."""
    seen, order = set(), []
    for i, c in enumerate(df.columns):
        order.append(f"_keep_{i}" if c not in seen else f"_drop_{i}")
        seen.add(c)
    renamed = df.toDF(*order)
    return renamed.select(*[F.col(x).alias(df.columns[int(x.rsplit("_", 1)[1])]) for x in order if x.startswith("_keep")])
