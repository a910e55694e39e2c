"""Top-n and bottom-n groups of a panel, and orderings of column families."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.model import cols
from epitide.sources.stage import settle

Metric = Callable[[Sequence[str], str], Column]


def ranked_entities(df: DataFrame, metric: Metric, n: int, entity: str = "entity", date: str = "date",
                    largest: bool = True) -> DataFrame:
    """(entity, position): the n best entities by the metric on the last date it is known; ties by name.

    Each entity is first reduced to its latest metric, so the ordering sees one row per entity.
    """
    latest = settle(
        df.withColumn("_m", metric([entity], date)).filter(F.col("_m").isNotNull())
        .groupBy(entity).agg(F.max(date).alias("_d"), F.max_by("_m", date).alias("_m")), "latest")
    last_day = latest.agg(F.max("_d")).scalar()
    order = F.col("_m").desc() if largest else F.col("_m").asc()
    best = latest.filter(F.col("_d") == last_day).orderBy(order, entity).limit(n)
    # At most n rows are left, which is the only size this single-group numbering ever sees.
    listed = best.agg(F.sort_array(F.collect_list(
        F.struct((-F.col("_m") if largest else F.col("_m")).alias("m"), F.col(entity).alias("e")))).alias("_l"))
    return listed.select(F.posexplode("_l").alias("_p", "_x")).select(
        F.col("_x.e").alias(entity), (F.col("_p") + 1).alias("position"))


def top_groups(df: DataFrame, metric: Metric, values: str | Sequence[str], n: int = 5, value: Metric | None = None,
               other: str | None = "Rest", entity: str = "entity", date: str = "date", largest: bool = True,
               name: str = "group", out: str = "shown") -> DataFrame:
    """Long top-n table (date, group, position, shown): best n entities and, last, the sum of the rest.

    `metric` ranks entities, `value` is what is shown for each group (default: the metric itself).
    """
    values = cols(values)
    df = settle(df, "panel")
    top = ranked_entities(df, metric, n, entity, date, largest)
    labelled = df.select(entity, date, *values).join(top, entity, "left" if other else "inner")
    label = F.coalesce(F.when(F.col("position").isNotNull(), F.col(entity)), F.lit(other or ""))
    grouped = labelled.groupBy(label.alias(name), F.coalesce("position", F.lit(n + 1)).alias("position"), F.col(date)).agg(
        *[F.sum(v).alias(v) for v in values])
    shown = (value or metric)([name], date)
    return grouped.select(date, name, "position", shown.alias(out))


def group_table(top: DataFrame, n: int, date: str = "date", value: str = "shown", other: bool = True) -> DataFrame:
    """Date x position table of a top-n report, columns in rank order ('top1'.., 'other')."""
    places = list(range(1, n + 1 + bool(other)))
    out = top.groupBy(date).pivot("position", places).agg(F.max(value))
    return out.withColumnsRenamed({str(p): f"top{p}" if p <= n else "other" for p in places})


def recent_mean_order(df: DataFrame, group: str, date: str, value: str, rows: int) -> DataFrame:
    """Groups by their mean over the last `rows` dates: (group, recent_mean, position) needs no sort by callers."""
    dates = df.select(date).distinct().orderBy(F.col(date).desc()).limit(rows)
    start = dates.agg(F.min(date)).scalar()
    means = df.filter(F.col(date) >= start).groupBy(group).agg(F.avg(value).alias("recent_mean"))
    return means.orderBy(F.col("recent_mean").desc(), group)


def top_latest(df: DataFrame, group: str, date: str, value: str, n: int) -> DataFrame:
    """The n groups with the highest latest valid value."""
    from epitide.operators.repair import last_valid
    return last_valid(df, [group], date, value).orderBy(F.col(value).desc(), group).limit(n)
