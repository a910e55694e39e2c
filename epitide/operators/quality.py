"""Checks over panels. Each returns a table of findings; none of them stops a job by itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.model import cols

DEALS = 16  # parts of a domain that a grid meets one by one


def continuity(old: DataFrame, new: DataFrame, keys: Sequence[str], date: str, values: str | Sequence[str]) -> DataFrame:
    """Cumulative figures where the first row of a new batch is below the last row of the old one.

    Missing counts as zero, as both ends are reduced to one row per entity before they meet.
    """
    values = cols(values)

    def end(df, pick, name):
        row = F.struct(*[F.coalesce(F.col(v), F.lit(0.0)).alias(v) for v in values])
        return df.groupBy(*keys).agg(pick(row, F.col(date)).alias(name))

    met = end(old, F.max_by, "_last").join(end(new, F.min_by, "_next"), list(keys))
    findings = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(f"_last.{v}").alias("last"), F.col(f"_next.{v}").alias("next")) for v in values])
    return met.select(*keys, F.explode(findings).alias("_f")).select(*keys, "_f.*", (F.col("_f.next") - F.col("_f.last")).alias("difference")).filter(
        F.col("next") < F.col("last"))


def cell_validity(obs: DataFrame, rules: DataFrame, date: str = "date") -> DataFrame:
    """Adds `valid` to long observations by rules (metric, start, end, min, max).

    Rules of one metric must all hold. A date outside start..end is valid; inside, the value must be
    present and within the bounds that are given. Metrics without rules are valid.
    The rule list is grouped per metric, so an observation meets its rules in one equi-join.
    """
    per_metric = rules.groupBy("metric").agg(F.collect_list(F.struct("start", "end", "min", "max")).alias("_rules"))

    def holds(rule):
        outside = (F.col(date) < rule["start"]) | (F.col(date) > rule["end"])
        inside = F.col("value").isNotNull() & F.coalesce(F.col("value") >= rule["min"], F.lit(True)) & F.coalesce(F.col("value") <= rule["max"], F.lit(True))
        return F.coalesce(outside, F.lit(False)) | inside

    joined = obs.join(per_metric, "metric", "left")
    return joined.withColumn("valid", F.coalesce(F.forall("_rules", holds), F.lit(True))).drop("_rules").select(*obs.columns, "valid")


def to_refetch(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with invalid cells and the metrics to fetch again (one entry per metric at most)."""
    return checked.filter(~F.col("valid")).groupBy(*keys).agg(F.sort_array(F.collect_set("metric")).alias("metrics"))


def reconcile(parts: DataFrame, totals: DataFrame, keys: Sequence[str], part: str, total: str, low: float, high: float,
              exceptions: DataFrame | Column | None = None) -> DataFrame:
    """Keys whose component sum is outside low..high of the published total, apart from known exceptions.

    Exceptions are a table of keys, or a condition on the rows of `totals`, which costs no second reading of them.
    """
    summed = parts.groupBy(*keys).agg(F.sum(part).cast("double").alias("parts"))
    if isinstance(exceptions, Column):
        totals, exceptions = totals.filter(~F.coalesce(exceptions, F.lit(False))), None
    out = totals.select(*keys, F.col(total).cast("double").alias("total")).join(summed, list(keys), "left").withColumn(
        "ratio", F.try_divide(F.coalesce("parts", F.lit(0.0)), F.col("total")))
    out = out.filter(~F.coalesce((F.col("ratio") >= low) & (F.col("ratio") <= high), F.lit(False)))
    return out if exceptions is None else out.join(exceptions.select(*keys), list(keys), "left_anti")


def incomplete_periods(df: DataFrame, period: Sequence[str], value: str, expected_rows: int, minimum: float) -> DataFrame:
    """Periods to load again: too few rows or too small a sum."""
    stats = df.groupBy(*period).agg(F.count("*").alias("rows"), F.sum(value).alias("total"))
    return stats.filter((F.col("rows") < expected_rows) | ~F.coalesce(F.col("total") > minimum, F.lit(False)))


def extract_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Cells of two overlapping extracts that differ, where neither side is missing or zero."""
    both = a.select(*keys, *[F.col(v).alias(f"_a_{v}") for v in values]).join(
        b.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in values]), list(keys))
    cells = F.array(*[
        F.struct(F.lit(v).alias("metric"), F.col(f"_a_{v}").cast("double").alias("first"), F.col(f"_b_{v}").cast("double").alias("second"))
        for v in values])
    cell = both.select(*keys, F.explode(cells).alias("_c")).select(*keys, "_c.*")
    stated = (F.coalesce("first", F.lit(0.0)) != 0) & (F.coalesce("second", F.lit(0.0)) != 0)
    return cell.filter(stated & (F.col("first") != F.col("second")))


def missing_cells(have: DataFrame, domains: Mapping[str, DataFrame]) -> DataFrame:
    """Work list: every combination of the parameter domains that `have` does not hold.

    The distinct values of the domains are joined on a spread of DEALS numbers: each entity asks every number once, and
    each value of a later domain has one, so that the grid is made by all tasks and no list passes through the driver.
    Then the cells already there are removed by an anti join.
    """
    names = list(domains)
    grid = domains[names[0]].select(names[0]).distinct()
    for n in names[1:]:
        values = domains[n].select(n).distinct().withColumn("_deal", F.pmod(F.xxhash64(n), F.lit(DEALS)))
        asked = grid.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1)).cast("array<bigint>")))
        grid = asked.join(values, "_deal").drop("_deal")
    return grid.join(have.select(*names), names, "left_anti")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are missing or occur more than once."""
    null_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null_key)


def out_of_bounds(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def jumps(df: DataFrame, keys: Sequence[str], date: str, value: str, limit: float) -> DataFrame:
    """Rows whose percent change against the row before is beyond the limit in either direction."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(date))
    change = F.try_divide((F.col(value) - before).cast("double"), before.cast("double")) * 100
    return df.withColumn("change", change).filter(F.abs("change") > limit)


def freshness(cached: DataFrame, remote: DataFrame, key: str, today: Column, max_days: int | None = None) -> DataFrame:
    """Action per file from two manifests (key, modified, size): new, fetch, resume, keep, too old, gone.

    Shorter on our side: resume; other size or newer remote: fetch; a file past the age limit is not fetched.
    """
    joined = cached.select(key, F.col("modified").alias("_cm"), F.col("size").alias("_cs")).join(
        remote.select(key, F.col("modified").alias("_rm"), F.col("size").alias("_rs")), key, "full")
    stale = F.col("_cs").isNull() | (F.col("_cs") != F.col("_rs")) | (F.col("_rm") > F.col("_cm"))
    action = F.when(F.col("_rs").isNull() & F.col("_rm").isNull(), F.lit("gone"))
    if max_days is not None:
        action = action.when(stale & (F.datediff(today, F.col("_rm")) > max_days), F.lit("too old"))
    action = (
        action.when(F.col("_cs").isNull(), F.lit("new")).when(F.col("_cs") == 0, F.lit("fetch"))
        .when(F.col("_cs") < F.col("_rs"), F.lit("resume")).when(stale, F.lit("fetch")).otherwise(F.lit("keep")))
    return joined.select(key, action.alias("action"))


def newer_snapshots(live: DataFrame, published: DataFrame, keys: Sequence[str], date: str, cum: str, daily: str) -> DataFrame:
    """Live rows to accept: the day before is absent, or its total is lower and its daily figure differs."""
    before = published.select(*keys, F.date_add(date, 1).alias(date), F.col(cum).alias("_c"), F.col(daily).alias("_d"), F.lit(True).alias("_known"))
    joined = live.join(before, [*keys, date], "left")
    rose = (F.col("_c") < F.col(cum)) & (F.col("_d") != F.col(daily))
    return joined.filter(F.col("_known").isNull() | F.coalesce(rose, F.lit(False))).select(*live.columns)


def rule_violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column], exceptions: DataFrame | None = None) -> DataFrame:
    """(keys, rule) for every row rule that is false; a rule that cannot be decided is not a violation.

    `exceptions` lists (keys, rule) that are known and accepted.
    """
    broken = F.array_compact(F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()]))
    found = df.select(*keys, F.explode(broken).alias("rule"))
    return found if exceptions is None else found.join(exceptions, [*keys, "rule"], "left_anti")
