"""Epidemiological measures composed from the panel operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.functions.calendar import month_end
from epitide.functions.scalar import clip, prefix_group, ratio, row_mean, row_sum, subtract
from epitide.operators import repair, windows
from epitide.operators.merge import priority_merge, stack_sources
from epitide.operators.ordered import average_rank
from epitide.sources.stage import settle

# Detection to death, infection to death (days), overall fatality for the simple estimate.
DAYS_TO_DEATH = 17
INFECTION_TO_DEATH = 11
OVERALL_IFR = 0.0054
CFR_WINDOW = 90


def excess(df: DataFrame, keys: Sequence[str], value: str, years: Sequence[int], start: int,
           short: Sequence[int], long: Sequence[int]) -> DataFrame:
    """Excess over the baseline, per key and month of every year from `start` on.

    P-score and excess use the mean of the `long` baseline; ranges of both baselines and the figures of
    every year come along. One aggregation: years become columns by conditional sums, and the report
    years are unfolded from the same row. Rows without a P-score are dropped.
    """
    sums = {y: F.sum(F.when(F.col("year") == y, F.col(value))).alias(f"{value}_{y}") for y in years}
    months = df.groupBy(*keys, "month").agg(*sums.values())

    def base(which, name):
        cs = [f"{value}_{y}" for y in which]
        return {f"{name}_avg": row_mean(cs), f"{name}_min": F.array_min(F.array(*cs)), f"{name}_max": F.array_max(F.array(*cs))}

    wide = months.withColumns({**base(short, "pre"), **base(long, "pre5")})
    report = F.array(*[F.struct(F.lit(y).alias("year"), F.col(f"{value}_{y}").alias("v")) for y in years if y >= start])
    rows = wide.withColumn("_r", F.explode(report)).withColumns({"year": F.col("_r.year"), f"{value}_month": F.col("_r.v")}).drop("_r")
    gap = F.col(f"{value}_month") - F.col("pre5_avg")
    return rows.withColumns({
        "excess": gap, "p_score": F.try_divide(gap, F.col("pre5_avg")) * 100, "date": month_end("year", "month"),
    }).filter(F.col("p_score").isNotNull())


def excess_over(df: DataFrame, groupings: Mapping[str, Sequence[str]], value: str, years: Sequence[int], start: int,
                short: Sequence[int], long: Sequence[int]) -> DataFrame:
    """`excess` for several groupings that need not nest (by region, by place, by band, by band and region) in one pass.

    One aggregation with grouping sets reduces the facts to (grouping, its columns, year, month); baselines are then taken
    within each grouping. `grouping` names the set; columns that are not part of it are null, and a null that is data
    stays apart from them, as `grouping` is a key of its own.
    """
    columns = list(dict.fromkeys(c for cs in groupings.values() for c in cs))
    sets = [[F.col(c) for c in (*cs, "year", "month")] for cs in groupings.values()]
    ids = F.grouping_id(*columns, "year", "month")
    reduced = df.groupingSets(sets, *columns, "year", "month").agg(F.sum(value).alias(value), ids.alias("_id"))
    every = [*columns, "year", "month"]
    known = {sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in (*cs, "year", "month")): name for name, cs in groupings.items()}
    if len(known) < len(groupings):
        raise ValueError("two groupings have the same columns")
    name = F.coalesce(*[F.when(F.col("_id") == i, n) for i, n in known.items()])
    return excess(reduced.withColumn("grouping", name).drop("_id"), ["grouping", *columns], value, years, start, short, long)


def expected(excess_df: DataFrame, known: DataFrame, keys: Sequence[str], value: str, cause: str, baseline: str = "pre5_avg") -> DataFrame:
    """Expected figures with the known cause on top, and the unexplained deviation in percent."""
    joined = excess_df.join(known.select(*keys, "date", cause), [*keys, "date"], "left")
    return joined.withColumns({
        "without_cause": F.col(f"{value}_month") - F.col(cause),
        "expected": F.col("pre5_avg") + F.col(cause),
        "deviation": F.try_divide(F.col("excess") - F.col(cause), F.col(baseline)) * 100,
    })


def fatality_ratio(df: DataFrame, keys: Sequence[str], date: str, deaths: str, cases: str, out: str = "cfr",
                   n: int = CFR_WINDOW, delay: int = DAYS_TO_DEATH) -> DataFrame:
    """Mean deaths over n rows against mean cases over n rows, `delay` rows earlier, times 100."""
    w, order = windows.frame(keys, date, n), Window.partitionBy(*keys).orderBy(date)
    lagged = df.withColumn("_lagged", F.lag(cases, delay).over(order))
    return lagged.withColumn(
        out, F.try_divide(windows.rolling(deaths, w, n), windows.rolling("_lagged", w, n)) * 100).drop("_lagged")


def infections(df: DataFrame, entity: str, date: str, deaths: str, ifr_percent: str, shift: int = INFECTION_TO_DEATH) -> DataFrame:
    """Infections behind the deaths of all entities, dated back to the infection.

    (date, deaths, infections, infections_ma, simple): the moving average is not moved in time.
    """
    filled = df.fillna(0.0, subset=[deaths])
    ma = windows.moving_average(filled, [entity], date, deaths, 7, 1, suffix="_ma")
    per_day = ma.withColumns({
        "_inf": ratio(deaths, ratio(ifr_percent, F.lit(100))), "_inf_ma": ratio(f"{deaths}_ma", ratio(ifr_percent, F.lit(100))),
    }).groupBy(date).agg(F.sum(deaths).alias(deaths), F.sum("_inf").alias("_inf"), F.sum("_inf_ma").alias("infections_ma"))
    order = Window.partitionBy().orderBy(date)  # one row per calendar day is left
    return per_day.select(
        date, deaths, F.lead("_inf", shift).over(order).alias("infections"), "infections_ma",
        (F.lead(deaths, shift).over(order) / OVERALL_IFR).alias("simple"))


def variant_shares(samples: DataFrame, date: str, lineage: str, n: str, groups: Sequence[tuple[str, str]], min_samples: float) -> DataFrame:
    """(date, grp, share) of lineage groups, only on dates with enough samples; unseen groups are 0."""
    grouped = settle(samples.groupBy(date, prefix_group(lineage, groups).alias("grp")).agg(F.sum(n).alias(n)), "samples")
    enough = grouped.groupBy(date).agg(F.sum(n).alias("_all")).filter(F.col("_all") >= min_samples)
    kept = grouped.join(enough, date).select("grp", date, F.try_divide(F.col(n).cast("double"), F.col("_all")).alias("share"))
    return repair.densify_grid(kept, ["grp"], date, 0.0)


def variant_mix(detailed: DataFrame, coarse: DataFrame, counts: DataFrame, date: str, value: str, scale: DataFrame | None = None) -> DataFrame:
    """Detailed shares (times a coarse share, if given) before coarse ones, daily by interpolation, times counts."""
    if scale is not None:
        detailed = detailed.join(scale.select(date, F.col("share").alias("_s")), date).withColumn("share", F.col("share") * F.col("_s")).drop("_s")
    merged = priority_merge(stack_sources(detailed, coarse), ["grp", date], "share")
    daily = repair.interpolate(repair.densify(merged, ["grp"], date), ["grp"], date, "share", inside=False)
    return daily.join(counts.select(date, value), date).withColumn("estimate", F.col("share") * F.col(value))


def trend_table(df: DataFrame, entity: str, date: str, value: str, dim: DataFrame, style: str = "green_up",
                sensitivity: float = 25, n: int = 7, width: float | None = None) -> DataFrame:
    """Latest smoothed value per entity and its trend, joined to the dimension (entity, region, population).

    Styles: 'abs' the smoothed value itself, 'rank' change of rank among entities, otherwise change per
    population against the overall peak. Input is one row per entity and day; `width` splits the values of a day
    for the ranks.
    """
    smooth = windows.moving_average(df.select(entity, date, value), [entity], date, value, n, n // 2, True, "_s")
    smooth = settle(smooth.withColumnRenamed(f"{value}_s", "ma"), "smooth")
    order = Window.partitionBy(entity).orderBy(date)
    if "abs" in style:
        table = smooth.withColumn("trend", F.col("ma") * sensitivity)
    elif "rank" in style:
        ranked = average_rank(smooth, [date], "ma", "_rank", width)
        peak = ranked.agg(F.max("_rank")).scalar()
        moved = F.col("_rank") - F.lag("_rank", windows.trend_lag(n, "rank")).over(order)
        table = ranked.withColumn("trend", F.try_divide(moved, peak) * sensitivity).drop("_rank")
    else:
        sized = smooth.join(dim.select(entity, "population"), entity, "left")
        peak = F.try_divide(smooth.agg(F.max("ma")).scalar(), dim.agg(F.max("population")).scalar())
        moved = F.col("ma") - F.lag("ma", windows.trend_lag(n, "population")).over(order)
        table = sized.withColumn("trend", F.try_divide(F.try_divide(moved, F.col("population")), peak) * sensitivity).drop("population")
    last_day = smooth.filter("ma IS NOT NULL").agg(F.max(date)).scalar()
    return table.filter(F.col(date) == last_day).join(dim.select(entity, "region"), entity, "left").select(
        entity, "region", value, "ma", "trend", F.lit(style).alias("trend_style"))


def condition_split(df: DataFrame, keys: Sequence[str], date: str, hospitalised: str, severe: str, ventilated: str,
                    field: str, field_parts: Sequence[str], cases: str, exits: Sequence[str]) -> DataFrame:
    """Active patients by condition, gaps in the ward figures interpolated first.

    severe_only (without ventilation), hospital_other, field_unknown, mild, and other_active: cases to
    date that are neither in a ward nor among the exits. Residuals never fall below zero.
    """
    filled = repair.interpolate(df, keys, date, [hospitalised, severe, ventilated, field])
    known = row_sum(["severe_only", ventilated, field])
    out = filled.withColumn("severe_only", subtract(severe, ventilated))
    out = out.withColumns({
        "hospital_other": subtract(hospitalised, known),
        "field_unknown": clip(subtract(field, row_sum(field_parts), 0.0), 0.0),
        "other_active": clip(subtract(subtract(cases, known, 0.0), row_sum(exits), 0.0), 0.0),
    })
    wards = row_sum([ventilated, severe, "field_unknown", *field_parts])
    return out.withColumn("mild", clip(subtract(hospitalised, wards, 0.0), 0.0))


def shares_of(df: DataFrame, parts: Sequence[str], whole: str, suffix: str = "_pct") -> DataFrame:
    """Each part as percent of the whole; a zero whole gives missing."""
    return df.withColumns({p + suffix: ratio(p, whole, 100) for p in parts})


def deaths_by_band(df: DataFrame, keys: Sequence[str], date: str, cfr: str, cases: str, anchor: str, out: str = "deaths_cum") -> DataFrame:
    """Cumulative deaths of a band: smoothed band CFR (percent) times smoothed cumulative cases."""
    waves = windows.running_from(df, keys, date, cases, anchor)
    rate = windows.rolling(cfr, windows.frame(keys, date, 21, True), 13)
    total = windows.rolling(f"{cases}_cum", windows.frame(keys, date, 7, True), 3)
    return waves.withColumn(out, rate / 100 * total)


def observed_and_forecast(model: DataFrame, observed: DataFrame, date: str, estimate: str, value: str, horizon: int = 60) -> DataFrame:
    """Model values up to the last observed day as estimates, and `horizon` days beyond it as forecast."""
    today = observed.filter(F.col(value).isNotNull()).agg(F.max(date)).scalar()
    split = settle(model.select(date, estimate).withColumn("_today", today), "model")
    past = split.filter(F.col(date) <= F.col("_today")).select(date, F.col(estimate).alias("estimated"))
    past = past.join(observed.select(date, F.col(value).alias("reported")), date, "left")
    future = split.filter((F.col(date) >= F.col("_today")) & (F.col(date) <= F.date_add("_today", horizon))).select(
        date, F.col(estimate).alias("forecast"))
    return priority_merge(stack_sources(past, future), [date], ["estimated", "reported", "forecast"])


def coverage(df: DataFrame, dim: DataFrame, entity: str, date: str, value: str, expected: int | Column, out: str = "coverage") -> DataFrame:
    """Regional share of population on dates all entities report; zero is missing, never falling."""
    full = repair.complete_dates(df, entity, date, value, expected)
    people = dim.groupBy("region").agg(F.sum("population").alias("population"))
    regional = full.select(entity, date, value).join(dim.select(entity, "region"), entity).groupBy("region", date).agg(F.sum(value).alias(value))
    rated = regional.join(people, "region").withColumn(out, F.nullif(ratio(value, "population", 100), F.lit(0.0)))
    return repair.ratchet(rated, ["region"], date, out)


def regional_daily_rate(df: DataFrame, dim: DataFrame, entity: str, date: str, value: str, expected: int | Column,
                        per: float = 100000, out: str = "rate") -> DataFrame:
    """Daily increments per head by region, from cumulative entity figures, on dates all entities report."""
    daily = repair.cumulative_to_daily(df.select(entity, date, value), [entity], date, value)
    full = repair.complete_dates(daily, entity, date, value, expected)
    people = dim.groupBy("region").agg(F.sum("population").alias("population"))
    regional = full.join(dim.select(entity, "region"), entity).groupBy("region", date).agg(F.sum(value).alias(value))
    return regional.join(people, "region").withColumn(out, ratio(value, "population", per))


