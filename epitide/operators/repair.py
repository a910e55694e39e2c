"""Repairing time series: densify, interpolate, remove dips, cumulative and weekly to daily.

Input rows must be unique per (keys, date); merge first. Then a window partition holds at most one
row per calendar day, however many raw records an entity had, so no task sees an unbounded group.
All steps of one repair share the same partitioning: one shuffle, no self join. "Rest of the
series" frames are written as running frames in descending order, because a frame that ends at
unboundedFollowing is evaluated anew for every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.model import cols, day_number
from epitide.operators.merge import latest_wins
from epitide.sources.stage import settle

MAX_DAYS = 200_000  # days of a grid: five hundred years


def _asc(keys, date):
    return Window.partitionBy(*keys).orderBy(date)


def _up_to_now(keys, date):
    return _asc(keys, date).rowsBetween(Window.unboundedPreceding, 0)


def _from_now_on(keys, date):
    """Running frame over later rows: descending order, so the frame is current row .. end."""
    return Window.partitionBy(*keys).orderBy(F.col(date).desc()).rowsBetween(Window.unboundedPreceding, 0)


def _distinct_days(keys, date: str, other: Column) -> Column:
    """`other`, the neighbouring row's date; two rows of one series on one day stop the job."""
    message = F.concat(F.lit("repeated day "), F.col(date).cast("string"), F.lit(f" in one series of {list(keys)}: merge first"))
    return F.when(other == F.col(date), F.raise_error(message).cast("date")).otherwise(other)


def densify(df: DataFrame, keys: Sequence[str], date: str = "date", fill=None) -> DataFrame:
    """Every day between each entity's first and last row; new days hold null, or `fill`.

    Each row emits itself and the days up to the next row, so no calendar join is needed.
    """
    rest = [c for c in df.columns if c not in keys and c != date]
    days = df.withColumn("_next", F.lead(date).over(_asc(keys, date)))
    days = days.withColumn("_upto", F.coalesce(F.date_sub(_distinct_days(keys, date, F.col("_next")), 1), F.col(date)))
    days = days.withColumn("_day", F.explode(F.sequence(F.col(date), F.col("_upto"))))
    own = F.col("_day") == F.col(date)
    values = [
        (F.when(own, F.col(c)) if fill is None else F.coalesce(F.when(own, F.col(c)), F.lit(fill))).alias(c)
        for c in rest
    ]
    return days.select(*keys, F.col("_day").alias(date), *values)


def densify_grid(df: DataFrame, keys: Sequence[str], date: str = "date", fill=0) -> DataFrame:
    """Every entity on every date that occurs anywhere; missing cells hold `fill`.

    The dates are one array (at most one element per calendar day, MAX_DAYS in all, or the query fails) attached to the
    distinct entities, so the grid is an explode of the entity list rather than a product join.
    """
    rest = [c for c in df.columns if c not in keys and c != date]
    df = settle(df, "grid")
    seen = F.collect_set(date)
    dates = df.agg(F.when(F.size(seen) <= MAX_DAYS, seen).otherwise(F.raise_error(F.lit(f"more than {MAX_DAYS} dates")))).scalar()
    grid = df.select(*keys).distinct().withColumn(date, F.explode(dates))
    joined = grid.join(df, [*keys, date], "left")
    return joined.select(*keys, date, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in rest])


def remove_dips(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value") -> DataFrame:
    """A later, lower cumulative figure corrects the earlier ones; missing stays missing."""
    later = _from_now_on(keys, date)
    return df.withColumns({v: F.when(F.col(v).isNotNull(), F.min(v).over(later)) for v in cols(values)})


def interpolate(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value",
                inside: bool = True) -> DataFrame:
    """Linear interpolation over time between valid neighbours.

    inside=True fills interior gaps only; inside=False also repeats the last value to the end.
    """
    before, after = _up_to_now(keys, date), _from_now_on(keys, date)
    out = df
    for v in cols(values):
        valid_day = F.when(F.col(v).isNotNull(), day_number(date))
        out = out.withColumns({
            "_pv": F.last(v, ignorenulls=True).over(before),
            "_pd": F.last(valid_day, ignorenulls=True).over(before),
            "_nv": F.last(v, ignorenulls=True).over(after),
            "_nd": F.last(valid_day, ignorenulls=True).over(after),
        })
        line = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * F.try_divide(
            (day_number(date) - F.col("_pd")).cast("double"), (F.col("_nd") - F.col("_pd")).cast("double"))
        filled = F.coalesce(F.col(v), line)
        if not inside:
            filled = F.coalesce(filled, F.col("_pv"))
        out = out.withColumn(v, filled).drop("_pv", "_pd", "_nv", "_nd")
    return out


def difference(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value") -> DataFrame:
    w = _asc(keys, date)
    return df.withColumns({v: F.col(v) - F.lag(v).over(w) for v in cols(values)})


def drop_suffix(name: str, suffix: str = " Cum") -> str:
    return name[: -len(suffix)] if name.endswith(suffix) else name


def cumulative_to_daily(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value",
                        keep: bool = False) -> DataFrame:
    """Daily increments of a cumulative series: dips removed, gaps interpolated, never negative.

    Columns named '... Cum' lose that suffix. keep=True returns the repaired cumulative as well.
    """
    values = cols(values)
    source = df.select(*keys, date, *values)
    if len(values) == 1:
        both = _one_cumulative(source, keys, date, values[0])
    else:
        cum = interpolate(densify(remove_dips(source, keys, date, values), keys, date), keys, date, values)
        w = _asc(keys, date)
        both = cum.withColumns({f"_daily_{i}": F.col(f"`{v}`") - F.lag(f"`{v}`").over(w) for i, v in enumerate(values)})
    kept = [F.col(f"`{v}`") for v in values] if keep else []
    names = [drop_suffix(v) + ("_daily" if keep and drop_suffix(v) == v else "") for v in values]
    return both.select(*keys, date, *kept, *[F.col(f"_daily_{i}").alias(n) for i, n in enumerate(names)])


def _one_cumulative(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Repaired cumulative and `_daily_0` of one column, from the reported rows with a single sort.

    Going back in time, each valid row learns the next valid one, and then emits the days up to it; the
    first and the last valid row also emit the empty days before and after them.
    """
    v, day = F.col(f"`{value}`"), F.col(date)
    valid_day = F.when(v.isNotNull(), day)
    later = _from_now_on(keys, date)
    strictly = Window.partitionBy(*keys).orderBy(day.desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    rows = df.withColumns({
        "_next": F.lag(day).over(Window.partitionBy(*keys).orderBy(day.desc())),
        "_v": F.when(v.isNotNull(), F.min(v).over(later)), "_nv": F.min(v).over(strictly), "_nd": F.last(valid_day, ignorenulls=True).over(strictly),
        "_lo": F.min(day).over(whole), "_hi": F.max(day).over(whole), "_first": F.min(valid_day).over(whole),
    })
    # A series without any valid value still shows its days.
    empty = F.col("_first").isNull() & (day == F.col("_lo"))
    checked = F.coalesce(_distinct_days(keys, date, F.col("_next")), day).isNotNull()
    spans = rows.filter(checked & (v.isNotNull() | empty)).select(
        *keys, day.alias("_from"), "_v", "_nv", (F.col("_nv") - F.col("_v")).alias("_rise"),
        F.datediff("_nd", day).cast("double").alias("_days"),
        F.when(day == F.col("_first"), F.col("_lo")).when(empty, day).otherwise(F.date_add(day, 1)).alias("_start"),
        F.coalesce("_nd", "_hi").alias("_stop")).filter(F.col("_start") <= F.col("_stop"))
    days = spans.withColumn(date, F.explode(F.sequence("_start", "_stop"))).withColumn("_n", F.datediff(F.col(date), F.col("_from")))

    def after(n):
        return F.when(n == 0, F.col("_v")).when(n > 0, F.col("_v") + F.col("_rise") * (n / F.col("_days")))

    today = F.when(F.col("_n") == F.col("_days"), F.col("_nv")).otherwise(after(F.col("_n")))
    return days.select(*keys, date, today.alias(value), (today - after(F.col("_n") - 1)).alias("_daily_0"))


def weekly_to_daily(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value",
                    arrival: str | None = None) -> DataFrame:
    """A week's figure, divided by 7, on each of the 7 days that end on its report date.

    The series starts on the first report date; days more than a week before the next report stay null.
    Where reports may be repeated, `arrival` orders them and the first one counts.
    """
    values = cols(values)
    if arrival:
        df = latest_wins(df, [*keys, date], arrival, newest=False)
    days = densify(df.select(*keys, date, *values), keys, date)
    ahead = Window.partitionBy(*keys).orderBy(day_number(date)).rangeBetween(0, 6)
    return days.withColumns({v: F.min(F.col(v) / 7).over(ahead) for v in values})


def daily_to_cumulative(df: DataFrame, keys: Sequence[str], date: str = "date",
                        values: str | Sequence[str] = "value", suffix: str = " Cum") -> DataFrame:
    values = cols(values)
    days = densify(df.select(*keys, date, *values), keys, date)
    w = _up_to_now(keys, date)
    return days.select(*keys, date, *[
        F.sum(F.coalesce(F.col(v), F.lit(0.0))).over(w).alias(v + suffix) for v in values])


def fill_gaps(df: DataFrame, keys: Sequence[str], date: str = "date", values: Sequence[str] = (),
              cumulative: Sequence[str] = (), arrival: str | None = None) -> DataFrame:
    """Days strictly between the first and last report, dips removed on cumulatives, all interpolated.

    Days on which every column is still missing are dropped. Where reports may be repeated, `arrival`
    orders them and the first one counts.
    """
    both = [*values, *cumulative]
    if arrival:
        df = latest_wins(df, [*keys, date], arrival, newest=False)
    whole = Window.partitionBy(*keys)
    inner = densify(df.select(*keys, date, *both), keys, date).withColumns({
        "_lo": F.min(date).over(whole), "_hi": F.max(date).over(whole),
    }).filter((F.col(date) > F.col("_lo")) & (F.col(date) < F.col("_hi"))).drop("_lo", "_hi")
    if cumulative:
        inner = remove_dips(inner, keys, date, cumulative)
    return interpolate(inner, keys, date, both).dropna("all", subset=both)


def rebuild_cumulative(df: DataFrame, keys: Sequence[str], date: str, increment: str, closing: str | Column,
                       out: str) -> DataFrame:
    """Cumulative series backwards from its closing value: closing minus all later increments."""
    later = Window.partitionBy(*keys).orderBy(F.col(date).desc()).rowsBetween(Window.unboundedPreceding, -1)
    end = F.col(closing) if isinstance(closing, str) else closing
    return df.withColumn(out, end - F.coalesce(F.sum(increment).over(later), F.lit(0.0)))


def falling_points(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """Adds `falls` (below the row before) and `above_next` (above the row after)."""
    w = _asc(keys, date)
    v = F.col(value)
    return df.withColumns({
        "falls": F.coalesce(v < F.lag(value).over(w), F.lit(False)),
        "above_next": F.coalesce(v > F.lead(value).over(w), F.lit(False)),
    })


def ratchet(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value") -> DataFrame:
    """Running maximum: an incomplete day cannot lower a cumulative. Missing stays missing."""
    w = _up_to_now(keys, date)
    return df.withColumns({v: F.when(F.col(v).isNotNull(), F.max(v).over(w)) for v in cols(values)})


def periodic_from_cumulative(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """Increments of an interpolated cumulative; no change counts as missing."""
    filled = interpolate(densify(df.select(*keys, date, value), keys, date), keys, date, value)
    w = _asc(keys, date)
    return filled.withColumn(value, F.nullif(F.col(value) - F.lag(value).over(w), F.lit(0.0)))


def drop_incomplete_tail(df: DataFrame, keys: Sequence[str], date: str, columns: Sequence[str], n: int) -> DataFrame:
    """Among the last n rows of each series, drop those with a missing value in `columns`."""
    recent = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(date).desc()))
    missing = F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()
    return df.withColumn("_r", recent).filter((F.col("_r") > n) | ~missing).drop("_r")


def cut_after_last_valid(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    whole = Window.partitionBy(*keys)
    return df.withColumn("_last", F.max(F.when(F.col(value).isNotNull(), F.col(date))).over(whole)).filter(
        F.col(date) <= F.col("_last")).drop("_last")


def complete_dates(df: DataFrame, entity: str, date: str, value: str, expected: int | Column) -> DataFrame:
    """Only dates on which `expected` entities report a value.

    The counts are one row per date, pre-aggregated on the map side, and joined back.
    """
    full = (
        df.filter(F.col(value).isNotNull()).groupBy(date).agg(F.countDistinct(entity).alias("_n"))
        .filter(F.col("_n") == (F.lit(expected) if isinstance(expected, int) else expected)).select(date))
    return df.join(full, date, "left_semi")


def last_valid(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value") -> DataFrame:
    """Latest non-null value per entity and its date."""
    aggs = []
    for v in cols(values):
        when = F.when(F.col(v).isNotNull(), F.col(date))
        aggs += [F.max_by(v, when).alias(v), F.max(when).alias(f"{v}_date")]
    return df.groupBy(*keys).agg(*aggs)


def interval_rate(df: DataFrame, keys: Sequence[str], start: str, end: str, value: str, out: str = "date") -> DataFrame:
    """Interval total per day of its length, placed on the end date, then daily by interpolation."""
    rate = F.try_divide(F.col(value).cast("double"), F.datediff(F.col(end), F.col(start)))
    placed = df.select(*keys, F.col(end).alias(out), rate.alias(value))
    return interpolate(densify(placed, keys, out), keys, out, value)


def forward_fill(df: DataFrame, keys: Sequence[str], date: str = "date", values: str | Sequence[str] = "value") -> DataFrame:
    w = _up_to_now(keys, date)
    return df.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in cols(values)})
