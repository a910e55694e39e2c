"""Calendar expressions: weeks, months, other year systems, date repair, file-name dates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDDHIST_OFFSET = 543


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_range(start: str | Column, end: str | Column, offset: int = 0) -> Column:
    """Array of days from start until before end; `offset` extends it. Empty if nothing is left."""
    start, end = _c(start), _c(end)
    last = F.date_add(end, offset - 1)
    return F.when(last >= start, F.sequence(start, last)).otherwise(F.array().cast("array<date>"))


def week_end(year: str | Column, week: str | Column, offset: int = 0) -> Column:
    """Saturday of Sunday-based week `week` of `year` (days before the first Sunday are week 0)."""
    first_sunday = F.next_day(F.make_date(_c(year) - 1, F.lit(12), F.lit(31)), "Sun")
    return F.date_add(first_sunday, ((_c(week) - 1) * 7 + 6 - offset).cast("int"))


def sunday_week(date: str | Column) -> Column:
    """Sunday-based week of the year, 0..53."""
    d = _c(date)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def infer_year(week: str | Column, today: Date) -> Column:
    """Where the year is not given: a week later than today's week belongs to last year."""
    this_week = int(today.strftime("%U"))
    return F.when(_c(week) > this_week, F.lit(today.year - 1)).otherwise(F.lit(today.year))


def epoch_week(week: str | Column, anchor: Column | Date | str) -> Column:
    """Date of a week counted from an anchor date."""
    start = anchor if isinstance(anchor, Column) else F.lit(anchor).cast("date")
    return F.date_add(start, (_c(week) * 7).cast("int"))


def anchored_week(week: str | Column, anchors: Sequence[tuple[int, Date | str]]) -> Column:
    """Date of a counted week where the anchor changes: (first week it holds for, anchor), ascending."""
    out = None
    for first, anchor in reversed(list(anchors)):
        holds = _c(week) >= first
        out = F.when(holds, epoch_week(week, anchor)) if out is None else out.when(holds, epoch_week(week, anchor))
    return out


def week_bucket(date: str | Column) -> Column:
    """Saturday that closes the (Sunday to Saturday) week of a day."""
    return F.next_day(F.date_sub(_c(date), 1), "Sat")


def month_end(year: str | Column, month: str | Column) -> Column:
    return F.last_day(F.make_date(_c(year), _c(month), F.lit(1)))


def month_start(date: str | Column, shift: int = 0) -> Column:
    return F.add_months(F.trunc(_c(date), "month"), shift)


def month_name(date: str | Column) -> Column:
    return F.date_format(_c(date), "MMMM")


def to_gregorian_year(year: str | Column, guess: bool = False, short: bool = False) -> Column:
    """Buddhist year (two digits mean 25xx) to Gregorian. With guess, only plausible ones convert."""
    y = _c(year).cast("int")
    converted = F.when(y < 100, y + 2500).otherwise(y) - BUDDHIST_OFFSET
    if guess:
        converted = F.when((y > 2500) | ((y > 60) & (y < 100)), converted).otherwise(y)
    return converted - 2000 if short else converted


def to_buddhist_year(year: str | Column, short: bool = False) -> Column:
    y = _c(year).cast("int")
    converted = F.when(y < 100, y + 2000).otherwise(y) + BUDDHIST_OFFSET
    return converted - 2500 if short else converted


def swap_day_month(date: str | Column) -> Column:
    """Repair a date read with day and month exchanged; only possible when the day is below 13."""
    d = _c(date)
    return F.when(F.dayofmonth(d) < 13, F.make_date(F.year(d), F.dayofmonth(d), F.month(d))).otherwise(d)


def previous_day_of_month(end: str | Column, day: str | Column) -> Column:
    """Latest date not after `end` whose day of month is `day`, skipping months that are too short."""
    end, day = _c(end), _c(day).cast("int")
    out = None
    # No two months in a row have fewer than 30 days and none fewer than 28, so three are enough.
    for back in range(4):
        first = F.add_months(F.trunc(end, "month"), -back)
        candidate = F.date_add(first, day - 1)
        ok = (day >= 1) & (candidate <= end) & (day <= F.dayofmonth(F.last_day(first)))
        out = F.when(ok, candidate) if out is None else out.when(ok, candidate)
    return out


def expand_days(df: DataFrame, start: str, end: str, out: str = "date", offset: int = 1) -> DataFrame:
    """One row per day of each row's interval (end inclusive by default)."""
    return df.withColumn(out, F.explode(day_range(start, end, offset)))


def spread_evenly(df: DataFrame, start: str, end: str, values: list[str], out: str = "date") -> DataFrame:
    """Interval totals to equal daily shares over start..end, both inclusive."""
    days = F.datediff(F.col(end), F.col(start)) + 1
    shared = df.withColumns({v: F.try_divide(F.col(v).cast("double"), days) for v in values})
    return expand_days(shared, start, end, out)
