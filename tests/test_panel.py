"""Series operators on small literal panels: documented vectors, edges and invariants."""

import datetime as dt
import math
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from epitide.sources import io
from epitide.operators import alloc, forecast, merge, ordered, rank, repair, reshape, windows

D = dt.date


def day(i):
    return D(2021, 1, 1) + dt.timedelta(days=i)


def panel(spark, rows, schema="entity string, date date, value double"):
    return spark.createDataFrame(rows, schema)


def values(df, *cols):
    return {tuple(r[c] for c in ("entity", "date")): tuple(r[c] for c in cols) for r in df.collect()}


def test_priority_merge_order_nulls_and_idempotence(spark):
    a = panel(spark, [("x", day(0), None), ("x", day(1), 1.0)])
    b = panel(spark, [("x", day(0), 5.0), ("x", day(1), 9.0), ("y", day(0), None)])
    m = merge.priority_merge(merge.stack_sources(a, b), ["entity", "date"])
    got = values(m, "value")
    assert got == {("x", day(0)): (5.0,), ("x", day(1)): (1.0,), ("y", day(0)): (None,)}
    again = merge.priority_merge(merge.stack_sources(m, m), ["entity", "date"])
    assert values(again, "value") == got


def test_daily_and_cumulative_are_inverse(spark):
    rnd = random.Random(5)
    rows = [(e, day(i), float(rnd.randrange(50))) for e in "ab" for i in range(40)]
    cum = repair.daily_to_cumulative(panel(spark, rows), ["entity"]).withColumnRenamed("value Cum", "value")
    back = values(repair.cumulative_to_daily(cum, ["entity"]), "value")
    for e, d, v in rows:
        assert back[(e, d)][0] == (None if d == day(0) else pytest.approx(v))


def test_cumulative_with_dip_and_gap(spark):
    rows = [("a", day(0), 10.0), ("a", day(1), 30.0), ("a", day(2), 20.0), ("a", day(4), 40.0), ("a", day(6), None)]
    got = values(repair.cumulative_to_daily(panel(spark, rows), ["entity"], keep=True), "value", "value_daily")
    assert [got[("a", day(i))][0] for i in range(7)] == [10, 20, 20, 30, 40, None, None]
    assert [got[("a", day(i))][1] for i in range(7)] == [None, 10, 0, 10, 10, None, None]


def test_suffix_is_removed_not_its_letters(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), 3.0)], "entity string, date date, `Premium Cum` double")
    assert repair.cumulative_to_daily(df, ["entity"], values="Premium Cum").columns == ["entity", "date", "Premium"]


def test_week_keeps_its_area_and_long_gap_stays_empty(spark):
    rows = [("a", day(0), 7.0), ("a", day(7), 70.0), ("a", day(21), 14.0)]
    got = [v[0] for _, v in sorted(values(repair.weekly_to_daily(panel(spark, rows), ["entity"]), "value").items())]
    assert got[0] == 1.0
    assert got[1:8] == [10.0] * 7 and sum(got[1:8]) == 70.0
    assert got[8:15] == [None] * 7
    assert got[15:22] == [2.0] * 7


def test_fill_gaps_uses_the_open_interval(spark):
    rows = [("a", day(0), 1.0), ("a", day(2), 5.0), ("a", day(5), 8.0), ("a", day(9), 9.0)]
    got = values(repair.fill_gaps(panel(spark, rows), ["entity"], values=["value"]), "value")
    assert got == {("a", day(2)): (5.0,), ("a", day(3)): (6.0,), ("a", day(4)): (7.0,), ("a", day(5)): (8.0,)}


def test_interpolate_against_pandas(spark):
    rnd = random.Random(3)
    rows = [("a", day(i), None if rnd.random() < 0.5 else rnd.random() * 10) for i in range(60)]
    series = pd.Series([r[2] for r in rows], dtype="float64")
    for inside in (True, False):
        want = series.interpolate(limit_area="inside") if inside else series.interpolate()
        got = values(repair.interpolate(panel(spark, rows), ["entity"], inside=inside), "value")
        for i, w in enumerate(want):
            g = got[("a", day(i))][0]
            assert (g is None and math.isnan(w)) or g == pytest.approx(w)


@pytest.mark.parametrize("n,need,center", [(7, 1, False), (7, 3, True), (14, 7, True)])
def test_moving_average_against_pandas(spark, n, need, center):
    rnd = random.Random(n)
    rows = [("a", day(i), None if rnd.random() < 0.3 else float(rnd.randrange(9))) for i in range(40)]
    want = pd.Series([r[2] for r in rows], dtype="float64").rolling(n, min_periods=need, center=center).mean()
    got = values(windows.moving_average(panel(spark, rows), ["entity"], n=n, min_periods=need, center=center), "value_ma")
    for i, w in enumerate(want):
        g = got[("a", day(i))][0]
        assert (g is None and math.isnan(w)) or g == pytest.approx(w)


def test_half_slope_on_short_windows(spark):
    rows = [("a", day(i), float(i * i)) for i in range(5)]
    got = values(panel(spark, rows).withColumn("s", windows.half_slope("value", ["entity"], "date", 7)), "s")
    # first row sees rows 0..3: (v[2] - v[0]) / 4; middle row sees 0..4: (v[3] - v[0]) / 5
    assert got[("a", day(0))][0] == 1.0
    assert got[("a", day(2))][0] == pytest.approx(9 / 5)


def test_average_rank_against_pandas_with_few_ranges(spark):
    rnd = random.Random(1)
    rows = [(f"e{i}", day(i % 3), None if i % 11 == 0 else float(rnd.randrange(12))) for i in range(200)]
    df = pd.DataFrame(rows, columns=["entity", "date", "value"])
    want = df.groupby("date")["value"].rank()
    for width in (None, 0.5, 3, 1000):
        got = values(ordered.average_rank(panel(spark, rows), ["date"], "value", width=width), "rank")
        for (e, d, _), w in zip(rows, want):
            g = got[(e, d)][0]
            assert (g is None and math.isnan(w)) or g == w


def test_running_total_and_quantile_with_a_hot_key(spark):
    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < 0.8 else f"k{i % 7}", i, float(rnd.randrange(1000))) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    got = {r["i"]: r["t"] for r in ordered.running_total(df, ["k"], "i", "v", "t", width=40).collect()}
    seen = defaultdict(float)
    for k, i, v in rows:
        seen[k] += v
        assert got[i] == seen[k]
    pdf = pd.DataFrame(rows, columns=["k", "i", "v"])
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        want = pdf.groupby("k")["v"].quantile(q)
        med = {r["k"]: r["m"] for r in ordered.exact_quantile(df, ["k"], "v", q, "m", width=25).collect()}
        assert med == pytest.approx(want.to_dict())


def test_running_totals_of_doubles_are_the_same_for_any_width(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(i % 2, i, rnd.random() * 1e6) for i in range(2000)], "k int, i int, v double")
    got = [{r["i"]: r["t"] for r in ordered.running_total(df.repartition(n), ["k"], "i", "v", "t", width).collect()}
           for n, width in ((1, None), (5, 7), (3, 100), (4, 5000))]
    assert all(g == got[0] for g in got)


def test_ties_do_not_depend_on_how_rows_are_dealt(spark):
    rows = [(i % 5, float((i * 7919) % 101), "abc"[i % 3], 1, i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, value double, source string, prio int, day int")
    merged = [sorted(map(tuple, merge.priority_merge(df.repartition(n), ["k"], provenance="source").collect())) for n in (1, 3, 8)]
    latest = [sorted(map(tuple, merge.latest_wins(df.repartition(n), ["k"], "day").collect())) for n in (1, 3, 8)]
    assert merged[0] == merged[1] == merged[2] and latest[0] == latest[1] == latest[2]
    assert all((k, v, s) in {(r[0], r[1], r[2]) for r in rows} for k, v, s in merged[0])


def test_tail_replacement(spark):
    old = spark.createDataFrame([(2020, 1, "a"), (2020, 2, "b"), (None, 1, "c")], "y int, w int, v string")
    new = spark.createDataFrame([(2020, 1, "A"), (2020, 2, "B"), (2021, 1, "D"), (2020, None, "E")], "y int, w int, v string")
    assert sorted(r["v"] for r in io.replace_tail(old, new, ["y", "w"]).collect()) == ["B", "D", "E", "a"]
    assert sorted(r["v"] for r in io.replace_tail(old.limit(0), new, ["y", "w"]).collect()) == ["A", "B", "D", "E"]
    assert sorted(r["v"] for r in io.replace_tail(old, new, "y").collect()) == ["A", "B", "D", "E"]


def test_bands_edges(spark):
    rows = [(-1.0,), (0.0,), (9.9,), (10.0,), (139.0,), (140.0,), (None,)]
    got = [r["b"] for r in spark.createDataFrame(rows, "age double").withColumn("b", reshape.band("age", [10, 70])).collect()]
    assert got == [None, "0-9", "0-9", "10-69", "70+", None, None]


def test_normalised_parts_add_up(spark):
    rows = [("a", day(0), 1.0), ("b", day(0), 3.0), ("a", day(1), 0.0)]
    out = alloc.normalise(panel(spark, rows).withColumn("total", F.lit(10.0)), ["date"], "value", "total", "s").collect()
    assert sum(r["s"] for r in out if r["date"] == day(0)) == pytest.approx(10)
    assert [r["s"] for r in out if r["date"] == day(1)] == [None]


def test_top_groups_sums_the_rest(spark):
    rows = [(e, day(i), float(v + i)) for e, v in zip("abcd", (1, 5, 3, 5)) for i in range(2)]
    top = rank.top_groups(panel(spark, rows), lambda k, d: F.col("value"), "value", 2, other="Rest")
    got = {(r["group"], r["date"]): (r["position"], r["shown"]) for r in top.collect()}
    assert got[("b", day(1))] == (1, 6.0) and got[("d", day(1))] == (2, 6.0)
    assert got[("Rest", day(1))] == (3, 6.0)
    assert set(rank.group_table(top, 2).columns) == {"date", "top1", "top2", "other"}


def test_forecast_repeats_first_series(spark):
    rows = [("a", day(i), float(10 * i), float(4 * i)) for i in range(60)]
    df = panel(spark, rows, "entity string, date date, d1 double, d2 double")
    got = {r["step"]: r for r in forecast.follow_up(df, ["entity"], "d1", "d2", 50, 40).collect()}
    assert len(got) == 51
    assert got[0]["d1_pred"] == 590 + 10 and got[50]["d1_pred"] == 590 + 510
    assert got[0]["d2_pred"] == 4 * 59 and got[40]["d2_pred"] == 4 * 59 + 400
    assert got[41]["d2_pred"] == 4 * 59 + 400 + 20  # the forecast itself starts one day's gain ahead


def test_grid_and_trim(spark):
    rows = [("a", day(0), 1.0), ("b", day(2), 2.0)]
    got = values(repair.densify_grid(panel(spark, rows), ["entity"], fill=0.0), "value")
    assert got == {("a", day(0)): (1.0,), ("a", day(2)): (0.0,), ("b", day(0)): (0.0,), ("b", day(2)): (2.0,)}
    tail = panel(spark, [("a", day(i), None if i in (1, 4) else 1.0) for i in range(6)])
    assert {r["date"] for r in repair.drop_incomplete_tail(tail, ["entity"], "date", ["value"], 3).collect()} == {day(0), day(1), day(2), day(3), day(5)}
    assert repair.cut_after_last_valid(tail, ["entity"], "date", "value").count() == 6


def test_cumulative_one_and_many_columns_agree(spark):
    rnd = random.Random(8)
    rows = []
    for e in "abcd":
        total = 0.0
        for i in range(50):
            total += rnd.randrange(9)
            if rnd.random() < 0.6:
                rows.append((e, day(i), None if rnd.random() < 0.3 or e == "d" else total - (5 if rnd.random() < 0.2 else 0)))
    df = panel(spark, rows)
    one = values(repair.cumulative_to_daily(df, ["entity"], keep=True), "value", "value_daily")
    two = values(repair.cumulative_to_daily(df.withColumn("again", F.col("value")), ["entity"], values=["value", "again"], keep=True), "value", "value_daily")
    assert one.keys() == two.keys()
    for k in one:
        assert one[k] == pytest.approx(two[k])


def test_repeated_days_are_refused_or_resolved(spark):
    rows = [("a", day(0), 7.0, 2), ("a", day(7), 14.0, 5), ("a", day(7), 70.0, 4)]
    df = spark.createDataFrame(rows, "entity string, date date, value double, arrived int")
    for op in (repair.densify, repair.cumulative_to_daily, repair.weekly_to_daily):
        with pytest.raises(Exception, match="repeated day"):
            op(df.drop("arrived"), ["entity"]).collect()
    got = values(repair.weekly_to_daily(df, ["entity"], arrival="arrived"), "value")
    assert got[("a", day(7))] == (10.0,) and got[("a", day(0))] == (1.0,)


def test_one_sort_and_all_missing_series(spark):
    rows = [("a", day(0), None), ("a", day(3), None), ("b", day(1), 4.0)]
    got = values(repair.cumulative_to_daily(panel(spark, rows), ["entity"], keep=True), "value", "value_daily")
    assert got == {**{("a", day(i)): (None, None) for i in range(4)}, ("b", day(1)): (4.0, None)}
