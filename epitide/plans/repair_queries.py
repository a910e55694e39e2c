"""Time-series repair and rolling windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from epitide.operators import repair, windows
from epitide.plans import inputs, sqltext
from epitide.plans.inputs import r6
from epitide.plans.registry import query

W = "PARTITION BY entity ORDER BY date"


def _series(t):
    return inputs.daily(t).select("entity", "date", "value")


@query("t1_densify", f"WITH {inputs.DAILY}, {sqltext.dense('daily', 'value, n')} SELECT * FROM dense")
def t1(t):
    return repair.densify(inputs.daily(t).select("entity", "date", "value", "n"), ["entity"])


@query("t1_densify_fill", f"""WITH {inputs.DAILY}, {sqltext.dense('daily', 'value')}
SELECT entity, date, COALESCE(value, 0) AS value FROM dense""")
def t1_fill(t):
    return repair.densify(_series(t), ["entity"], fill=0.0)


@query("t2_densify_grid", f"""WITH {inputs.DAILY}
SELECT e.entity, d.date, COALESCE(x.n, 0) AS n FROM (SELECT DISTINCT entity FROM daily) e
CROSS JOIN (SELECT DISTINCT date FROM daily) d LEFT JOIN daily x ON x.entity = e.entity AND x.date = d.date""")
def t2(t):
    return repair.densify_grid(inputs.daily(t).select("entity", "date", "n"), ["entity"])


@query("t3_interpolate_inside", f"""WITH {inputs.CUMULATIVE}, {sqltext.dense('cum', 'value')}, {sqltext.interpolated('dense', 'value')}
SELECT entity, date, round(value, 4) AS value FROM filled""")
def t3(t):
    dense = repair.densify(inputs.cumulative(t), ["entity"])
    return repair.interpolate(dense, ["entity"]).withColumn("value", F.round("value", 4))


@query("t3_interpolate_extend", f"""WITH {inputs.CUMULATIVE}, {sqltext.dense('cum', 'value')}, {sqltext.interpolated('dense', 'value')}
SELECT entity, date, round(COALESCE(value, pv), 4) AS value FROM filled""")
def t3_extend(t):
    dense = repair.densify(inputs.cumulative(t), ["entity"])
    return repair.interpolate(dense, ["entity"], inside=False).withColumn("value", F.round("value", 4))


@query("t4_dip_removal", f"WITH {inputs.CUMULATIVE}, {sqltext.undipped('cum', 'value')} SELECT * FROM undipped")
def t4(t):
    return repair.remove_dips(inputs.cumulative(t), ["entity"])


C2D = f"""{inputs.CUMULATIVE}, {sqltext.undipped('cum', 'value')}, {sqltext.dense('undipped', 'value')},
{sqltext.interpolated('dense', 'value')}"""


@query("t5_cumulative_to_daily", f"""WITH {C2D}
SELECT entity, date, round(value, 4) AS value, round(value - LAG(value) OVER ({W}), 4) AS value_daily FROM filled""")
def t5(t):
    out = repair.cumulative_to_daily(inputs.cumulative(t), ["entity"], keep=True)
    return out.select("entity", "date", F.round("value", 4).alias("value"), F.round("value_daily", 4).alias("value_daily"))


@query("t6_weekly_to_daily", f"""WITH {inputs.WEEKLY}, {sqltext.dense('weekly', 'value')}
SELECT entity, date, round(MIN(value / 7) OVER ({W} RANGE BETWEEN CURRENT ROW AND INTERVAL 6 DAYS FOLLOWING), 6) AS value FROM dense""")
def t6(t):
    return repair.weekly_to_daily(inputs.weekly(t), ["entity"]).withColumn("value", r6("value"))


@query("t7_daily_to_cumulative", f"""WITH {inputs.DAILY}, {sqltext.dense('daily', 'value')}
SELECT entity, date, SUM(COALESCE(value, 0)) OVER ({W}) AS "value Cum" FROM dense""")
def t7(t):
    return repair.daily_to_cumulative(_series(t), ["entity"])


@query("t8_fill_gaps", f"""WITH {inputs.CUMULATIVE},
b AS (SELECT entity, date, cum.value AS total, daily.value FROM cum JOIN daily USING (entity, date)),
{sqltext.dense('b', 'total, value')},
inner_days AS (SELECT d.* FROM dense d JOIN dense_span s ON s.entity = d.entity WHERE d.date > lo AND d.date < hi),
{sqltext.undipped('inner_days', 'total')},
{sqltext.interpolated('undipped', 'total', out='f1')},
f2_in AS (SELECT entity, date, total, value FROM f1),
{sqltext.interpolated('f2_in', 'value', out='f2')}
SELECT entity, date, round(value, 4) AS value, round(total, 4) AS total FROM f2 WHERE total IS NOT NULL OR value IS NOT NULL""")
def t8(t):
    both = inputs.cumulative(t).withColumnRenamed("value", "total").join(_series(t), ["entity", "date"])
    out = repair.fill_gaps(both, ["entity"], "date", ["value"], ["total"])
    return out.select("entity", "date", F.round("value", 4).alias("value"), F.round("total", 4).alias("total"))


@query("t9_rebuild_cumulative", f"""WITH {inputs.DAILY},
e AS (SELECT entity, SUM(value) + 1000 AS closing FROM daily GROUP BY 1)
SELECT entity, date, closing - COALESCE(SUM(value) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS total
FROM daily JOIN e USING (entity)""")
def t9(t):
    daily = _series(t)
    closing = daily.groupBy("entity").agg((F.sum("value") + 1000).alias("closing"))
    return repair.rebuild_cumulative(daily.join(closing, "entity"), ["entity"], "date", "value", "closing", "total").select(
        "entity", "date", "total")


@query("t10_falling_points", f"""WITH {inputs.CUMULATIVE},
v AS (SELECT * FROM cum WHERE value IS NOT NULL),
f AS (SELECT *, COALESCE(value < LAG(value) OVER ({W}), false) AS falls, COALESCE(value > LEAD(value) OVER ({W}), false) AS above_next FROM v)
SELECT entity, date, value, falls, above_next FROM f WHERE falls OR above_next""")
def t10(t):
    valid = inputs.cumulative(t).filter("value IS NOT NULL")
    return repair.falling_points(valid, ["entity"]).filter("falls OR above_next")


@query("t11_ratchet", f"""WITH {inputs.CUMULATIVE}
SELECT entity, date, CASE WHEN value IS NOT NULL THEN MAX(value) OVER ({W}) END AS value FROM cum""")
def t11(t):
    return repair.ratchet(inputs.cumulative(t), ["entity"])


@query("t12_moving_average", f"""WITH {inputs.DAILY}, {sqltext.dense('daily', 'value')}
SELECT entity, date,
  round(CASE WHEN COUNT(value) OVER a >= 1 THEN AVG(value) OVER a END, 4) AS trailing7,
  round(CASE WHEN COUNT(value) OVER b >= 3 THEN AVG(value) OVER b END, 4) AS centred7,
  round(CASE WHEN COUNT(value) OVER c >= 7 THEN AVG(value) OVER c END, 4) AS centred14
FROM dense WINDOW a AS ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), b AS ({W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
  c AS ({W} ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)""")
def t12(t):
    d = repair.densify(_series(t), ["entity"])
    k = ["entity"]
    return d.select(
        "entity", "date",
        F.round(windows.rolling("value", windows.frame(k, "date", 7), 1), 4).alias("trailing7"),
        F.round(windows.rolling("value", windows.frame(k, "date", 7, True), 3), 4).alias("centred7"),
        F.round(windows.rolling("value", windows.frame(k, "date", 14, True), 7), 4).alias("centred14"))


@query("t13_calendar_rolling", f"""WITH {inputs.DAILY},
r AS (SELECT entity, date, AVG(value) OVER a AS m, MEDIAN(value) OVER a AS med, MIN(value) OVER a AS lo, MAX(value) OVER a AS hi
  FROM daily WINDOW a AS ({W} RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))
SELECT entity, date, round(LEAD(m, 6) OVER ({W}), 4) AS value_mean, round(LEAD(med, 6) OVER ({W}), 4) AS value_median,
  LEAD(lo, 6) OVER ({W}) AS value_min, LEAD(hi, 6) OVER ({W}) AS value_max FROM r""")
def t13(t):
    out = windows.calendar_rolling(_series(t), ["entity"], days=7, shift=6)
    return out.select("entity", "date", F.round("value_mean", 4).alias("value_mean"),
                      F.round("value_median", 4).alias("value_median"), "value_min", "value_max")


@query("t14_change_ratio", f"""WITH {inputs.NATIONAL}, n2 AS (SELECT 'all' AS entity, * FROM nat), {sqltext.dense('n2', 'value', out='d')},
{sqltext.interpolated('d', 'value')},
a AS (SELECT date, CASE WHEN COUNT(value) OVER w >= 14 THEN AVG(value) OVER w END AS avg14 FROM filled
  WINDOW w AS (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT date, round(avg14, 6) AS avg14, round((avg14 - LAG(avg14, 14) OVER (ORDER BY date)) / NULLIF(LAG(avg14, 14) OVER (ORDER BY date), 0) * 100, 5) AS change FROM a""")
def t14(t):
    nat = inputs.national(t).select(F.lit("all").alias("entity"), "date", "value")
    full = repair.interpolate(repair.densify(nat, ["entity"]), ["entity"])
    return windows.change_ratio(full, ["entity"]).select(
        "date", r6("value_avg").alias("avg14"), F.round("change", 5).alias("change"))


@query("t15_half_slope", f"""WITH {inputs.DAILY}, {sqltext.dense('daily', 'n')},
l AS (SELECT entity, date, list(n) OVER w AS items, COUNT(n) OVER w AS c FROM dense
  WINDOW w AS ({W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT entity, date,
  round(CASE WHEN c >= 3 THEN CAST(items[CAST(ceil(len(items) / 2) AS INTEGER) + 1] - items[1] AS DOUBLE) / len(items) END, 6) AS slope FROM l""")
def t15(t):
    d = repair.densify(inputs.daily(t).select("entity", "date", "n"), ["entity"])
    return d.select("entity", "date", r6(windows.half_slope("n", ["entity"], "date", 7)).alias("slope"))


@query("t16_fitted_slope", f"""WITH {inputs.DAILY},
r AS (SELECT *, row_number() OVER ({W}) AS rn FROM daily)
SELECT entity, date, round(CASE WHEN COUNT(n) OVER w >= 7 THEN regr_slope(n, rn) OVER w END, 5) AS slope
FROM r WINDOW w AS ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def t16(t):
    d = inputs.daily(t).select("entity", "date", F.col("n").cast("double").alias("n"))
    return windows.fitted_slope(d, ["entity"], value="n").select("entity", "date", F.round("slope", 5).alias("slope"))


@query("t17_running_from_anchor", f"""WITH {inputs.DAILY}
SELECT entity, date, value, SUM(value) OVER ({W}) AS value_cum FROM daily WHERE date >= DATE '1999-04-01'""")
def t17(t):
    return windows.running_from(_series(t), ["entity"], "date", "value", "1999-04-01")


@query("t18_periodic_from_cumulative", f"""WITH {inputs.CUMULATIVE}, {sqltext.dense('cum', 'value')}, {sqltext.interpolated('dense', 'value')}
SELECT entity, date, round(NULLIF(value - LAG(value) OVER ({W}), 0), 4) AS value FROM filled""")
def t18(t):
    return repair.periodic_from_cumulative(inputs.cumulative(t), ["entity"]).withColumn("value", F.round("value", 4))


@query("t19_percent_of_peak", f"""WITH {inputs.DAILY},
s AS (SELECT *, CASE WHEN COUNT(value) OVER w >= 7 THEN AVG(value) OVER w END AS ma FROM daily
  WINDOW w AS ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT entity, date, value, round(value / NULLIF(MAX(ma) OVER (PARTITION BY entity), 0) * 100, 5) AS of_peak FROM s""")
def t19(t):
    return windows.percent_of_peak(_series(t), ["entity"]).withColumn("of_peak", F.round("of_peak", 5))


@query("t20_drop_incomplete_tail", f"""WITH {inputs.CUMULATIVE},
r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date DESC) AS rn FROM cum)
SELECT entity, date, value FROM r WHERE rn > 30 OR value IS NOT NULL""")
def t20(t):
    return repair.drop_incomplete_tail(inputs.cumulative(t), ["entity"], "date", ["value"], 30)


@query("t20_cut_after_last_valid", f"""WITH {inputs.DAILY},
g AS (SELECT entity, date, CASE WHEN n >= 2 THEN value END AS value FROM daily)
SELECT entity, date, value FROM g QUALIFY date <= MAX(CASE WHEN value IS NOT NULL THEN date END) OVER (PARTITION BY entity)""")
def t20_cut(t):
    df = inputs.daily(t).select("entity", "date", F.when(F.col("n") >= 2, F.col("value")).alias("value"))
    return repair.cut_after_last_valid(df, ["entity"], "date", "value")


@query("t20_complete_dates", f"""WITH {inputs.DAILY},
reg AS (SELECT region, date, SUM(value) AS value FROM daily GROUP BY 1, 2)
SELECT region, date, value FROM reg WHERE date IN (SELECT date FROM reg WHERE value IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT region) = 5)""")
def t20_complete(t):
    reg = inputs.daily(t).groupBy("region", "date").agg(F.sum("value").alias("value"))
    return repair.complete_dates(reg, "region", "date", "value", 5).select("region", "date", "value")


@query("t21_last_valid", f"""WITH {inputs.CUMULATIVE}
SELECT entity, arg_max(value, date) AS value, MAX(date) AS value_date FROM cum WHERE value IS NOT NULL GROUP BY 1""")
def t21(t):
    return repair.last_valid(inputs.cumulative(t), ["entity"])


@query("t22_rank_change", f"""WITH {inputs.DAILY},
r AS (SELECT entity, date, n, rank() OVER (PARTITION BY date ORDER BY n) + (COUNT(*) OVER (PARTITION BY date, n) - 1) / 2 AS rank FROM daily)
SELECT entity, date, n, CAST(rank AS DOUBLE) AS rank, CAST(rank - LAG(rank, 4) OVER ({W}) AS DOUBLE) AS rank_change FROM r""")
def t22(t):
    df = inputs.daily(t).select("entity", "date", "n")
    return windows.rank_change(df, "entity", "date", "n", 4, width=1000).select(
        "entity", "date", "n", F.col("rank").cast("double").alias("rank"), F.col("rank_change").cast("double").alias("rank_change"))


@query("t23_interval_rate", f"""WITH {inputs.WEEKLY},
i AS (SELECT entity, date - 6 AS start, date AS stop, value FROM weekly),
r AS (SELECT entity, stop AS date, value / (stop - start) AS value FROM i),
{sqltext.dense('r', 'value')}, {sqltext.interpolated('dense', 'value')}
SELECT entity, date, round(value, 4) AS value FROM filled""")
def t23(t):
    spans = inputs.weekly(t).select("entity", F.date_sub("date", 6).alias("start"), F.col("date").alias("stop"), "value")
    return repair.interval_rate(spans, ["entity"], "start", "stop", "value").withColumn("value", F.round("value", 4))


@query("t24_forward_fill", f"""WITH {inputs.CUMULATIVE}
SELECT entity, date, last_value(value IGNORE NULLS) OVER ({W}) AS value FROM cum""")
def t24(t):
    return repair.forward_fill(inputs.cumulative(t), ["entity"])
