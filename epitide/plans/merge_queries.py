"""Priority merges, and the flagship query that runs a panel from raw sources to regional rates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.functions.calendar import week_bucket
from epitide.functions.scalar import ratio
from epitide.model import inline_table
from epitide.operators import merge, repair
from epitide.operators.windows import moving_average
from epitide.plans import inputs, sqltext
from epitide.plans.registry import query
from epitide.sources.stage import settle


# ---- flagship ---------------------------------------------------------------------------------

FLAGSHIP_SQL = f"""WITH {inputs.PLACED}, {inputs.PLACES},
a AS (SELECT entity, date, CAST(SUM(amount) AS DOUBLE) AS value FROM placed WHERE status = 'F' GROUP BY 1, 2),
b_day AS (SELECT entity, date, CAST(SUM(amount) AS DOUBLE) AS value FROM placed WHERE status = 'O' GROUP BY 1, 2),
b_cum AS (SELECT entity, date, SUM(value) OVER (PARTITION BY entity ORDER BY date) - CASE WHEN day(date) = 13 THEN 300000 ELSE 0 END AS value FROM b_day),
{sqltext.undipped('b_cum', 'value')},
{sqltext.dense('undipped', 'value', out='bd')},
{sqltext.interpolated('bd', 'value', out='bf')},
b AS (SELECT entity, date, value - LAG(value) OVER (PARTITION BY entity ORDER BY date) AS value FROM bf),
c_week AS (SELECT entity, date + CAST(6 - dayofweek(date) AS INTEGER) AS date, CAST(SUM(amount) AS DOUBLE) AS value FROM placed WHERE status = 'P' GROUP BY 1, 2),
{sqltext.dense('c_week', 'value', out='cd')},
c AS (SELECT entity, date, MIN(value / 7) OVER (PARTITION BY entity ORDER BY date RANGE BETWEEN CURRENT ROW AND INTERVAL 6 DAYS FOLLOWING) AS value FROM cd),
merged AS (SELECT entity, date, COALESCE(a.value, b.value, c.value) AS value
  FROM a FULL JOIN b USING (entity, date) FULL JOIN c USING (entity, date)),
regional AS (SELECT region, date, SUM(value) AS value FROM merged JOIN places USING (entity) GROUP BY 1, 2),
pop AS (SELECT region, SUM(population) AS population FROM places GROUP BY 1),
ma AS (SELECT region, date, value, CASE WHEN COUNT(value) OVER w >= 3 THEN AVG(value) OVER w END AS smooth
  FROM regional WINDOW w AS (PARTITION BY region ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT region, date, round(value, 2) AS value, round(smooth, 2) AS smooth,
       round(smooth / NULLIF(population, 0) * 100000, 2) AS per_100k
FROM ma JOIN pop USING (region)"""


@query("flagship_regional_rates", FLAGSHIP_SQL)
def flagship(t):
    """Daily, cumulative and weekly sources -> repaired, merged, rolled up, smoothed, per capita.

    The facts are scanned once: what the three sources need of them is one row per place, source and day.
    """
    cells = settle(inputs.placed_orders(t).groupBy("entity", "status", "date").agg(
        F.sum("amount").cast("double").alias("value")), "cells")
    direct = cells.filter("status = 'F'").select("entity", "date", "value")
    running = F.sum("value").over(
        Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    reported = cells.filter("status = 'O'").select("entity", "date", (
        running - F.when(F.dayofmonth("date") == 13, 300000).otherwise(0)).alias("value"))
    from_cum = repair.cumulative_to_daily(reported, ["entity"], keep=False)
    weeks = (cells.filter("status = 'P'").groupBy("entity", week_bucket("date").alias("date"))
             .agg(F.sum("value").alias("value")))
    from_week = repair.weekly_to_daily(weeks, ["entity"])
    merged = merge.priority_merge(merge.stack_sources(direct, from_cum, from_week), ["entity", "date"])
    places = inputs.places(t)
    regional = merged.join(places.select("entity", "region"), "entity").groupBy("region", "date").agg(
        F.sum("value").alias("value"))
    smooth = moving_average(regional, ["region"], n=7, min_periods=3, center=True, suffix="_s")
    people = places.groupBy("region").agg(F.sum("population").alias("population"))
    return smooth.join(people, "region").select(
        "region", "date", F.round("value", 2).alias("value"), F.round("value_s", 2).alias("smooth"),
        F.round(ratio("value_s", "population", 100000), 2).alias("per_100k"))


# ---- P ------------------------------------------------------------------------------------------

PRIO = "CASE source WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"


def _prio(c="source"):
    return F.when(F.col(c) == "F", 0).when(F.col(c) == "O", 1).otherwise(2)


@query("p1_priority_merge", f"""WITH {inputs.PUBLISHED},
s AS (SELECT * FROM published)
SELECT entity, date, metric, COALESCE(f.value, o.value, p.value) AS value
FROM (SELECT * FROM s WHERE source = 'F') f
FULL JOIN (SELECT * FROM s WHERE source = 'O') o USING (entity, date, metric)
FULL JOIN (SELECT * FROM s WHERE source = 'P') p USING (entity, date, metric)""")
def p1(t):
    return merge.priority_merge(inputs.published(t), ["entity", "date", "metric"], prio=_prio(), levels=(0, 1, 2))


@query("p1_combine_first_wide", f"""WITH {inputs.PUBLISHED},
w AS (SELECT entity, date, source, MAX(CASE WHEN metric = 'value' THEN value END) AS value,
             MAX(CASE WHEN metric = 'cases' THEN value END) AS cases FROM published GROUP BY 1, 2, 3)
SELECT entity, date, COALESCE(a.value, b.value, c.value) AS value, COALESCE(a.cases, b.cases, c.cases) AS cases
FROM (SELECT * FROM w WHERE source = 'F') a FULL JOIN (SELECT * FROM w WHERE source = 'O') b USING (entity, date) FULL JOIN (SELECT * FROM w WHERE source = 'P') c USING (entity, date)""")
def p1_wide(t):
    wide = inputs.published(t).groupBy("entity", "date", "source").pivot("metric", ["value", "cases"]).agg(F.first("value"))
    a, b, c = (wide.filter(F.col("source") == s).drop("source") for s in inputs.SOURCES_IN_ORDER)
    return merge.combine_first(merge.combine_first(a, b, ["entity", "date"]), c, ["entity", "date"])


@query("p1_equal_priorities", """WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price, o_orderstatus AS status FROM orders)
SELECT o_custkey, MIN(price) AS price, arg_min(status, (price, status)) AS price_status FROM o GROUP BY 1""")
def p1_ties(t):
    """All rows of one priority: the least value and, with it, its own source."""
    rows = t.orders.select("o_custkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.lit(0).alias("prio"))
    return merge.priority_merge(rows, ["o_custkey"], "price", provenance="status")


@query("p2_merge_with_source", f"""WITH {inputs.PUBLISHED},
r AS (SELECT *, row_number() OVER (PARTITION BY entity, date, metric ORDER BY value IS NULL, {PRIO}) AS rn FROM published)
SELECT entity, date, metric, value, CASE WHEN value IS NOT NULL THEN source END AS value_source FROM r WHERE rn = 1""")
def p2(t):
    return merge.priority_merge(
        inputs.published(t), ["entity", "date", "metric"], prio=_prio(), provenance="source", levels=dict(enumerate(inputs.SOURCES_IN_ORDER)))


@query("p3_latest_file_wins", """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS date
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def p3(t):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice",
                         F.to_date("o_orderdate").alias("date"))
    return merge.latest_wins(df, ["o_custkey"], ["date", "o_orderkey"])


# Fixed overrides of the example: a day set, a known bad count put right, a day blanked.
CORRECTIONS = [
    ("1996-02-29", "n", None, 99.0, False),
    ("1997-03-01", "n", 5.0, 6.0, True),
    ("1998-07-04", "n", None, None, False),
]


@query("p4_corrections_overlay", f"""WITH {inputs.NATIONAL},
c(date, bad, new, only_bad) AS (VALUES (DATE '1996-02-29', NULL, 99.0, false), (DATE '1997-03-01', 5.0, 6.0, true),
  (DATE '1998-07-04', NULL, NULL, false))
SELECT nat.date, 'n' AS metric, CASE WHEN c.date IS NULL THEN CAST(n AS DOUBLE)
  WHEN only_bad AND CAST(n AS DOUBLE) IS DISTINCT FROM bad THEN CAST(n AS DOUBLE) ELSE CAST(new AS DOUBLE) END AS value
FROM nat LEFT JOIN c ON c.date = nat.date""")
def p4(t):
    fixes = inline_table(t.spark, "date date, metric string, bad_value double, new_value double, only_bad boolean", CORRECTIONS)
    obs = inputs.national(t).select("date", F.lit("n").alias("metric"), F.col("n").cast("double").alias("value"))
    return merge.apply_corrections(obs, fixes, ["date", "metric"])
