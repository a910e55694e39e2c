"""Aggregation, crosstabs, banding and hierarchy roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from epitide.model import inline_table, melt
from epitide.operators import merge, reshape
from epitide.operators.ordered import exact_quantiles
from epitide.plans import inputs
from epitide.plans.inputs import r6
from epitide.plans.registry import query

# Fixed category lists of the given tables (pivot columns).
TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
EVENTS = ["click", "error", "purchase", "signup", "view"]
DECADES = [10, 20, 30, 40, 50, 60, 70]
PHASES = [15, 35, 60]


def _pivot_sql(col, values, agg, prefix="", suffix=""):
    return ", ".join(agg.format(cond=f"{col} = '{v}'") + f' AS "{prefix}{v}{suffix}"' for v in values)


@query("a1_group_statistics", f"""WITH {inputs.DAILY}
SELECT entity, SUM(value) AS sum, COUNT(value) AS count, MIN(value) AS min, MAX(value) AS max, round(AVG(value), 6) AS mean,
  arg_max(value, date) AS last, MEDIAN(value) AS median FROM daily GROUP BY 1""")
def a1(t):
    return reshape.group_stats(inputs.daily(t).select("entity", "date", "value"), ["entity"], "value", "date", width=100_000).withColumn("mean", r6("mean"))


@query("a1_exact_quantiles", """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.25) AS lower
FROM lineitem GROUP BY 1""")
def a1_quantiles(t):
    return exact_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"median": 0.5, "lower": 0.25}, width=5_000.0)


@query("a2_count_crosstab", f"""SELECT CAST(ts AS DATE) AS date, {_pivot_sql('event_type', EVENTS, 'COUNT(*) FILTER ({cond})', 'Cases ')} FROM events GROUP BY 1""")
def a2(t):
    return reshape.count_crosstab(t.events.withColumn("date", F.to_date("ts")), ["date"], "event_type", EVENTS, "Cases ")


@query("a3_value_crosstab", f"""WITH {inputs.PLACED}
SELECT date, {_pivot_sql('region', REGIONS, 'CAST(SUM(amount) FILTER ({cond}) AS BIGINT)', 'Cases Region: ')} FROM placed GROUP BY 1""")
def a3(t):
    return reshape.value_crosstab(inputs.placed_orders(t), ["date"], "region", REGIONS, "amount", "sum", "Cases Region: ")


@query("a3_mean_max_crosstab", f"""WITH {inputs.PLACED}
SELECT a.date, {', '.join(f'"mean {r}"' for r in REGIONS)}, {', '.join(f'"max {r}"' for r in REGIONS)} FROM
(SELECT date, {_pivot_sql('region', REGIONS, 'round(AVG(amount) FILTER ({cond}), 4)', 'mean ')} FROM placed GROUP BY 1) a JOIN
(SELECT date, {_pivot_sql('region', REGIONS, 'MAX(amount) FILTER ({cond})', 'max ')} FROM placed GROUP BY 1) b ON a.date = b.date""")
def a3_mean_max(t):
    placed = inputs.placed_orders(t)
    mean = reshape.value_crosstab(placed, ["date"], "region", REGIONS, "amount", "mean", "mean ")
    mean = mean.withColumns({f"mean {r}": F.round(f"mean {r}", 4) for r in REGIONS})
    return mean.join(reshape.value_crosstab(placed, ["date"], "region", REGIONS, "amount", "max", "max "), "date")


@query("a4_long_to_wide", f"""WITH {inputs.PUBLISHED}
SELECT entity, date, source, CAST(SUM(value) FILTER (metric = 'cases') AS DOUBLE) AS "value cases", CAST(SUM(value) FILTER (metric = 'value') AS DOUBLE) AS "value value"
FROM published GROUP BY 1, 2, 3""")
def a4(t):
    return reshape.wide(inputs.published(t), ["entity", "date", "source"], "metric", ["cases", "value"], ["value"])


@query("a5_complete_columns", f"""WITH {inputs.PLACED}
SELECT date, CAST(SUM(amount) FILTER (status = 'F') AS BIGINT) AS "amount F", COUNT(*) FILTER (status = 'F') AS "_f", CAST(NULL AS BIGINT) AS "amount Z", CAST(0 AS BIGINT) AS "_z" FROM placed GROUP BY 1""")
def a5(t):
    df = inputs.placed_orders(t)
    out = reshape.wide(df, ["date"], "status", ["F", "Z"], ["amount"])
    counts = reshape.count_crosstab(df, ["date"], "status", ["F", "Z"])
    return out.join(counts.withColumnsRenamed({"F": "_f", "Z": "_z"}), "date")


@query("a6_unpivot", f"""WITH {inputs.DAILY}
SELECT entity, date, 'value' AS metric, value FROM daily UNION ALL SELECT entity, date, 'n', CAST(n AS DOUBLE) FROM daily""")
def a6(t):
    return melt(inputs.daily(t), ["entity", "date"], ["value", "n"])


def _band_sql(x, edges, upper=140):
    parts = [f"WHEN {x} < {hi} THEN '{label}'" for label, hi in zip(reshape.band_labels(edges), [*edges, upper])]
    return f"CASE WHEN {x} < 0 THEN NULL " + " ".join(parts) + " END"


@query("a7_age_bands", f"""SELECT c_custkey, age, {_band_sql('age', DECADES)} AS band FROM
(SELECT c_custkey, CAST(floor(c_acctbal / 60) AS INTEGER) AS age FROM customer)""")
def a7(t):
    people = t.customer.select("c_custkey", F.floor(F.col("c_acctbal") / 60).cast("int").alias("age"))
    return people.withColumn("band", reshape.band("age", DECADES))


@query("a8_two_bandings", f"""WITH {inputs.PLACED}
SELECT date, {', '.join(f'''COUNT(*) FILTER ({_band_sql('age', DECADES)} = '{x}') AS "Age {x}"''' for x in reshape.band_labels(DECADES))},
  {', '.join(f'''COUNT(*) FILTER ({_band_sql('age', PHASES)} = '{x}') AS "Phase {x}"''' for x in reshape.band_labels(PHASES))} FROM placed GROUP BY 1""")
def a8(t):
    return reshape.two_bandings(inputs.placed_orders(t), ["date"], "age", DECADES, PHASES, ("Age ", "Phase "))


@query("a9_hierarchy_rollup", f"""WITH {inputs.DAILY}
SELECT date, region, entity, SUM(value) AS value, CAST(SUM(n) AS BIGINT) AS n, CAST(2 - GROUPING(region) - GROUPING(entity) AS INTEGER) AS level
FROM daily GROUP BY GROUPING SETS ((date), (date, region), (date, region, entity))""")
def a9(t):
    return reshape.roll_up(inputs.daily(t), "date", ["region", "entity"], ["value", "n"])


@query("a10_top_and_others", """WITH top AS (SELECT p_brand FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2') GROUP BY 1 ORDER BY COUNT(*) DESC, p_brand LIMIT 5)
SELECT p_type, CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Others' END AS p_brand, COUNT(*) AS n
FROM part WHERE p_brand <> 'Brand#1' GROUP BY 1, 2""")
def a10(t):
    return reshape.lump_others(t.part, ["p_type"], "p_brand", 5, keep=["Brand#1"], ignore=["Brand#2"])


_BANDS = [("10-19", "10-39"), ("20-29", "10-39"), ("30-39", "10-39"), ("0-9", "0-39"), ("10-19", "0-39"), ("20-29", "0-39"),
          ("30-39", "0-39"), ("40-49", "40-49")]


@query("a11_regrouped_bands", f"""WITH {inputs.PLACED}, b AS (SELECT date, {_band_sql('age', DECADES)} AS band, COUNT(*) AS n FROM placed GROUP BY 1, 2),
m(old, new) AS (VALUES {', '.join(str(x) for x in _BANDS)}),
s AS (SELECT date, new AS band, SUM(n) AS n FROM b JOIN m ON b.band = m.old GROUP BY 1, 2)
SELECT COALESCE(b.date, s.date) AS date, COALESCE(b.band, s.band) AS band, CAST(COALESCE(b.n, s.n) AS BIGINT) AS n
FROM (SELECT * FROM b WHERE band IS NOT NULL) b FULL JOIN s ON s.date = b.date AND s.band = b.band""")
def a11(t):
    counts = inputs.placed_orders(t).withColumn("band", reshape.band("age", DECADES)).filter("band IS NOT NULL").groupBy(
        "date", "band").agg(F.count("*").alias("n"))
    mapping = inline_table(t.spark, "old string, new string", _BANDS)
    return reshape.regroup_bands(counts, ["date"], "band", "n", mapping)


@query("a12_reference_range", f"""WITH {inputs.CUBE}, m AS (SELECT entity, year, month, SUM(deaths) AS deaths FROM cube WHERE year BETWEEN 1995 AND 1998 GROUP BY ALL)
SELECT entity, month, MIN(deaths) AS min, round(AVG(deaths), 6) AS mean, MAX(deaths) AS max FROM m GROUP BY 1, 2""")
def a12(t):
    years = [1995, 1996, 1997, 1998]
    monthly = reshape.value_crosstab(inputs.cube(t), ["entity", "month"], "year", years, "deaths")
    return reshape.spread(monthly, ["entity", "month"], [str(y) for y in years]).withColumn("mean", r6("mean"))


@query("a13_value_counts", """SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def a13(t):
    return t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))


_RISK = [("0-14", 0.0001), ("15-34", 0.0005), ("35-59", 0.004), ("60+", 0.04)]


@query("a14_weighted_rate", f"""WITH c AS (SELECT n_name AS entity, {_band_sql('CAST(floor(c_acctbal / 100) AS INTEGER)', PHASES)} AS band FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT entity, band, CAST(COUNT(*) AS DOUBLE) AS people FROM c WHERE band IS NOT NULL GROUP BY 1, 2), r(band, risk) AS (VALUES {', '.join(str(x) for x in _RISK)})
SELECT entity, round(SUM(people * CAST(risk AS DOUBLE)) / SUM(people), 8) AS ifr, SUM(people) AS total FROM p LEFT JOIN r USING (band) GROUP BY 1""")
def a14(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("entity"), reshape.band(F.floor(F.col("c_acctbal") / 100), PHASES).alias("band"))
    sizes = people.filter("band IS NOT NULL").groupBy("entity", "band").agg(F.count("*").cast("double").alias("people"))
    risks = inline_table(t.spark, "band string, risk double", _RISK)
    return reshape.weighted_rate(sizes, risks, ["entity"], "band", "people", "risk", "ifr").withColumn("ifr", F.round("ifr", 8))


@query("a15_type_totals_merged", f"""WITH {inputs.PLACED},
a AS (SELECT date, CAST(SUM(amount) FILTER (type = '1-URGENT') AS BIGINT) AS urgent, CAST(SUM(amount) FILTER (type = '5-LOW') AS BIGINT) AS low FROM placed WHERE status = 'F' GROUP BY 1),
b AS (SELECT date, CAST(SUM(amount) FILTER (type = '1-URGENT') AS BIGINT) AS urgent, CAST(SUM(amount) FILTER (type = '5-LOW') AS BIGINT) AS low FROM placed WHERE status = 'O' GROUP BY 1),
c AS (SELECT date, CAST(SUM(amount) FILTER (type = '1-URGENT') AS BIGINT) AS urgent, CAST(SUM(amount) FILTER (type = '5-LOW') AS BIGINT) AS low FROM placed WHERE status = 'P' GROUP BY 1)
SELECT date, COALESCE(a.urgent, b.urgent, c.urgent) AS urgent, COALESCE(a.low, b.low, c.low) AS low FROM a FULL JOIN b USING (date) FULL JOIN c USING (date)""")
def a15(t):
    def totals(status):
        part = inputs.placed_orders(t).filter(F.col("status") == status)
        return reshape.value_crosstab(part, ["date"], "type", ["1-URGENT", "5-LOW"], "amount").withColumnsRenamed(
            {"1-URGENT": "urgent", "5-LOW": "low"})
    return merge.priority_merge(merge.stack_sources(totals("F"), totals("O"), totals("P")), ["date"], ["urgent", "low"])


@query("a16_drop_duplicates", """SELECT DISTINCT l_orderkey, l_linenumber, arg_min(l_partkey, (l_shipdate, l_partkey, l_suppkey)) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_partkey FROM lineitem""")
def a16(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_suppkey")
    doubled = df.select("*", F.col("l_partkey"))
    single = reshape.drop_repeated_columns(doubled)
    return merge.latest_wins(single, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], newest=False).select(
        "l_orderkey", "l_linenumber", "l_partkey")
