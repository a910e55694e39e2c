"""Ready-to-plot breakdowns by age, place, risk and group: cases, tests, deaths, excess and vaccination."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.functions.calendar import week_bucket
from epitide.functions.scalar import ratio
from epitide.operators import breakdown, epi, forecast, merge, rank, repair, reshape, windows
from epitide.plans import inputs, sqltext
from epitide.plans import metric_queries as mq
from epitide.plans.inputs import r6
from epitide.plans.mart_queries import rounded
from epitide.plans.registry import query
from epitide.plans.reshape_queries import DECADES, _band_sql
from epitide.sources.stage import settle

W, CENTRE7 = mq.W, mq.CENTRE7

# ---- cases ------------------------------------------------------------------------------------

# Fixed example: order priorities stand for risks, the last one is not known.
RISKS = {"1-URGENT": "Contact", "2-HIGH": "Community", "3-MEDIUM": "Work", "4-NOT SPECIFIED": None, "5-LOW": "Travel"}
_RISK_SQL = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RISKS.items() if v) + " END"


def risk():
    return F.coalesce(*[F.when(F.col("type") == k, F.lit(v)) for k, v in RISKS.items() if v])


_DIMENSIONS_SQL = {"age": _band_sql("age", DECADES), "symptoms": "status", "nationality": "entity", "patient type": "type", "job": "segment", "risk": _RISK_SQL}


@query("mart_case_breakdowns", f"""WITH {inputs.PLACED}, raw AS ({' UNION ALL '.join(f"SELECT '{d}' AS dimension, COALESCE({c}, 'Unknown') AS category, date, COUNT(*) AS n FROM placed GROUP BY ALL" for d, c in _DIMENSIONS_SQL.items())}),
c0 AS (SELECT * FROM raw WHERE NOT (dimension = 'nationality' AND category = 'NATION_0')),
best AS (SELECT category FROM c0 WHERE dimension = 'nationality' GROUP BY 1 ORDER BY SUM(n) DESC, category LIMIT 5),
c AS (SELECT dimension, CASE WHEN dimension <> 'nationality' OR category IN (SELECT category FROM best) THEN category ELSE 'Others' END AS category, date, SUM(n) AS n FROM c0 GROUP BY ALL),
g AS (SELECT k.dimension, k.category, d.date, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM (SELECT DISTINCT dimension, category FROM c) k CROSS JOIN (SELECT DISTINCT date FROM c) d
  LEFT JOIN c ON c.dimension = k.dimension AND c.category = k.category AND c.date = d.date),
m AS (SELECT *, CASE WHEN COUNT(n) OVER w >= 3 THEN AVG(n) OVER w END AS ma FROM g WINDOW w AS (PARTITION BY dimension, category ORDER BY date {CENTRE7}))
SELECT dimension, category, date, n, round(ma, 6) AS smooth, round(ma / NULLIF(SUM(ma) OVER (PARTITION BY dimension, date), 0) * 100, 6) AS share FROM m""")
def case_breakdowns(t):
    """Cases by age, symptoms, nationality (five most frequent, one's own left out), patient type, job and risk, from one scan."""
    dimensions = {"age": reshape.band("age", DECADES), "symptoms": F.col("status"), "nationality": F.col("entity"), "patient type": F.col("type"),
                  "job": F.col("segment"), "risk": risk()}
    counts = breakdown.breakdowns(inputs.placed_orders(t), "date", dimensions)
    few = breakdown.lumped(counts, {"nationality": 5}, leave_out={"nationality": ["NATION_0"]})
    return breakdown.shares_over_time(few, "date").select("dimension", "category", "date", "n", r6("n_ma").alias("smooth"), r6("share").alias("share"))


def per_100k(k, d):
    return ratio("n", "population", 100000)


def _sized(t):
    return mq.grid(t).join(inputs.places(t).select("entity", "population"), "entity")


def _grouped_sql(top: str, n: int, shown: str = "n / NULLIF(population, 0) * 100000", panel: str = "grid", rest: bool = True) -> str:
    """CTE `shown`: the groups of `top` (entity, position) and the rest, in the form of a top-n report."""
    return f"""shown AS (SELECT date, grp AS "group", position, round({shown}, 5) AS shown FROM (
  SELECT COALESCE(top.entity, 'Rest') AS grp, CAST(COALESCE(position, {n + 1}) AS INTEGER) AS position, date, SUM(n) AS n, SUM(population) AS population
  FROM {panel} p JOIN places USING (entity) {'LEFT' if rest else ''} JOIN {top} top ON top.entity = p.entity GROUP BY ALL))"""


@query("mart_cases_trending_down", f"""WITH {mq.GRID}, {inputs.PLACES}, {mq._SLOPE}, s AS (SELECT entity, date, 1 / NULLIF(slope, 0) AS m FROM slope),
l AS (SELECT entity, MAX(date) AS d, arg_max(m, date) AS m FROM s WHERE m IS NOT NULL GROUP BY 1),
best AS (SELECT entity, row_number() OVER (ORDER BY m DESC, entity) AS position FROM l WHERE d = (SELECT MAX(d) FROM l) QUALIFY position <= 7), {_grouped_sql('best', 7)}
SELECT * FROM shown""")
def cases_trending_down(t):
    top = rank.top_groups(_sized(t), windows.decreasing("n", 7), ["n", "population"], 7, value=per_100k)
    return top.withColumn("shown", F.round("shown", 5))


@query("mart_cases_top_places", f"""WITH {mq.GRID}, {inputs.PLACES}, z AS (SELECT entity, n, n / NULLIF(population, 0) * 100000 AS m FROM grid JOIN places USING (entity) WHERE date = (SELECT MAX(date) FROM grid)),
best AS (SELECT entity, row_number() OVER (ORDER BY m DESC, entity) AS position FROM z WHERE m IS NOT NULL QUALIFY position <= 7), {_grouped_sql('best', 7)},
most AS (SELECT entity, row_number() OVER (ORDER BY n DESC, entity) AS position FROM z QUALIFY position <= 10), {_grouped_sql('most', 10, 'n', rest=False).replace('shown AS (SELECT date', 'whole AS (SELECT date', 1)}
SELECT 'per 100k' AS kind, * FROM shown UNION ALL SELECT 'cases', * FROM whole""")
def cases_top_places(t):
    """The places with the highest figures on the last day, per head with the rest, and in whole numbers without."""
    panel = settle(_sized(t), "panel")
    heads = rank.top_groups(panel, per_100k, ["n", "population"], 7).withColumn("kind", F.lit("per 100k"))
    whole = rank.top_groups(panel, lambda k, d: F.col("n").cast("double"), "n", 10, other=None).withColumn("kind", F.lit("cases"))
    return heads.unionByName(whole).withColumn("shown", F.round("shown", 5))


def _by_risk_sql() -> str:
    parts, ctes = [], []
    for i, name in enumerate(v for v in RISKS.values() if v):
        ctes.append(f"""g{i} AS (SELECT e.entity, d.date, COALESCE(x.n, 0) AS n FROM (SELECT DISTINCT entity FROM rk) e CROSS JOIN (SELECT DISTINCT date FROM rk) d LEFT JOIN (SELECT * FROM rk WHERE risk = '{name}') x ON x.entity = e.entity AND x.date = d.date),
sl{i} AS (SELECT entity, date, n, list(n) OVER w AS items, COUNT(n) OVER w AS c FROM g{i} WINDOW w AS ({W} {CENTRE7})),
b{i} AS (SELECT entity, row_number() OVER (ORDER BY CAST(items[CAST(ceil(len(items) / 2) AS INTEGER) + 1] - items[1] AS DOUBLE) / len(items) DESC, entity) AS position FROM sl{i} WHERE c >= 3 AND date = (SELECT MAX(date) FROM rk) QUALIFY position <= 3),
{_grouped_sql(f'b{i}', 3, panel=f'g{i}').replace('shown AS (SELECT date', f's{i} AS (SELECT date', 1)}""")
        parts.append(f"SELECT '{name}' AS risk, * FROM s{i}")
    return f"WITH {inputs.PLACED}, {inputs.PLACES}, rk AS (SELECT entity, {_RISK_SQL} AS risk, date, COUNT(*) AS n FROM placed GROUP BY ALL), {', '.join(ctes)} {' UNION ALL '.join(parts)}"


@query("mart_risks_trending_up", _by_risk_sql())
def risks_trending_up(t):
    """Per risk, the three places where it rises fastest and the rest; the facts are read once."""
    counts = inputs.placed_orders(t).groupBy("entity", "date").agg(*[F.count_if(risk() == v).alias(v) for v in RISKS.values() if v])
    panel = settle(repair.densify_grid(counts, ["entity"], fill=0).join(inputs.places(t).select("entity", "population"), "entity"), "risks")
    out = None
    for v in (v for v in RISKS.values() if v):
        own = panel.select("entity", "date", F.col(v).alias("n"), "population")
        top = rank.top_groups(own, windows.increasing("n", 7), ["n", "population"], 3, value=per_100k).withColumn("risk", F.lit(v))
        out = top if out is None else out.unionByName(top)
    return out.withColumn("shown", F.round("shown", 5))


# ---- tests ------------------------------------------------------------------------------------

_DISTRICT = f"""{inputs.PLACED}, wk AS (SELECT region, date + CAST(6 - dayofweek(date) AS INTEGER) AS date, COUNT(*) AS tests, COUNT(*) FILTER (status = 'F') AS pos, COUNT(*) FILTER (type <> '5-LOW') AS cases FROM placed GROUP BY 1, 2),
k AS (SELECT region AS entity, unnest(['tests', 'pos', 'cases']) AS metric, date, unnest([tests, pos, cases]) / 6 AS value FROM wk),
{sqltext.dense('k', 'value', keys='entity, metric')}, {sqltext.interpolated('dense', 'value', keys='entity, metric')},
d AS (SELECT entity AS region, date, MAX(value) FILTER (metric = 'tests') AS tests, MAX(value) FILTER (metric = 'pos') AS pos, MAX(value) FILTER (metric = 'cases') AS cases FROM filled GROUP BY 1, 2)"""


@query("mart_positivity_by_district", f"""WITH {_DISTRICT}, r AS (SELECT *, pos / NULLIF(tests, 0) * 100 AS rate, SUM(pos) OVER x / NULLIF(SUM(tests) OVER x, 0) * 100 AS whole FROM d WINDOW x AS (PARTITION BY date))
SELECT region, date, round(tests, 6) AS tests, round(pos, 6) AS pos, round(rate, 6) AS positivity, round(rate / NULLIF(SUM(rate) OVER (PARTITION BY date), 0) * whole, 6) AS part,
  round(cases - pos, 6) AS cases_minus_pos, round(cases / NULLIF(tests, 0) * 100, 6) AS cases_per_test FROM r""")
def positivity_by_district(t):
    """Weekly tests, positives and cases of districts per day; positivity, its part of the whole, and cases beyond the positives."""
    weekly = inputs.placed_orders(t).groupBy(F.col("region"), week_bucket("date").alias("stop")).agg(
        F.count("*").alias("tests"), F.count_if(F.col("status") == "F").alias("pos"), F.count_if(F.col("type") != "5-LOW").alias("cases"))
    long = weekly.unpivot(["region", "stop"], ["tests", "pos", "cases"], "metric", "value").withColumn("start", F.date_sub("stop", 6))
    daily = repair.interval_rate(long, ["region", "metric"], "start", "stop", "value").groupBy("region", "date").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in ("tests", "pos", "cases")])
    rated = settle(daily.withColumn("rate", ratio("pos", "tests", 100)), "rates")
    whole = rated.groupBy("date").agg(ratio(F.sum("pos"), F.sum("tests"), 100).alias("whole"), F.sum("rate").alias("rates"))
    return rated.join(whole, "date").select(
        "region", "date", r6("tests").alias("tests"), r6("pos").alias("pos"), r6("rate").alias("positivity"),
        r6(ratio("rate", "rates") * F.col("whole")).alias("part"), r6(F.col("cases") - F.col("pos")).alias("cases_minus_pos"),
        r6(ratio("cases", "tests", 100)).alias("cases_per_test"))


@query("mart_positivity_ranking", f"""WITH {inputs.PLACED}, r AS (SELECT entity, CAST(date_trunc('month', date) AS DATE) AS date, NULLIF(COUNT(*) FILTER (status = 'F') / COUNT(*) * 100, 0) AS rate FROM placed GROUP BY 1, 2),
l AS (SELECT entity, MAX(date) AS d, arg_max(rate, date) AS rate FROM r WHERE rate IS NOT NULL GROUP BY 1), z AS (SELECT * FROM l WHERE d = (SELECT MAX(d) FROM l)),
k AS (SELECT entity, 'top' AS side, row_number() OVER (ORDER BY rate DESC, entity) AS position FROM z UNION ALL SELECT entity, 'low', row_number() OVER (ORDER BY rate, entity) FROM z)
SELECT side, r.date, entity AS "group", CAST(position AS INTEGER) AS position, round(rate, 6) AS shown FROM k JOIN r USING (entity) WHERE position <= 5""")
def positivity_ranking(t):
    """Places with the highest and the lowest share of positives in the last month; months without positives are unknown."""
    rates = inputs.placed_orders(t).groupBy("entity", F.trunc("date", "month").alias("date")).agg(
        F.nullif(F.count_if(F.col("status") == "F") / F.count("*") * 100, F.lit(0.0)).alias("rate"))
    rates = settle(rates, "rates")
    sides = [rank.top_groups(rates, lambda k, d: F.col("rate"), "rate", 5, other=None, largest=x).withColumn("side", F.lit(s)) for x, s in ((True, "top"), (False, "low"))]
    return rounded(sides[0].unionByName(sides[1]), "shown")


# ---- deaths -----------------------------------------------------------------------------------

@query("mart_fatality_by_age", f"""WITH {inputs.PLACED}, b AS (SELECT {_band_sql('age', mq._CUBE_BANDS)} AS band, date, COUNT(*) AS cases, COUNT(*) FILTER (status = 'F') AS deaths FROM placed GROUP BY 1, 2 HAVING band IS NOT NULL),
g AS (SELECT e.band, d.date, COALESCE(cases, 0) AS cases, COALESCE(deaths, 0) AS deaths FROM (SELECT DISTINCT band FROM b) e CROSS JOIN (SELECT DISTINCT date FROM b) d LEFT JOIN b ON b.band = e.band AND b.date = d.date),
l AS (SELECT *, LAG(cases, 17) OVER (PARTITION BY band ORDER BY date) AS lc FROM g)
SELECT band, date, round(CASE WHEN COUNT(deaths) OVER w >= 90 THEN AVG(deaths) OVER w END / NULLIF(CASE WHEN COUNT(lc) OVER w >= 90 THEN AVG(lc) OVER w END, 0) * 100, 6) AS cfr
FROM l WINDOW w AS (PARTITION BY band ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)""")
def fatality_by_age(t):
    banded = inputs.placed_orders(t).groupBy(reshape.band("age", mq._CUBE_BANDS).alias("band"), "date").agg(
        F.count("*").alias("cases"), F.count_if(F.col("status") == "F").alias("deaths")).filter("band IS NOT NULL")
    cfr = epi.fatality_ratio(repair.densify_grid(banded, ["band"]), ["band"], "date", "deaths", "cases")
    return cfr.select("band", "date", r6("cfr").alias("cfr"))


_LAST90 = "ROWS BETWEEN 89 PRECEDING AND CURRENT ROW"


@query("mart_fatality_cfr_ifr", f"""WITH {inputs.PLACED}, c AS (SELECT date, COUNT(*) FILTER (status <> 'P') AS cases, COUNT(*) AS every, COUNT(*) FILTER (status = 'F') AS deaths FROM placed GROUP BY 1),
l AS (SELECT *, LAG(cases, 17) OVER (ORDER BY date) AS lc, LAG(every, 17) OVER (ORDER BY date) AS le FROM c), i AS (SELECT CAST(l_shipdate AS DATE) AS date, AVG(l_discount) * 100 AS ifr FROM lineitem GROUP BY 1)
SELECT l.date, round(CASE WHEN COUNT(deaths) OVER w >= 90 THEN AVG(deaths) OVER w END / NULLIF(CASE WHEN COUNT(lc) OVER w >= 90 THEN AVG(lc) OVER w END, 0) * 100, 6) AS cfr,
  round(CASE WHEN COUNT(deaths) OVER w >= 90 THEN AVG(deaths) OVER w END / NULLIF(CASE WHEN COUNT(le) OVER w >= 90 THEN AVG(le) OVER w END, 0) * 100, 6) AS cfr_with_self_tests, round(ifr, 6) AS ifr
FROM l LEFT JOIN i ON i.date = l.date WINDOW w AS (ORDER BY l.date {_LAST90})""")
def fatality_cfr_ifr(t):
    """Deaths against known cases, against cases with those that were only self-tested, and a model's infection fatality."""
    s = F.col("status")
    days = inputs.placed_orders(t).groupBy(F.lit("all").alias("entity"), "date").agg(
        F.count_if(s != "P").alias("cases"), F.count("*").alias("every"), F.count_if(s == "F").alias("deaths"))
    both = epi.fatality_ratio(epi.fatality_ratio(days, ["entity"], "date", "deaths", "cases"), ["entity"], "date", "deaths", "every", "cfr_with_self_tests")
    model = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg((F.avg("l_discount") * 100).alias("ifr"))
    return rounded(both.join(model, "date", "left").select("date", "cfr", "cfr_with_self_tests", "ifr"), "cfr", "cfr_with_self_tests", "ifr")


@query("mart_death_conditions", f"""WITH {inputs.PLACED}, p AS (SELECT * FROM placed WHERE status = 'F'), c AS (SELECT segment AS condition, date, COUNT(*) AS n FROM p GROUP BY 1, 2), a AS (SELECT date, COUNT(*) AS deaths, COUNT(*) FILTER (age >= 60) AS old FROM p GROUP BY 1),
x AS (SELECT condition, date, n FROM c UNION ALL SELECT 'Aged 60+', date, old FROM a),
g AS (SELECT k.condition, a.date, COALESCE(x.n, 0) / NULLIF(a.deaths, 0) * 100 AS share FROM (SELECT DISTINCT condition FROM x) k CROSS JOIN a LEFT JOIN x ON x.condition = k.condition AND x.date = a.date),
r AS (SELECT condition, AVG(share) AS recent FROM g WHERE date >= (SELECT MIN(date) FROM (SELECT DISTINCT date FROM g ORDER BY date DESC LIMIT 50)) GROUP BY 1)
SELECT g.condition, g.date, round(share, 6) AS share, round(CASE WHEN COUNT(share) OVER w >= 14 THEN AVG(share) OVER w END, 6) AS smooth, round(recent, 6) AS recent_mean FROM g JOIN r USING (condition)
WINDOW w AS (PARTITION BY g.condition ORDER BY g.date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""")
def death_conditions(t):
    """Percent of the deaths of a day with each condition, and what to order the legend by."""
    dead = inputs.placed_orders(t).filter("status = 'F'")
    kinds = [r[0] for r in t.customer.select("c_mktsegment").distinct().limit(1000).collect()]  # the columns of the report
    days = dead.groupBy("date").agg(F.count("*").alias("deaths"), *[F.count_if(F.col("segment") == k).alias(k) for k in kinds], F.count_if(F.col("age") >= 60).alias("Aged 60+"))
    every = [*kinds, "Aged 60+"]
    long = days.select("date", *[ratio(k, "deaths", 100).alias(k) for k in every]).unpivot(["date"], every, "condition", "share")
    known = settle(long, "conditions")
    seen = known.groupBy("condition").agg(F.max("share").alias("_s")).filter("_s > 0").select("condition")
    recent = rank.recent_mean_order(known, "condition", "date", "share", 50)
    smooth = windows.moving_average(known.join(seen, "condition"), ["condition"], values="share", n=14)
    return rounded(smooth.join(recent, "condition").select("condition", "date", "share", F.col("share_ma").alias("smooth"), "recent_mean"), "share", "smooth", "recent_mean")


@query("mart_deaths_unvaccinated", f"""WITH {inputs.PLACED}, d AS (SELECT date, COUNT(*) AS deaths, COUNT(*) FILTER (segment = 'HOUSEHOLD') AS unvaccinated FROM placed WHERE status = 'F' GROUP BY 1)
SELECT date, deaths, unvaccinated, round(CASE WHEN COUNT(*) OVER w >= 3 THEN AVG(unvaccinated) OVER w END, 6) AS smooth, round(unvaccinated / deaths * 100, 6) AS share FROM d WINDOW w AS (ORDER BY date {CENTRE7})""")
def deaths_unvaccinated(t):
    days = inputs.placed_orders(t).filter("status = 'F'").groupBy(F.lit("all").alias("entity"), "date").agg(
        F.count("*").alias("deaths"), F.count_if(F.col("segment") == "HOUSEHOLD").alias("unvaccinated"))
    smooth = windows.moving_average(days, ["entity"], values="unvaccinated", n=7, min_periods=3, center=True)
    return smooth.select("date", "deaths", "unvaccinated", r6("unvaccinated_ma").alias("smooth"), r6(ratio("unvaccinated", "deaths", 100)).alias("share"))


_DEAD = f"""{inputs.PLACED}, {inputs.PLACES}, dd AS (SELECT entity, region, date, COUNT(*) FILTER (status = 'F') AS n FROM placed GROUP BY 1, 2, 3),
grid AS (SELECT e.entity, d.date, COALESCE(x.n, 0) AS n FROM (SELECT DISTINCT entity FROM dd) e CROSS JOIN (SELECT DISTINCT date FROM dd) d LEFT JOIN dd x ON x.entity = e.entity AND x.date = d.date)"""


def _dead(t):
    """Deaths of every place on every day that has any figure, and its population."""
    dead = inputs.placed_orders(t).groupBy("entity", "date").agg(F.count_if(F.col("status") == "F").alias("n"))
    return repair.densify_grid(dead, ["entity"], fill=0).join(inputs.places(t), "entity")


@query("mart_deaths_by_region", f"""WITH {_DEAD}, r AS (SELECT region, date, SUM(n) AS n, SUM(population) AS population FROM grid JOIN places USING (entity) GROUP BY 1, 2)
SELECT region, date, CAST(n AS BIGINT) AS deaths, round(n / NULLIF(population, 0) * 1000000, 4) AS per_million, round(n / NULLIF(SUM(n) OVER (PARTITION BY date), 0) * 100, 6) AS share FROM r""")
def deaths_by_region(t):
    regional = settle(_dead(t).groupBy("region", "date").agg(F.sum("n").alias("n"), F.sum("population").alias("population")), "regional")
    whole = regional.groupBy("date").agg(F.sum("n").alias("all"))
    return regional.join(whole, "date").select("region", "date", F.col("n").alias("deaths"), F.round(ratio("n", "population", 1_000_000), 4).alias("per_million"), r6(ratio("n", "all", 100)).alias("share"))


@query("mart_deaths_places", f"""WITH {_DEAD}, z AS (SELECT entity, n / NULLIF(population, 0) * 1000000 AS m FROM grid JOIN places USING (entity) WHERE date = (SELECT MAX(date) FROM grid)),
best AS (SELECT entity, row_number() OVER (ORDER BY m DESC, entity) AS position FROM z WHERE m IS NOT NULL QUALIFY position <= 7), {_grouped_sql('best', 7, 'n / NULLIF(population, 0) * 1000000')},
sl AS (SELECT entity, date, list(n) OVER w AS items, COUNT(n) OVER w AS c FROM grid WINDOW w AS ({W} ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)),
rising AS (SELECT entity, row_number() OVER (ORDER BY CAST(items[CAST(ceil(len(items) / 2) AS INTEGER) + 1] - items[1] AS DOUBLE) / len(items) DESC, entity) AS position FROM sl WHERE c >= 7 AND date = (SELECT MAX(date) FROM grid) QUALIFY position <= 7),
{_grouped_sql('rising', 7, 'n / NULLIF(population, 0) * 1000000').replace('shown AS (SELECT date', 'up AS (SELECT date', 1)}
SELECT 'top' AS kind, * FROM shown UNION ALL SELECT 'rising', * FROM up""")
def deaths_places(t):
    """Deaths per million in the places with most of them on the last day, and where they rise fastest."""
    panel = settle(_dead(t).select("entity", "date", "n", "population"), "panel")

    def million(k, d):
        return ratio("n", "population", 1_000_000)

    top = rank.top_groups(panel, million, ["n", "population"], 7).withColumn("kind", F.lit("top"))
    up = rank.top_groups(panel, windows.increasing("n", 14), ["n", "population"], 7, value=million).withColumn("kind", F.lit("rising"))
    return top.unionByName(up).withColumn("shown", F.round("shown", 5))


@query("mart_excess_by_age_and_place", f"""WITH {mq._BAND_CUBE}, {mq._excess_sql('band, region').replace('mm AS', 'mm0 AS').replace('bl AS', 'bl0 AS').replace('ex AS', 'ex0 AS').replace('FROM mm ', 'FROM mm0 mm ').replace('JOIN bl ', 'JOIN bl0 bl ')}, {mq._excess_sql('entity')}
SELECT 'age and region' AS grouping, region, NULL AS entity, band, date, deaths_month, round(p_score, 6) AS p_score, round(pre5_avg, 6) AS pre5_avg FROM ex0
UNION ALL SELECT 'place', NULL, entity, NULL, date, deaths_month, round(p_score, 6), round(pre5_avg, 6) FROM ex""")
def excess_by_age_and_place(t):
    banded = inputs.cube(t).withColumn("band", reshape.band("age", mq._CUBE_BANDS))
    out = epi.excess_over(banded, {"age and region": ["band", "region"], "place": ["entity"]}, "deaths", mq.YEARS, mq.START, mq.SHORT, mq.LONG)
    return rounded(out.select("grouping", "region", "entity", "band", "date", "deaths_month", "p_score", "pre5_avg"), "p_score", "pre5_avg")


# ---- vaccination ----------------------------------------------------------------------------------

GOAL, TARGET_DAY, AHEAD = 4.0, "2002-01-01", 30  # doses per head, the day they are to be reached, days of forecast


@query("mart_vaccination_groups", f"""WITH {inputs.PLACED}, dg AS (SELECT segment AS entity, date, COUNT(*) AS n FROM placed GROUP BY 1, 2),
cg AS (SELECT entity, date, CAST(SUM(n) OVER ({W}) AS DOUBLE) - CASE WHEN day(date) = 13 THEN 40 ELSE 0 END AS value FROM dg), {sqltext.undipped('cg', 'value')},
{sqltext.dense('undipped', 'value')}, {sqltext.interpolated('dense', 'value')}, step AS (SELECT entity, date, value, value - LAG(value) OVER ({W}) AS daily FROM filled),
nat AS (SELECT date, COUNT(*) AS given FROM placed GROUP BY 1), people AS (SELECT c_mktsegment AS entity, CAST(COUNT(*) * {GOAL} AS DOUBLE) AS goal FROM customer GROUP BY 1),
own AS (SELECT s.entity, s.date, value, daily / NULLIF(SUM(daily) OVER (PARTITION BY s.date), 0) * given AS given FROM step s LEFT JOIN nat ON nat.date = s.date),
l AS (SELECT entity, MAX(date) AS t0, arg_max(value, date) AS v0 FROM own GROUP BY 1), b AS (SELECT l.*, (v0 - o.value) / 14 AS rate FROM l LEFT JOIN own o ON o.entity = l.entity AND o.date = t0 - 14),
f AS (SELECT entity, t0 + CAST(i AS INTEGER) AS date, least(v0 + (i + 1) * rate, greatest(v0, goal)) AS forecast FROM b JOIN people USING (entity), range(0, {AHEAD + 1}) r(i))
SELECT entity AS "group", date, round(value, 6) AS doses, round(given, 6) AS given, round((goal - value) / NULLIF(CAST(DATE '{TARGET_DAY}' - date AS DOUBLE), 0), 6) AS target_rate, goal, round(forecast, 6) AS forecast
FROM (own FULL JOIN f USING (entity, date)) JOIN people USING (entity)""")
def vaccination_groups(t):
    """Cumulative doses by group repaired, daily doses scaled to the reported total, the rate the goal needs, and a forecast."""
    placed = settle(inputs.placed_orders(t).groupBy(F.col("segment").alias("entity"), "date").agg(F.count("*").alias("n")), "groups")
    w = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    reported = placed.select("entity", "date", (F.sum("n").over(w).cast("double") - F.when(F.dayofmonth("date") == 13, 40).otherwise(0)).alias("value"))
    level = settle(repair.interpolate(repair.densify(repair.remove_dips(reported, ["entity"]), ["entity"]), ["entity"], "date", "value"), "level")
    daily = level.withColumn("daily", F.col("value") - F.lag("value").over(Window.partitionBy("entity").orderBy("date")))
    national = placed.groupBy("date").agg(F.sum("n").alias("reported"))
    sums = daily.groupBy("date").agg(F.sum("daily").alias("_sum")).join(national, "date", "left")
    own = daily.join(sums, "date").withColumn("given", ratio("daily", "_sum") * F.col("reported"))
    goals = t.customer.groupBy(F.col("c_mktsegment").alias("entity")).agg((F.count("*") * GOAL).alias("goal"))
    now = repair.last_valid(level, ["entity"], "date", "value").select("entity", F.col("value").alias("now"))
    ahead = forecast.extrapolate(level, ["entity"], "value", AHEAD).join(now, "entity").join(goals, "entity").select(
        "entity", "date", F.least("pred", F.greatest("now", "goal")).alias("forecast"))
    both = merge.combine_first(own.select("entity", "date", "value", "given"), ahead, ["entity", "date"]).join(goals, "entity")
    needed = F.try_divide(F.col("goal") - F.col("value"), F.datediff(F.lit(TARGET_DAY).cast("date"), F.col("date")).cast("double"))
    return rounded(both.select(F.col("entity").alias("group"), "date", F.col("value").alias("doses"), "given", needed.alias("target_rate"), "goal", "forecast"),
                   "doses", "given", "target_rate", "forecast")
