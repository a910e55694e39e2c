"""Ready-to-plot tables, each a composition of the operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.functions.calendar import month_end, week_bucket
from epitide.functions.scalar import clip, ratio, row_sum, subtract
from epitide.model import inline_table
from epitide.operators import alloc, epi, forecast, merge, places, rank, repair, reshape, windows
from epitide.operators.ordered import exact_quantile
from epitide.plans import inputs, sqltext
from epitide.plans import metric_queries as mq
from epitide.plans.inputs import r6
from epitide.plans.place_queries import free_text_places, gazetteer
from epitide.plans.registry import query
from epitide.plans.reshape_queries import DECADES, REGIONS, TYPES, _band_sql
from epitide.plans.source_queries import payloads
from epitide.sources import io

W = "PARTITION BY entity ORDER BY date"
CENTRE7 = mq.CENTRE7


def rounded(df, *columns):
    return df.withColumns({c: r6(c) for c in columns})


# ---- cases ------------------------------------------------------------------------------------

_KNOWN = TYPES[:4]
_MA = "CASE WHEN COUNT({0}) OVER w >= 3 THEN AVG({0}) OVER w END"


@query("mart_cases_by_type", f"""WITH {inputs.PLACED},
c AS (SELECT date, {', '.join(f'''COUNT(*) FILTER (type = '{x}') AS "{x}"''' for x in _KNOWN)}, COUNT(*) AS total FROM placed GROUP BY 1),
u AS (SELECT *, greatest(total - ({' + '.join(f'"{x}"' for x in _KNOWN)}), 0) AS unknown FROM c),
m AS (SELECT date, {', '.join(f'{_MA.format(chr(34) + x + chr(34))} AS "{x}"' for x in [*_KNOWN, 'unknown'])} FROM u WINDOW w AS (ORDER BY date {CENTRE7}))
SELECT date, {', '.join(f'round("{x}", 6) AS "{x}", round("{x}" / NULLIF({" + ".join(f"{chr(34)}{y}{chr(34)}" for y in [*_KNOWN, "unknown"])}, 0) * 100, 6) AS "{x} (%)"' for x in [*_KNOWN, 'unknown'])} FROM m""")
def cases_by_type(t):
    table = inputs.placed_orders(t).groupBy("date").agg(*[F.count_if(F.col("type") == x).alias(x) for x in _KNOWN], F.count("*").alias("total"))
    table = table.withColumn("unknown", clip(subtract("total", row_sum([F.col(f"`{x}`") for x in _KNOWN])), 0.0))
    cols = [*_KNOWN, "unknown"]
    w = windows.frame(["series"], "date", 7, True)
    ma = table.withColumn("series", F.lit("all")).select("date", *[windows.rolling(F.col(f"`{c}`"), w, 3).alias(c) for c in cols])
    whole = row_sum([F.col(f"`{c}`") for c in cols], "strict")
    out = [x for c in cols for x in (r6(F.col(f"`{c}`")).alias(c), r6(ratio(F.col(f"`{c}`"), whole, 100)).alias(f"{c} (%)"))]
    return ma.select("date", *out)


_OUTCOMES = inputs.PLACED + """,
oc AS (SELECT date, unnest(['cases', 'deaths', 'severe']) AS entity, unnest([CAST(COUNT(*) AS DOUBLE), CAST(COUNT(*) FILTER (status = 'F') AS DOUBLE), CAST(COUNT(*) FILTER (status = 'F' AND type = '1-URGENT') AS DOUBLE)]) AS value FROM placed GROUP BY date)"""


def outcomes(t):
    s = F.col("status") == "F"
    wide = inputs.placed_orders(t).groupBy("date").agg(
        F.count("*").cast("double").alias("cases"), F.count(F.when(s, 1)).cast("double").alias("deaths"),
        F.count(F.when(s & (F.col("type") == "1-URGENT"), 1)).cast("double").alias("severe"))
    return wide.unpivot(["date"], ["cases", "deaths", "severe"], "entity", "value")


@query("mart_biweekly_change", f"""WITH {_OUTCOMES}, a AS (SELECT *, CASE WHEN COUNT(value) OVER w >= 14 THEN AVG(value) OVER w END AS m FROM oc WINDOW w AS ({W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
c AS (SELECT date, entity, (m - LAG(m, 14) OVER ({W})) / NULLIF(LAG(m, 14) OVER ({W}), 0) * 100 AS x FROM a)
SELECT date, {', '.join(f"round(MAX(x) FILTER (entity = '{e}'), 6) AS {e}" for e in ('cases', 'deaths', 'severe'))} FROM c GROUP BY 1""")
def biweekly_change(t):
    change = windows.change_ratio(outcomes(t), ["entity"])
    return rounded(reshape.value_crosstab(change, ["date"], "entity", ["cases", "deaths", "severe"], "change", "max"), "cases", "deaths", "severe")


@query("mart_mobility_and_cases", f"""WITH {inputs.NATIONAL}, m AS (SELECT *, CASE WHEN COUNT(n) OVER w >= 7 THEN AVG(n) OVER w END AS ma FROM nat WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
p AS (SELECT date, n / NULLIF((SELECT MAX(ma) FROM m), 0) * 100 AS peak FROM m), q AS (SELECT CAST(l_shipdate AS DATE) AS date, AVG(l_quantity) AS mob FROM lineitem GROUP BY 1),
b AS (SELECT MIN(mob) AS lo, MAX(mob) AS hi FROM q)
SELECT date, round(peak, 6) AS of_peak, round((1 + (lo - mob) / NULLIF(hi - lo, 0)) * 100, 6) AS reduced FROM p FULL JOIN (SELECT * FROM q, b) USING (date)""")
def mobility_and_cases(t):
    cases = windows.percent_of_peak(inputs.national(t).select(F.lit("all").alias("entity"), "date", "n"), ["entity"], value="n").select("date", "of_peak")
    mobility = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_quantity").alias("mobility"))
    both = merge.combine_first(cases, reshape.inverted_rescale(mobility, "mobility", "reduced").select("date", "reduced"), ["date"])
    return rounded(both, "of_peak", "reduced")


@query("mart_regional_cases_per_100k", f"""WITH {inputs.DAILY}, {inputs.PLACES}, pop AS (SELECT region, SUM(population) AS population FROM places GROUP BY 1),
r AS (SELECT date, region, SUM(n) / NULLIF(MAX(population), 0) * 100000 AS per FROM daily JOIN pop USING (region) GROUP BY 1, 2)
SELECT date, region, round(per, 4) AS per_100k, round(SUM(per) OVER (PARTITION BY date ORDER BY region), 4) AS edge FROM r""")
def regional_cases_per_100k(t):
    people = inputs.places(t).groupBy("region").agg(F.sum("population").alias("population"))
    regional = inputs.daily(t).groupBy("date", "region").agg(F.sum("n").alias("n")).join(people, "region").withColumn("per_100k", ratio("n", "population", 100000))
    out = alloc.stacked(regional, ["date"], "region", "per_100k", "edge")
    return out.select("date", "region", F.round("per_100k", 4).alias("per_100k"), F.round("edge", 4).alias("edge"))


@query("mart_trending_places", f"""WITH {mq.GRID}, {inputs.PLACES}, {mq._SLOPE},
top AS (SELECT entity, row_number() OVER (ORDER BY slope DESC, entity) AS position FROM slope WHERE date = (SELECT MAX(date) FROM slope WHERE slope IS NOT NULL) AND slope IS NOT NULL QUALIFY position <= 5),
g AS (SELECT COALESCE(t.entity, 'Rest') AS grp, CAST(COALESCE(position, 6) AS INTEGER) AS position, date, SUM(n) AS n, SUM(population) AS population FROM grid JOIN places USING (entity) LEFT JOIN top t ON t.entity = grid.entity GROUP BY ALL)
SELECT date, grp AS "group", position, round(n / NULLIF(population, 0) * 100000, 5) AS shown FROM g""")
def trending_places(t):
    panel = mq.grid(t).join(inputs.places(t).select("entity", "population"), "entity")
    top = rank.top_groups(panel, windows.increasing("n", 7), ["n", "population"], 5, value=lambda k, d: ratio("n", "population", 100000))
    return top.withColumn("shown", F.round("shown", 5))


@query("mart_places_of_region", f"""WITH {inputs.DAILY}, d AS (SELECT entity, date, value FROM daily WHERE region = 'EUROPE'), {sqltext.dense('d', 'value')}
SELECT entity, date, round({_MA.format('value')}, 4) AS smooth FROM dense WINDOW w AS ({W} {CENTRE7})""")
def places_of_region(t):
    dense = repair.densify(inputs.daily(t).filter("region = 'EUROPE'").select("entity", "date", "value"), ["entity"])
    return windows.moving_average(dense, ["entity"], n=7, min_periods=3, center=True).select("entity", "date", F.round("value_ma", 4).alias("smooth"))


@query("mart_infection_estimates", f"""WITH {mq._CASES}, {inputs.NATIONAL}, f(region, ifr) AS (VALUES {', '.join(str(x) for x in mq._IFR)}),
d AS (SELECT date, SUM(deaths / (CAST(ifr AS DOUBLE) / 100)) AS inf FROM cd JOIN f USING (region) GROUP BY 1), e AS (SELECT date, LEAD(inf, 11) OVER (ORDER BY date) AS infections FROM d),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS model FROM lineitem GROUP BY 1), x AS (SELECT MAX(date) AS today FROM nat)
SELECT s.date, CASE WHEN s.date <= today THEN model END AS estimated, CASE WHEN s.date <= today THEN n END AS reported, CASE WHEN s.date >= today THEN model END AS forecast, round(CASE WHEN s.date <= today THEN infections END, 4) AS infections
FROM s CROSS JOIN x LEFT JOIN nat ON nat.date = s.date LEFT JOIN e ON e.date = s.date WHERE s.date <= today + 60""")
def infection_estimates(t):
    risk = inline_table(t.spark, "region string, ifr double", mq._IFR)
    est = epi.infections(mq.regional_cases(t).join(risk, "region"), "region", "date", "deaths", "ifr").select("date", "infections")
    model = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count("*").cast("double").alias("model"))
    seen = inputs.national(t).select("date", "n")
    return epi.observed_and_forecast(model, seen, "date", "model", "n").join(est, "date", "left").withColumn("infections", F.round("infections", 4))


# ---- deaths -----------------------------------------------------------------------------------

@query("mart_death_ages", f"""WITH {inputs.PLACED}, a AS (SELECT date, MEDIAN(age) AS med, MIN(age) AS lo, MAX(age) AS hi FROM placed WHERE status = 'F' GROUP BY 1)
SELECT date, round(AVG(med) OVER w, 6) AS median_7d, MIN(lo) OVER w AS min_7d, MAX(hi) OVER w AS max_7d FROM a WINDOW w AS (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def death_ages(t):
    dead = inputs.placed_orders(t).filter("status = 'F'")
    ages = dead.groupBy("date").agg(F.min("age").alias("lo"), F.max("age").alias("hi")).join(exact_quantile(dead, ["date"], "age"), "date").withColumn("entity", F.lit("all"))
    w = Window.partitionBy("entity").orderBy(F.unix_date("date")).rangeBetween(-6, 0)
    return ages.select("date", r6(F.avg("median").over(w)).alias("median_7d"), F.min("lo").over(w).alias("min_7d"), F.max("hi").over(w).alias("max_7d"))


_COARSE = [("0-9", "0-39"), ("10-19", "0-39"), ("20-29", "0-39"), ("30-39", "0-39"), ("40-49", "40-69"), ("50-59", "40-69"), ("60-69", "40-69"), ("70+", "70+")]


@query("mart_deaths_by_band", f"""WITH {inputs.PLACED}, m(band, coarse) AS (VALUES {', '.join(str(x) for x in _COARSE)}),
b AS (SELECT date, coarse, COUNT(*) AS n FROM (SELECT date, {_band_sql('age', DECADES)} AS band FROM placed WHERE status = 'F') JOIN m USING (band) GROUP BY 1, 2)
SELECT date, {', '.join(f'''CAST(SUM(n) FILTER (coarse = '{x}') AS BIGINT) AS "Age {x}"''' for x in ('0-39', '40-69', '70+'))} FROM b GROUP BY 1""")
def deaths_by_band(t):
    counts = inputs.placed_orders(t).filter("status = 'F'").withColumn("band", reshape.band("age", DECADES)).groupBy("date", "band").agg(F.count("*").alias("n"))
    mapping = inline_table(t.spark, "old string, new string", [x for x in _COARSE if x[0] != x[1]])
    coarse = reshape.regroup_bands(counts.filter("band IS NOT NULL"), ["date"], "band", "n", mapping).filter(F.col("band").isin("0-39", "40-69", "70+"))
    return reshape.value_crosstab(coarse, ["date"], "band", ["0-39", "40-69", "70+"], "n", prefix="Age ")


@query("mart_fatality_by_region", f"""WITH {mq._CASES}, l AS (SELECT *, LAG(cases, 17) OVER (PARTITION BY region ORDER BY date) AS lc FROM cd),
r AS (SELECT region, date, CASE WHEN COUNT(deaths) OVER w >= 90 THEN AVG(deaths) OVER w END / NULLIF(CASE WHEN COUNT(lc) OVER w >= 90 THEN AVG(lc) OVER w END, 0) * 100 AS cfr FROM l WINDOW w AS (PARTITION BY region ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW))
SELECT date, {', '.join(f'''round(SUM(cfr) FILTER (region = '{x}'), 6) AS "CFR {x}"''' for x in REGIONS)} FROM r GROUP BY 1""")
def fatality_by_region(t):
    cfr = epi.fatality_ratio(mq.regional_cases(t), ["region"], "date", "deaths", "cases")
    return rounded(reshape.value_crosstab(cfr, ["date"], "region", REGIONS, "cfr", prefix="CFR "), *[f"CFR {x}" for x in REGIONS])


@query("mart_excess_national", f"""WITH {inputs.CUBE}, {mq._excess_sql('')}, known AS (SELECT CAST(last_day(make_date(year, month, 1)) AS DATE) AS date, SUM(deaths) / 4 AS known FROM cube WHERE gender = 'F' GROUP BY 1)
SELECT ex.date, deaths_month, round(p_score, 6) AS p_score, round(pre5_avg + known, 6) AS expected, round((excess - known) / NULLIF(pre_avg, 0) * 100, 6) AS deviation FROM ex LEFT JOIN known USING (date)""")
def excess_national(t):
    cube = inputs.cube(t)
    known = cube.filter("gender = 'F'").groupBy(month_end("year", "month").alias("date")).agg((F.sum("deaths") / 4).alias("known"))
    out = epi.expected(epi.excess(cube, [], "deaths", mq.YEARS, mq.START, mq.SHORT, mq.LONG), known, [], "deaths", "known", "pre_avg")
    return rounded(out.select("date", "deaths_month", "p_score", "expected", "deviation"), "p_score", "expected", "deviation")


@query("mart_excess_top_places", f"""WITH {inputs.CUBE}, {mq._excess_sql('entity')},
top AS (SELECT entity, row_number() OVER (ORDER BY p_score DESC, entity) AS position FROM ex WHERE date = (SELECT MAX(date) FROM ex) QUALIFY position <= 5)
SELECT date, entity AS "group", CAST(position AS INTEGER) AS position, round(p_score, 6) AS shown FROM ex JOIN top USING (entity)""")
def excess_top_places(t):
    scores = epi.excess(inputs.cube(t), ["entity"], "deaths", mq.YEARS, mq.START, mq.SHORT, mq.LONG).select("entity", "date", "p_score")
    return rounded(rank.top_groups(scores, lambda k, d: F.col("p_score"), "p_score", 5, other=None), "shown")


# ---- variants and tests -------------------------------------------------------------------------

@query("mart_variant_counts", f"""WITH {mq._VARIANT_SQL}, {inputs.PLACED}, c AS (SELECT date, COUNT(*) AS cases, COUNT(*) FILTER (status = 'F') AS deaths FROM placed GROUP BY 1), {sqltext.dense('mg', 'share', keys='grp')}, {sqltext.interpolated('dense', 'share', keys='grp')}
SELECT grp, date, round(COALESCE(share, pv) * cases, 6) AS cases, round(COALESCE(share, pv) * deaths, 6) AS deaths FROM filled JOIN c USING (date)""")
def variant_counts(t):
    samples = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        week_bucket(F.to_date("l_shipdate")).alias("date"), F.col("p_type").alias("lineage"), F.col("l_linestatus").alias("lab")).agg(F.count("*").alias("n"))
    by_lab = [epi.variant_shares(samples.filter(F.col("lab") == lab).drop("lab"), "date", "lineage", "n", mq._LINEAGES, 90) for lab in "OF"]
    counts = inputs.placed_orders(t).groupBy("date").agg(F.count("*").alias("cases"), F.count(F.when(F.col("status") == "F", 1)).alias("deaths"))
    mix = epi.variant_mix(*by_lab, counts, "date", "cases").join(counts.select("date", "deaths"), "date")
    return mix.select("grp", "date", r6("estimate").alias("cases"), r6(F.col("share") * F.col("deaths")).alias("deaths"))


@query("mart_tests_and_positivity", f"""WITH {inputs.PLACED}, d AS (SELECT date, CAST(COUNT(*) AS DOUBLE) AS tests, CAST(COUNT(*) FILTER (status = 'F') AS DOUBLE) AS pos, COUNT(*) FILTER (segment = 'MACHINERY') AS private FROM placed GROUP BY 1),
r AS (SELECT *, pos / NULLIF(tests, 0) * 100 AS positivity FROM d), c AS (SELECT date, SUM(tests) OVER (ORDER BY date) AS tests_cum FROM d WHERE date >= DATE '1999-04-01')
SELECT r.date, tests, round(positivity, 6) AS positivity, round(MEDIAN(positivity) OVER w, 6) AS positivity_median, round(MIN(positivity) OVER w, 6) AS positivity_min, round(MAX(positivity) OVER w, 6) AS positivity_max,
  round(tests / NULLIF(pos, 0), 6) AS per_case, tests - private AS public, tests_cum FROM r LEFT JOIN c USING (date) WINDOW w AS (ORDER BY r.date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def tests_and_positivity(t):
    d = inputs.placed_orders(t).groupBy(F.lit("all").alias("entity"), "date").agg(
        F.count("*").cast("double").alias("tests"), F.count(F.when(F.col("status") == "F", 1)).cast("double").alias("pos"),
        F.count(F.when(F.col("segment") == "MACHINERY", 1)).alias("private"))
    rates = windows.calendar_rolling(d.withColumn("positivity", ratio("pos", "tests", 100)), ["entity"], value="positivity")
    waves = windows.running_from(d, ["entity"], "date", "tests", "1999-04-01").select("date", "tests_cum")
    return rates.join(waves, "date", "left").select(
        "date", "tests", r6("positivity").alias("positivity"), *[r6(f"positivity_{x}").alias(f"positivity_{x}") for x in ("median", "min", "max")],
        r6(ratio("tests", "pos")).alias("per_case"), (F.col("tests") - F.col("private")).alias("public"), "tests_cum")


@query("mart_tests_by_region", f"""WITH {inputs.PLACED}, {inputs.NATIONAL}, k AS (SELECT region AS entity, date + CAST(6 - dayofweek(date) AS INTEGER) AS date, COUNT(*) / 6 AS value FROM placed GROUP BY 1, 2),
{sqltext.dense('k', 'value')}, {sqltext.interpolated('dense', 'value')}, s AS (SELECT f.entity, f.date, f.value / SUM(f.value) OVER (PARTITION BY f.date) * nat.n AS est FROM filled f LEFT JOIN nat USING (date)),
sm AS (SELECT entity, date, CASE WHEN COUNT(est) OVER w >= 7 THEN AVG(est) OVER w END AS est FROM s WINDOW w AS ({W} {CENTRE7}))
SELECT date, {', '.join(f'''round(SUM(est) FILTER (entity = '{x}'), 6) AS "Tests {x}"''' for x in REGIONS)} FROM sm GROUP BY 1""")
def tests_by_region(t):
    weekly = inputs.placed_orders(t).groupBy(F.col("region").alias("entity"), week_bucket("date").alias("stop")).agg(F.count("*").alias("value"))
    daily = repair.interval_rate(weekly.withColumn("start", F.date_sub("stop", 6)), ["entity"], "start", "stop", "value")
    est = alloc.allocate(daily, inputs.national(t), ["date"], "value", "n", "est")
    smooth = windows.moving_average(est, ["entity"], "date", "est", 7, center=True)
    return rounded(reshape.value_crosstab(smooth, ["date"], "entity", REGIONS, "est_ma", prefix="Tests "), *[f"Tests {x}" for x in REGIONS])


# ---- hospital -----------------------------------------------------------------------------------

@query("mart_active_and_exits", f"""WITH {inputs.PLACED}, d AS (SELECT date, CAST(COUNT(*) AS DOUBLE) AS cases, CAST(COUNT(*) FILTER (status = 'F') AS DOUBLE) AS deaths, CAST(COUNT(*) FILTER (status = 'O') AS DOUBLE) AS recovered FROM placed WHERE date >= DATE '1999-04-01' GROUP BY 1),
c AS (SELECT date, deaths, SUM(cases) OVER (ORDER BY date) AS cases_cum, SUM(deaths) OVER (ORDER BY date) AS deaths_cum, SUM(recovered) OVER (ORDER BY date) AS recovered_cum, CASE WHEN COUNT(deaths) OVER w >= 7 THEN AVG(deaths) OVER w END AS ma FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT date, cases_cum, deaths_cum, recovered_cum, greatest(cases_cum - deaths_cum - recovered_cum, 0) AS active, round(deaths / NULLIF(MAX(ma) OVER (), 0) * 100, 6) AS deaths_of_peak FROM c""")
def active_and_exits(t):
    s = F.col("status")
    d = inputs.placed_orders(t).groupBy(F.lit("all").alias("entity"), "date").agg(
        F.count("*").cast("double").alias("cases"), F.count(F.when(s == "F", 1)).cast("double").alias("deaths"), F.count(F.when(s == "O", 1)).cast("double").alias("recovered"))
    waves = windows.running_from(d, ["entity"], "date", ["cases", "deaths", "recovered"], "1999-04-01")
    peak = windows.percent_of_peak(waves, ["entity"], value="deaths", out="deaths_of_peak")
    active = clip(subtract("cases_cum", row_sum(["deaths_cum", "recovered_cum"]), 0.0), 0.0)
    return peak.select("date", "cases_cum", "deaths_cum", "recovered_cum", active.alias("active"), r6("deaths_of_peak").alias("deaths_of_peak"))


# ---- vaccination ----------------------------------------------------------------------------------

@query("mart_vaccination_daily", f"""WITH {mq._DOSES}, {sqltext.undipped('doses', 'dose1')}, u2 AS (SELECT entity, date, dose1 FROM undipped), {sqltext.dense('u2', 'dose1')}, {sqltext.interpolated('dense', 'dose1')},
g AS (SELECT date, SUM(x) AS given FROM (SELECT entity, date, dose1 - LAG(dose1) OVER ({W}) AS x FROM filled) GROUP BY 1),
mk AS (SELECT date, segment, COUNT(*) AS n FROM placed GROUP BY 1, 2)
SELECT date, segment, round(n / SUM(n) OVER (PARTITION BY date) * given, 4) AS given FROM mk JOIN g USING (date)""")
def vaccination_daily(t):
    daily = repair.cumulative_to_daily(mq.doses(t).select("entity", "date", "dose1"), ["entity"], values="dose1")
    given = daily.groupBy("date").agg(F.sum("dose1").alias("given"))
    makers = inputs.placed_orders(t).groupBy("date", "segment").agg(F.count("*").alias("n"))
    return alloc.normalise(makers.join(given, "date"), ["date"], "n", "given", "share").select("date", "segment", F.round("share", 4).alias("given"))


_REGION_DOSES = f"""{mq._DOSES}, {inputs.PLACES}, {sqltext.dense('doses', 'dose1, dose2')}, ff AS (SELECT entity, date, last_value(dose1 IGNORE NULLS) OVER ({W}) AS dose1, last_value(dose2 IGNORE NULLS) OVER ({W}) AS dose2 FROM dense),
cf AS (SELECT date FROM ff GROUP BY 1 HAVING COUNT(DISTINCT entity) = (SELECT COUNT(*) FROM nation)), pp AS (SELECT region, SUM(population) AS population FROM places GROUP BY 1),
rg AS (SELECT region, date, SUM(dose1) AS dose1, MAX(population) AS population FROM ff JOIN places p USING (entity) JOIN (SELECT region AS reg, population AS pop FROM pp) q ON q.reg = p.region WHERE date IN (SELECT date FROM cf) GROUP BY 1, 2),
cv AS (SELECT region, date, MAX(NULLIF(dose1 / NULLIF(pp.population, 0) * 100, 0)) OVER (PARTITION BY region ORDER BY date) AS coverage FROM rg JOIN pp USING (region))"""


def _coverage(t):
    filled = repair.forward_fill(repair.densify(mq.doses(t).select("entity", "date", "dose1"), ["entity"]), ["entity"], "date", "dose1")
    return epi.coverage(filled, inputs.places(t), "entity", "date", "dose1", t.nation.agg(F.count("*")).scalar())


@query("mart_coverage_forecast", f"""WITH {_REGION_DOSES}, l AS (SELECT region, MAX(date) AS t0, arg_max(coverage, date) AS v0 FROM cv WHERE coverage IS NOT NULL GROUP BY 1),
b AS (SELECT l.*, (v0 - cv.coverage) / 14 AS rate FROM l LEFT JOIN cv ON cv.region = l.region AND cv.date = t0 - 14),
f AS (SELECT region, t0 + CAST(i AS INTEGER) AS date, least(v0 + (i + 1) * rate, greatest(v0, 1100.0::DOUBLE)) AS forecast FROM b, range(0, 61) r(i))
SELECT region, date, round(coverage, 6) AS coverage, round(forecast, 6) AS forecast FROM (SELECT region, date, coverage FROM cv) FULL JOIN f USING (region, date)""")
def coverage_forecast(t):
    seen = _coverage(t).select("region", "date", "coverage")
    now = repair.last_valid(seen, ["region"], "date", "coverage").select("region", F.col("coverage").alias("now"))
    ahead = forecast.extrapolate(seen, ["region"], "coverage", 60).join(now, "region").select("region", "date", forecast.cap("pred", "now", 1100).alias("forecast"))
    return rounded(merge.combine_first(seen, ahead, ["region", "date"]), "coverage", "forecast")


@query("mart_peaks_and_coverage", f"""WITH {_OUTCOMES}, m AS (SELECT *, CASE WHEN COUNT(value) OVER w >= 7 THEN AVG(value) OVER w END AS ma FROM oc WINDOW w AS ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
p AS (SELECT date, entity, value / NULLIF(MAX(ma) OVER (PARTITION BY entity), 0) * 100 AS x FROM m),
v AS (SELECT date, SUM(COUNT(*)) OVER (ORDER BY date) / (SELECT COUNT(*) FROM customer) * 100 AS coverage FROM placed GROUP BY 1)
SELECT p.date, {', '.join(f"round(MAX(x) FILTER (entity = '{e}'), 6) AS {e}" for e in ('cases', 'deaths', 'severe'))}, round(MAX(coverage), 6) AS coverage FROM p JOIN v USING (date) GROUP BY 1""")
def peaks_and_coverage(t):
    peaks = reshape.value_crosstab(windows.percent_of_peak(outcomes(t), ["entity"]), ["date"], "entity", ["cases", "deaths", "severe"], "of_peak", "max")
    given = windows.running_from(inputs.national(t).select(F.lit("all").alias("entity"), "date", "n"), ["entity"], "date", "n", "1900-01-01")
    people = t.customer.agg(F.count("*")).scalar()
    return rounded(peaks.join(given.select("date", ratio("n_cum", people, 100).alias("coverage")), "date"), "cases", "deaths", "severe", "coverage")


@query("mart_place_coverage_ranking", f"""WITH {mq._DOSES}, {inputs.PLACES}, {sqltext.dense('doses', 'dose1')}, ff AS (SELECT entity, date, last_value(dose1 IGNORE NULLS) OVER ({W}) AS dose1 FROM dense),
r AS (SELECT entity, date, dose1 / NULLIF(population, 0) * 100 AS cov FROM ff JOIN places USING (entity)),
l AS (SELECT entity, MAX(date) AS d, arg_max(cov, date) AS cov FROM r GROUP BY 1), z AS (SELECT * FROM l WHERE d = (SELECT MAX(d) FROM l)),
k AS (SELECT entity, 'top' AS side, row_number() OVER (ORDER BY cov DESC, entity) AS position FROM z UNION ALL SELECT entity, 'bottom', row_number() OVER (ORDER BY cov, entity) FROM z)
SELECT side, r.date, entity AS "group", CAST(position AS INTEGER) AS position, round(cov, 6) AS shown FROM k JOIN r USING (entity) WHERE position <= 3""")
def place_coverage_ranking(t):
    filled = repair.forward_fill(repair.densify(mq.doses(t).select("entity", "date", "dose1"), ["entity"]), ["entity"], "date", "dose1")
    rated = filled.join(inputs.places(t).select("entity", "population"), "entity").withColumn("cov", ratio("dose1", "population", 100))

    def side(largest, name):
        return rank.top_groups(rated, lambda k, d: F.col("cov"), "cov", 3, other=None, largest=largest).withColumn("side", F.lit(name))

    return rounded(side(True, "top").unionByName(side(False, "bottom")), "shown")


# ---- supply ---------------------------------------------------------------------------------------

@query("mart_bed_supply", """WITH s AS (SELECT n_name AS place, CASE WHEN s_suppkey % 2 = 0 THEN 'beds' ELSE 'vents' END AS kind, CAST(round(s_acctbal) AS BIGINT) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT place, CAST(SUM(n) FILTER (kind = 'beds') AS BIGINT) AS "n beds", CAST(COALESCE(SUM(n) FILTER (kind = 'vents'), -1) AS BIGINT) AS "n vents" FROM s GROUP BY 1""")
def bed_supply(t):
    aliases = places.alias_table(gazetteer(t), "name", "aliases", ["region"])
    amounts = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "beds").otherwise("vents").alias("kind"), inputs.units("s_acctbal").alias("n"))
    named = places.canonical_places(free_text_places(t).join(amounts, "s_suppkey"), aliases, "place", cutoff=0.99, prefixes=["Prov."], suffixes=[" State"])
    now = reshape.wide(named, ["place"], "kind", ["beds", "vents"], ["n"])
    before = now.select("place", F.lit(-1).cast("bigint").alias("n vents"))
    return merge.combine_first(now, before, ["place"])


@query("mart_hospital_resources", """WITH f AS (SELECT n_name AS entity, CAST(floor(c_acctbal) AS BIGINT) * 2 + 1 AS beds FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT DATE '2024-02-01' AS date, entity, CAST(SUM(beds) AS BIGINT) AS beds FROM f GROUP BY 2""")
def hospital_resources(t):
    features = io.flatten_features(payloads(t), "features", "kind: string, beds: bigint", ["c_custkey"])
    where = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("entity"))
    return io.stamp_snapshot(features.join(where, "c_custkey"), "entity", ["beds"], "2024-02-01")
