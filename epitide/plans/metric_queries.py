"""Rankings, allocations, forecasts and epidemiological measures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.functions.calendar import month_end
from epitide.functions.scalar import ratio, row_sum, trend_arrow
from epitide.model import inline_table
from epitide.operators import alloc, epi, forecast, rank, repair, reshape, sketches, windows
from epitide.plans import inputs, sqltext
from epitide.plans.inputs import r6
from epitide.plans.registry import query
from epitide.plans.reshape_queries import _band_sql
from epitide.sources.stage import settle

W = "PARTITION BY entity ORDER BY date"
SMOOTH7 = "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
CENTRE7 = "ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING"


def grid(t):
    """Counts for every place on every day seen, zero where nothing happened."""
    return repair.densify_grid(inputs.daily(t).select("entity", "date", "n"), ["entity"], fill=0)


GRID = inputs.DAILY + """,
grid AS (SELECT e.entity, d.date, COALESCE(x.n, 0) AS n FROM (SELECT DISTINCT entity FROM daily) e
  CROSS JOIN (SELECT DISTINCT date FROM daily) d LEFT JOIN daily x ON x.entity = e.entity AND x.date = d.date)"""


# ---- R1 - R4b ---------------------------------------------------------------------------------

_TOP = f"""WITH {GRID},
m AS (SELECT *, AVG(n) OVER ({W} {SMOOTH7}) AS m FROM grid),
top AS (SELECT entity, row_number() OVER (ORDER BY m DESC, entity) AS position FROM m WHERE date = (SELECT MAX(date) FROM m) QUALIFY position <= 5),
g AS (SELECT COALESCE(top.entity, 'Rest') AS grp, COALESCE(position, 6) AS position, date, SUM(n) AS n FROM grid LEFT JOIN top USING (entity) GROUP BY ALL),
s AS (SELECT date, grp AS "group", CAST(position AS INTEGER) AS position, round(AVG(n) OVER (PARTITION BY grp ORDER BY date {SMOOTH7}), 6) AS shown FROM g)"""


def _top(t):
    return rank.top_groups(grid(t), windows.smoothed("n", 7), "n", 5).withColumn("shown", r6("shown"))


@query("r1_top_groups", f"{_TOP} SELECT * FROM s")
def r1(t):
    return _top(t)


@query("r1_top_groups_table", f"""{_TOP} SELECT date, {', '.join(f'MAX(shown) FILTER (position = {i}) AS top{i}' for i in range(1, 6))},
  MAX(shown) FILTER (position = 6) AS other FROM s GROUP BY 1""")
def r1_table(t):
    return rank.group_table(_top(t), 5)


_SLOPE = f"""sl AS (SELECT entity, date, n, list(n) OVER w AS items, COUNT(n) OVER w AS c FROM grid WINDOW w AS ({W} {CENTRE7})),
slope AS (SELECT entity, date, n, CASE WHEN c >= 3 THEN CAST(items[CAST(ceil(len(items) / 2) AS INTEGER) + 1] - items[1] AS DOUBLE) / len(items) END AS slope FROM sl)"""


# The slope is needed on the last day alone, and its window reaches three rows back: the last month is plenty.
@query("r2_bottom_groups", f"""WITH {GRID}, edge AS (SELECT MAX(date) AS last_day FROM grid),
recent AS (SELECT entity, date, n FROM grid, edge WHERE date > last_day - 31),
sl AS (SELECT entity, date, list(n) OVER ({W} {CENTRE7}) AS items FROM recent),
slope AS (SELECT entity, CAST(items[CAST(ceil(len(items) / 2) AS INTEGER) + 1] - items[1] AS DOUBLE) / len(items) AS slope FROM sl, edge WHERE date = last_day),
low AS (SELECT entity, row_number() OVER (ORDER BY slope, entity) AS position FROM slope QUALIFY position <= 4)
SELECT date, entity AS "group", CAST(position AS INTEGER) AS position, n AS shown FROM grid JOIN low USING (entity)""")
def r2(t):
    return rank.top_groups(grid(t), windows.increasing("n", 7), "n", 4, value=lambda k, d: F.col("n"), other=None, largest=False)


@query("r3_per_capita", f"""WITH {inputs.DAILY}, {inputs.PLACES}, pop AS (SELECT region, SUM(population) AS population FROM places GROUP BY 1)
SELECT region, date, round(SUM(n) / MAX(population) * 100000, 5) AS per_100k FROM daily JOIN pop USING (region) GROUP BY 1, 2""")
def r3(t):
    people = inputs.places(t).groupBy("region").agg(F.sum("population").alias("population"))
    regional = inputs.daily(t).groupBy("region", "date").agg(F.sum("n").alias("n"))
    return regional.join(people, "region").select("region", "date", F.round(ratio("n", "population", 100000), 5).alias("per_100k"))


@query("r4_recent_mean_order", f"""WITH {inputs.PLACED}, g AS (SELECT segment, date, COUNT(*) AS n FROM placed GROUP BY 1, 2),
d AS (SELECT DISTINCT date FROM g ORDER BY date DESC LIMIT 50)
SELECT segment, round(AVG(n), 6) AS recent_mean FROM g WHERE date >= (SELECT MIN(date) FROM d) GROUP BY 1""")
def r4(t):
    g = inputs.placed_orders(t).groupBy("segment", "date").agg(F.count("*").alias("n"))
    return rank.recent_mean_order(g, "segment", "date", "n", 50).withColumn("recent_mean", r6("recent_mean"))


@query("r4b_top_latest", f"""WITH {inputs.CUMULATIVE}, l AS (SELECT entity, arg_max(value, date) AS value, MAX(date) AS value_date FROM cum WHERE value IS NOT NULL GROUP BY 1)
SELECT * FROM l ORDER BY value DESC, entity LIMIT 5""")
def r4b(t):
    return rank.top_latest(inputs.cumulative(t), "entity", "date", "value", 5)


# ---- R5 - R9, R23 - R25 -------------------------------------------------------------------------

_TYPES = inputs.PLACED + """,
ty AS (SELECT date, type, COUNT(*) AS n FROM placed GROUP BY 1, 2), tot AS (SELECT date, COUNT(*) + day(date) AS total FROM placed GROUP BY date)"""


def _by_type(t):
    return inputs.placed_orders(t).groupBy("date", "type").agg(F.count("*").alias("n"))


def _totals(t):
    """Reported totals that include some of unknown type: the count plus the day of the month."""
    return t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n")).select(
        "date", (F.col("n") + F.dayofmonth("date")).alias("total"))


@query("r5_normalise_to_total", f"""WITH {_TYPES}
SELECT date, type, round(n / SUM(n) OVER (PARTITION BY date) * total, 6) AS scaled FROM ty JOIN tot USING (date)""")
def r5(t):
    return alloc.normalise(_by_type(t).join(_totals(t), "date"), ["date"], "n", "total", "scaled").select("date", "type", r6("scaled").alias("scaled"))


@query("r6_share_allocation", f"""WITH {inputs.DAILY}, {inputs.NATIONAL}, r AS (SELECT region, date, SUM(n) AS n FROM daily GROUP BY 1, 2)
SELECT region, date, round(r.n / SUM(r.n) OVER (PARTITION BY date) * nat.value, 4) AS allocated FROM r JOIN nat USING (date)""")
def r6_alloc(t):
    regional = inputs.daily(t).groupBy("region", "date").agg(F.sum("n").alias("n"))
    national = inputs.national(t).select("date", "value")
    return alloc.allocate(regional, national, ["date"], "n", "value", "allocated").select("region", "date", F.round("allocated", 4).alias("allocated"))


@query("r6_rescaled_positivity", f"""WITH {inputs.PLACED},
r AS (SELECT region, date, COUNT(*) FILTER (status = 'F') AS pos, COUNT(*) AS tests FROM placed GROUP BY 1, 2),
q AS (SELECT *, SUM(pos) OVER (PARTITION BY date) / SUM(tests) OVER (PARTITION BY date) AS pool FROM r)
SELECT region, date, round((pos / tests) * (0.25::DOUBLE / NULLIF(pool, 0)), 6) AS rate FROM q""")
def r6_rate(t):
    r = inputs.placed_orders(t).groupBy("region", "date").agg(
        F.count(F.when(F.col("status") == "F", 1)).alias("pos"), F.count("*").alias("tests")).withColumn("national", F.lit(0.25))
    return alloc.rescale_rate(r, ["date"], "pos", "tests", "national", "rate").select("region", "date", r6("rate").alias("rate"))


@query("r7_unknown_residual", f"""WITH {_TYPES}, k AS (SELECT date, SUM(n) AS known FROM ty WHERE type <> '5-LOW' GROUP BY 1)
SELECT date, total, CAST(greatest(total - 20 - COALESCE(known, 0), 0) AS BIGINT) AS unknown FROM tot LEFT JOIN k USING (date)""")
def r7(t):
    known = _by_type(t).filter("type <> '5-LOW'")
    totals = _totals(t).withColumn("reported", F.col("total") - 20)
    return alloc.unknown_residual(known, ["date"], "n", totals, "reported", "unknown").select("date", "total", "unknown")


@query("r8_percent_stack", f"""WITH {_TYPES}
SELECT date, type, round(CASE WHEN type <> '5-LOW' THEN n / NULLIF(SUM(n) FILTER (type <> '5-LOW') OVER (PARTITION BY date), 0) * 100 ELSE 0 END, 6) AS pct FROM ty""")
def r8(t):
    return alloc.percent_of_total(_by_type(t), ["date"], "n", "pct", F.col("type") != "5-LOW").select("date", "type", r6("pct").alias("pct"))


@query("r9_stacked_categories", f"WITH {_TYPES} SELECT date, type, CAST(SUM(n) OVER (PARTITION BY date ORDER BY type) AS BIGINT) AS edge FROM ty")
def r9(t):
    return alloc.stacked(_by_type(t), ["date"], "type", "n", "edge").select("date", "type", "edge")


@query("r23_redistribute_undated", f"""WITH {inputs.DAILY}, u AS (SELECT entity, SUM(value) / 10 AS undated FROM daily WHERE date >= DATE '2001-01-01' GROUP BY 1),
c AS (SELECT entity, SUM(value) AS total FROM daily WHERE date < DATE '2001-01-01' GROUP BY 1)
SELECT entity, date, round(value + CASE WHEN date < DATE '2001-01-01' THEN COALESCE(value / total * undated, 0) ELSE 0 END, 4) AS spread
FROM daily LEFT JOIN u USING (entity) LEFT JOIN c USING (entity)""")
def r23(t):
    d = inputs.daily(t).select("entity", "date", "value")
    start = F.lit("2001-01-01").cast("date")
    undated = d.filter(F.col("date") >= start).groupBy("entity").agg((F.sum("value") / 10).alias("undated"))
    return alloc.redistribute(d, ["entity"], "value", undated, "undated", F.col("date") < start, "spread").select(
        "entity", "date", F.round("spread", 4).alias("spread"))


_DOSES = inputs.PLACED + """,
dw AS (SELECT entity, date, CAST(COUNT(*) AS DOUBLE) AS a, CAST(COUNT(*) FILTER (status <> 'P') AS DOUBLE) AS b, CAST(COUNT(*) FILTER (status = 'F') AS DOUBLE) AS c FROM placed GROUP BY 1, 2),
doses AS (SELECT entity, date, SUM(a) OVER w AS dose1, SUM(b) OVER w AS dose2, SUM(c) OVER w AS dose3 FROM dw WINDOW w AS (PARTITION BY entity ORDER BY date))"""


def doses(t):
    """Cumulative first, second and third doses per place, on days with any."""
    s = F.col("status")
    day = inputs.placed_orders(t).groupBy("entity", "date").agg(
        F.count("*").cast("double").alias("a"), F.count(F.when(s != "P", 1)).cast("double").alias("b"),
        F.count(F.when(s == "F", 1)).cast("double").alias("c"))
    w = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return day.select("entity", "date", F.sum("a").over(w).alias("dose1"), F.sum("b").over(w).alias("dose2"), F.sum("c").over(w).alias("dose3"))


@query("r24_single_dose", f"WITH {_DOSES} SELECT entity, date, dose1 - dose2 AS one_dose, dose1 + dose2 + dose3 AS given FROM doses")
def r24(t):
    return doses(t).select("entity", "date", (F.col("dose1") - F.col("dose2")).alias("one_dose"),
                           row_sum(["dose1", "dose2", "dose3"], "strict").alias("given"))


@query("r25_public_from_total", f"""WITH {inputs.PLACED}, r AS (SELECT entity, date, COUNT(*) AS tests, COUNT(*) FILTER (segment = 'MACHINERY') AS private, COUNT(*) FILTER (status = 'F') / COUNT(*) AS rate FROM placed GROUP BY 1, 2)
SELECT entity, date, tests - private AS public, round(tests * rate, 6) AS pos FROM r""")
def r25(t):
    r = inputs.placed_orders(t).groupBy("entity", "date").agg(
        F.count("*").alias("tests"), F.count(F.when(F.col("segment") == "MACHINERY", 1)).alias("private"),
        F.count(F.when(F.col("status") == "F", 1)).alias("f"))
    return r.select("entity", "date", (F.col("tests") - F.col("private")).alias("public"), r6(F.col("tests") * ratio("f", "tests")).alias("pos"))


# ---- R10 - R12 ----------------------------------------------------------------------------------

_DENSE_DOSES = f"""{_DOSES}, {sqltext.dense('doses', 'dose1, dose2, dose3')},
{sqltext.interpolated('dense', 'dose1', out='i1')}, i1b AS (SELECT entity, date, dose1, dose2, dose3 FROM i1), {sqltext.interpolated('i1b', 'dose2', out='i2')},
vac AS (SELECT entity, date, dose1, dose2, dose3 FROM i2),
t0 AS (SELECT entity, MAX(date) AS t0 FROM vac WHERE dose1 IS NOT NULL GROUP BY 1),
base AS (SELECT t0.entity, t0.t0, a.dose1 AS v0, (a.dose1 - b.dose1) / 14 AS rate FROM t0 JOIN vac a ON a.entity = t0.entity AND a.date = t0.t0
  LEFT JOIN vac b ON b.entity = t0.entity AND b.date = t0.t0 - 14),
fut AS (SELECT entity, t0 + CAST(i AS INTEGER) AS date, i, v0 + (i + 1) * rate AS dose1_pred FROM base, range(0, 91) r(i))"""


def vaccinated(t):
    return repair.interpolate(repair.densify(doses(t), ["entity"]), ["entity"], "date", ["dose1", "dose2"])


@query("r10_linear_forecast", f"""WITH {_DENSE_DOSES},
sh AS (SELECT v.entity, v.date + 40 AS date, dose1 AS s FROM vac v JOIN t0 ON t0.entity = v.entity WHERE v.date BETWEEN t0 - 40 AND t0
  UNION ALL SELECT entity, date + 40, dose1_pred FROM fut WHERE i >= 1),
b0 AS (SELECT v.entity, v.dose1 AS b FROM vac v JOIN t0 ON t0.entity = v.entity AND v.date = t0 - 40),
s0 AS (SELECT v.entity, arg_max(dose2, date) AS s0 FROM vac v JOIN t0 ON t0.entity = v.entity WHERE date <= t0 AND dose2 IS NOT NULL GROUP BY 1)
SELECT f.entity, f.date, CAST(f.i AS INTEGER) AS step, round(dose1_pred, 5) AS dose1_pred, round(s - b + s0, 5) AS dose2_pred
FROM fut f LEFT JOIN sh ON sh.entity = f.entity AND sh.date = f.date LEFT JOIN b0 ON b0.entity = f.entity LEFT JOIN s0 ON s0.entity = f.entity""")
def r10(t):
    out = forecast.follow_up(vaccinated(t), ["entity"], "dose1", "dose2", 90, 40)
    return out.select("entity", "date", "step", F.round("dose1_pred", 5).alias("dose1_pred"), F.round("dose2_pred", 5).alias("dose2_pred"))


@query("r11_capped_forecast", f"""WITH {_DENSE_DOSES}
SELECT f.entity, f.date, round(least(dose1_pred, greatest(v0, 620.0::DOUBLE)), 5) AS capped FROM fut f JOIN base ON base.entity = f.entity""")
def r11(t):
    v = vaccinated(t)
    now = repair.last_valid(v, ["entity"], "date", "dose1").select("entity", F.col("dose1").alias("now"))
    return forecast.extrapolate(v, ["entity"], "dose1").join(now, "entity").select(
        "entity", "date", F.round(forecast.cap("pred", "now", 620), 5).alias("capped"))


_GOALS = [("AFRICA", 0.7), ("AMERICA", 0.8), ("ASIA", 0.9), ("EUROPE", 0.95), ("MIDDLE EAST", 0.6)]


@query("r12_required_rate", f"""WITH {_DOSES}, {inputs.PLACES}, l AS (SELECT entity, arg_max(dose2, date) AS dose2, MAX(date) AS last FROM doses GROUP BY 1),
g(region, goal) AS (VALUES {', '.join(str(x) for x in _GOALS)})
SELECT entity, round((CAST(goal AS DOUBLE) * population * 20 - dose2) / CAST(DATE '2002-01-01' - last AS DOUBLE), 6) AS per_day,
  round(dose2 / NULLIF(CAST(goal AS DOUBLE) * population * 20, 0) * 100, 6) AS coverage FROM l JOIN places USING (entity) JOIN g USING (region)""")
def r12(t):
    now = repair.last_valid(doses(t), ["entity"], "date", "dose2")
    goals = inline_table(t.spark, "region string, goal double", _GOALS)
    target = F.col("goal") * F.col("population") * 20
    return now.join(inputs.places(t), "entity").join(goals, "region").select(
        "entity", r6(forecast.required_rate(target, "dose2", "dose2_date", "2002-01-01")).alias("per_day"),
        r6(ratio("dose2", target, 100)).alias("coverage"))


# ---- R13 - R15 ----------------------------------------------------------------------------------

YEARS = list(range(1995, 2002))
SHORT, LONG, START = [1995, 1996, 1997], [1995, 1996, 1997, 1998], 1999


def _excess_sql(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    def yl(ys):
        return ", ".join(map(str, ys))
    return f"""mm AS (SELECT {k}year, month, SUM(deaths) AS deaths FROM cube GROUP BY ALL),
bl AS (SELECT {k}month, AVG(deaths) FILTER (year IN ({yl(SHORT)})) AS pre_avg, MIN(deaths) FILTER (year IN ({yl(SHORT)})) AS pre_min, MAX(deaths) FILTER (year IN ({yl(SHORT)})) AS pre_max,
  AVG(deaths) FILTER (year IN ({yl(LONG)})) AS pre5_avg, MIN(deaths) FILTER (year IN ({yl(LONG)})) AS pre5_min, MAX(deaths) FILTER (year IN ({yl(LONG)})) AS pre5_max,
  {', '.join(f'SUM(deaths) FILTER (year = {y}) AS deaths_{y}' for y in YEARS)} FROM mm GROUP BY ALL),
ex AS (SELECT {', '.join('mm.' + x.strip() for x in keys.split(',')) + ', ' if keys else ''}mm.year, mm.month, CAST(last_day(make_date(mm.year, mm.month, 1)) AS DATE) AS date, mm.deaths AS deaths_month,
  mm.deaths - pre5_avg AS excess, (mm.deaths - pre5_avg) / NULLIF(pre5_avg, 0) * 100 AS p_score, bl.* EXCLUDE ({k}month)
  FROM mm JOIN bl ON {''.join(f'bl.{x.strip()} IS NOT DISTINCT FROM mm.{x.strip()} AND ' for x in keys.split(',') if x)}bl.month = mm.month
  WHERE mm.year >= {START} AND pre5_avg IS NOT NULL AND pre5_avg <> 0)"""


_EX_COLS = ["pre_avg", "pre_min", "pre_max", "pre5_avg", "pre5_min", "pre5_max"] + [f"deaths_{y}" for y in YEARS]


def _excess(t, keys):
    return epi.excess(inputs.cube(t), keys, "deaths", YEARS, START, SHORT, LONG)


@query("r13_excess_mortality", f"""WITH {inputs.CUBE}, {_excess_sql('entity')}
SELECT entity, date, deaths_month, round(excess, 6) AS excess, round(p_score, 6) AS p_score, {', '.join(f'round({c}, 6) AS {c}' for c in _EX_COLS)} FROM ex""")
def r13(t):
    return _excess(t, ["entity"]).select(
        "entity", "date", "deaths_month", r6("excess").alias("excess"), r6("p_score").alias("p_score"), *[r6(c).alias(c) for c in _EX_COLS])


def _expected_sql(key: str, on: str) -> str:
    return f"""WITH {inputs.CUBE}, {_excess_sql(key)},
known AS (SELECT {key}, CAST(last_day(make_date(year, month, 1)) AS DATE) AS date, SUM(deaths) / 4 AS known FROM cube WHERE gender = 'F' GROUP BY ALL)
SELECT ex.{key}, ex.date, round(deaths_month - known, 6) AS without_cause, round(pre5_avg + known, 6) AS expected,
  round((excess - known) / NULLIF({on}, 0) * 100, 6) AS deviation FROM ex LEFT JOIN known ON known.{key} IS NOT DISTINCT FROM ex.{key} AND known.date = ex.date"""


def _expected(t, key, baseline):
    """The facts are read once: both sides need the deaths of each key and month, in all and of the known cause."""
    months = settle(inputs.cube(t).groupBy(key, "year", "month").agg(
        F.sum("deaths").alias("deaths"), (F.sum(F.when(F.col("gender") == "F", F.col("deaths"))) / 4).alias("known")), "months")
    known = months.select(key, month_end("year", "month").alias("date"), "known")
    return epi.expected(epi.excess(months, [key], "deaths", YEARS, START, SHORT, LONG), known, [key], "deaths", "known", baseline).select(
        key, "date", *[r6(c).alias(c) for c in ("without_cause", "expected", "deviation")])


@query("r14_expected_by_region", _expected_sql("region", "pre_avg"))
def r14_region(t):
    return _expected(t, "region", "pre_avg")


@query("r14_expected_by_place", _expected_sql("entity", "pre5_avg"))
def r14_place(t):
    return _expected(t, "entity", "pre5_avg")


_CUBE_BANDS = [15, 35]
_BAND_CUBE = inputs.CUBE.replace("cube AS (", "cube0 AS (") + f", cube AS (SELECT * EXCLUDE (age), {_band_sql('age', _CUBE_BANDS)} AS band FROM cube0)"


@query("r14_excess_by_age", f"""WITH {_BAND_CUBE}, {_excess_sql('band')}
SELECT band, date, round(excess, 6) AS excess, round(p_score, 6) AS p_score FROM ex""")
def r14_age(t):
    banded = inputs.cube(t).withColumn("band", reshape.band("age", _CUBE_BANDS))
    return epi.excess(banded, ["band"], "deaths", YEARS, START, SHORT, LONG).select(
        "band", "date", r6("excess").alias("excess"), r6("p_score").alias("p_score"))


_GROUPINGS = {"region": ["region"], "place": ["entity"], "band": ["band"], "band by region": ["band", "region"]}


def _groupings_sql() -> str:
    """The excess of every grouping by itself, one after the other."""
    ctes, reads = [], []
    for i, (name, keys) in enumerate(_GROUPINGS.items()):
        part = _excess_sql(", ".join(keys)).replace("mm AS", f"mm{i} AS").replace("bl AS", f"bl{i} AS").replace("ex AS", f"ex{i} AS")
        ctes.append(part.replace("FROM mm ", f"FROM mm{i} mm ").replace("JOIN bl ", f"JOIN bl{i} bl "))
        columns = ", ".join(c if c in keys else f"NULL AS {c}" for c in ("region", "entity", "band"))
        reads.append(f"SELECT '{name}' AS grouping, {columns}, date, round(excess, 6) AS excess, round(p_score, 6) AS p_score FROM ex{i}")
    return f"WITH {_BAND_CUBE}, {', '.join(ctes)} {' UNION ALL '.join(reads)}"


@query("r14_excess_all_groupings", _groupings_sql())
def r14_all(t):
    """Groupings that do not nest, with baselines of their own, from one scan of the facts."""
    banded = inputs.cube(t).withColumn("band", reshape.band("age", _CUBE_BANDS))
    return epi.excess_over(banded, _GROUPINGS, "deaths", YEARS, START, SHORT, LONG).select(
        "grouping", "region", "entity", "band", "date", r6("excess").alias("excess"), r6("p_score").alias("p_score"))


# ---- quantiles from sketches ----------------------------------------------------------------------

@query("a1_sketch_quantiles", f"""WITH {inputs.PLACED} SELECT entity, CAST(year(date) AS INTEGER) AS year, COUNT(*) AS n, true AS median_near, true AS upper_near FROM placed GROUP BY 1, 2""")
def a1_sketches(t):
    """Yearly quantiles merged from one sketch per place and day, and whether their true ranks are within 3 per cent."""
    rows = inputs.placed_orders(t).select("entity", "date", "amount")
    days = settle(sketches.day_sketches(rows, ["entity"], "date", "amount"), "sketches")
    found = sketches.merged(days, ["entity", F.year("date").alias("year")], {"median": 0.5, "upper": 0.9})
    placed = rows.withColumn("year", F.year("date")).join(found, ["entity", "year"])

    def near(name, q):
        below, upto = F.count_if(F.col("amount") < F.col(name)), F.count_if(F.col("amount") <= F.col(name))
        return ((below <= (q + 0.03) * F.count("*") + 1) & (upto >= (q - 0.03) * F.count("*") - 1)).alias(f"{name}_near")

    return placed.groupBy("entity", "year").agg(F.first("n").alias("n"), near("median", 0.5), near("upper", 0.9))


@query("t13_sketch_windows", f"""WITH {inputs.PLACED}, days AS (SELECT DISTINCT region, date FROM placed)
SELECT d.region, d.date, COUNT(*) AS n FROM days d JOIN placed p ON p.region = d.region AND p.date BETWEEN d.date - 29 AND d.date GROUP BY 1, 2""")
def t13_sketches(t):
    """Orders behind the quantiles of every moving month, merged from daily sketches; the facts are read once."""
    days = sketches.day_sketches(inputs.placed_orders(t), ["region"], "date", "amount")
    return sketches.moving(settle(days, "sketches"), ["region"], "date", 30, {"median": 0.5}).filter("median IS NOT NULL").select("region", "date", "n")


@query("r15_month_by_year", f"""WITH {inputs.CUBE} SELECT month, {', '.join(f'SUM(deaths) FILTER (year = {y}) AS "{y}"' for y in YEARS)} FROM cube GROUP BY 1""")
def r15(t):
    return reshape.value_crosstab(inputs.cube(t), ["month"], "year", YEARS, "deaths")


# ---- R16 - R22, R26 - R29 -----------------------------------------------------------------------

_CASES = inputs.PLACED + """,
cd AS (SELECT region, date, CAST(COUNT(*) AS DOUBLE) AS cases, CAST(COUNT(*) FILTER (status = 'F') AS DOUBLE) AS deaths FROM placed GROUP BY 1, 2)"""


def regional_cases(t):
    return inputs.placed_orders(t).groupBy("region", "date").agg(
        F.count("*").cast("double").alias("cases"), F.count(F.when(F.col("status") == "F", 1)).cast("double").alias("deaths"))


@query("r16_fatality_ratio", f"""WITH {_CASES}, l AS (SELECT *, LAG(cases, 17) OVER (PARTITION BY region ORDER BY date) AS lc FROM cd)
SELECT region, date, round(CASE WHEN COUNT(deaths) OVER w >= 90 THEN AVG(deaths) OVER w END / NULLIF(CASE WHEN COUNT(lc) OVER w >= 90 THEN AVG(lc) OVER w END, 0) * 100, 6) AS cfr
FROM l WINDOW w AS (PARTITION BY region ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)""")
def r16(t):
    return epi.fatality_ratio(regional_cases(t), ["region"], "date", "deaths", "cases").select("region", "date", r6("cfr").alias("cfr"))


_IFR = [("AFRICA", 0.5), ("AMERICA", 0.8), ("ASIA", 0.6), ("EUROPE", 1.2), ("MIDDLE EAST", 0.7)]


@query("r17_infections_estimate", f"""WITH {_CASES}, f(region, ifr) AS (VALUES {', '.join(str(x) for x in _IFR)}),
m AS (SELECT region, date, deaths, AVG(deaths) OVER (PARTITION BY region ORDER BY date {SMOOTH7}) AS ma, CAST(ifr AS DOUBLE) AS ifr FROM cd JOIN f USING (region)),
d AS (SELECT date, SUM(deaths) AS deaths, SUM(deaths / (ifr / 100)) AS inf, SUM(ma / (ifr / 100)) AS inf_ma FROM m GROUP BY 1)
SELECT date, deaths, round(LEAD(inf, 11) OVER (ORDER BY date), 4) AS infections, round(inf_ma, 4) AS infections_ma,
  round(LEAD(deaths, 11) OVER (ORDER BY date) / 0.0054::DOUBLE, 4) AS simple FROM d""")
def r17(t):
    risk = inline_table(t.spark, "region string, ifr double", _IFR)
    out = epi.infections(regional_cases(t).join(risk, "region"), "region", "date", "deaths", "ifr")
    return out.select("date", "deaths", *[F.round(c, 4).alias(c) for c in ("infections", "infections_ma", "simple")])


_LINEAGES = [("M", "M group"), ("S", "S group"), ("STA", "Standard"), ("P", "Promo")]

_VARIANT_SQL = f"""sm AS (SELECT CAST(l_shipdate AS DATE) + CAST(6 - dayofweek(l_shipdate) AS INTEGER) AS date, p_type AS lineage, l_linestatus AS lab, COUNT(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
gr AS (SELECT lab, date, CASE WHEN starts_with(lineage, 'P') THEN 'Promo' WHEN starts_with(lineage, 'STA') THEN 'Standard' WHEN starts_with(lineage, 'S') THEN 'S group' WHEN starts_with(lineage, 'M') THEN 'M group' ELSE 'Other' END AS grp, SUM(n) AS n FROM sm GROUP BY ALL),
al AS (SELECT lab, date, SUM(n) AS total FROM gr GROUP BY 1, 2),
sh AS (SELECT gr.lab, gr.date, grp, n / total AS share FROM gr JOIN al ON al.lab = gr.lab AND al.date = gr.date WHERE total >= 90),
cells AS (SELECT a.lab, a.date, g.grp, COALESCE(share, 0) AS share FROM (SELECT DISTINCT lab, date FROM sh) a JOIN (SELECT DISTINCT lab, grp FROM sh) g ON g.lab = a.lab
  LEFT JOIN sh ON sh.lab = a.lab AND sh.date = a.date AND sh.grp = g.grp),
mg AS (SELECT grp, date, COALESCE(d.share, c.share) AS share FROM (SELECT * FROM cells WHERE lab = 'O') d FULL JOIN (SELECT * FROM cells WHERE lab = 'F') c USING (grp, date))"""


@query("r18_variant_mix", f"""WITH {_VARIANT_SQL}, {inputs.NATIONAL}, {sqltext.dense('mg', 'share', keys='grp')}, {sqltext.interpolated('dense', 'share', keys='grp')}
SELECT grp, date, round(COALESCE(share, pv), 6) AS share, nat.n, round(COALESCE(share, pv) * nat.n, 6) AS estimate FROM filled JOIN nat USING (date)""")
def r18(t):
    from epitide.functions.calendar import week_bucket
    samples = settle(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        week_bucket(F.to_date("l_shipdate")).alias("date"), F.col("p_type").alias("lineage"), F.col("l_linestatus").alias("lab")).agg(F.count("*").alias("n")), "samples")
    detailed = epi.variant_shares(samples.filter("lab = 'O'").drop("lab"), "date", "lineage", "n", _LINEAGES, 90)
    coarse = epi.variant_shares(samples.filter("lab = 'F'").drop("lab"), "date", "lineage", "n", _LINEAGES, 90)
    counts = inputs.national(t).select("date", "n")
    return epi.variant_mix(detailed, coarse, counts, "date", "n").select(
        "grp", "date", r6("share").alias("share"), "n", r6("estimate").alias("estimate"))


_TREND = f"""{GRID}, {inputs.PLACES}, sm7 AS (SELECT entity, date, n, CASE WHEN COUNT(n) OVER w >= 3 THEN AVG(n) OVER w END AS ma FROM grid WINDOW w AS ({W} {CENTRE7})),
rk AS (SELECT *, CASE WHEN ma IS NOT NULL THEN rank() OVER (PARTITION BY date ORDER BY ma) + (COUNT(*) OVER (PARTITION BY date, ma) - 1) / 2 END AS rk FROM sm7),
tr AS (SELECT rk.entity, rk.date, n, ma, population, region, ma - LAG(ma, 3) OVER (PARTITION BY rk.entity ORDER BY date) AS dma, rk - LAG(rk, 4) OVER (PARTITION BY rk.entity ORDER BY date) AS drk
  FROM rk JOIN places ON places.entity = rk.entity)"""
_LAST = "WHERE date = (SELECT MAX(date) FROM sm7 WHERE ma IS NOT NULL)"


def _trend(t, style):
    out = epi.trend_table(grid(t), "entity", "date", "n", inputs.places(t), style, width=100.0)
    return out.withColumns({"ma": r6("ma"), "trend": r6("trend")})


@query("r19_trend_per_population", f"""WITH {_TREND}
SELECT entity, region, n, round(ma, 6) AS ma, round(dma / population / ((SELECT MAX(ma) FROM sm7) / (SELECT MAX(population) FROM places)) * 25, 6) AS trend, 'green_up' AS trend_style FROM tr {_LAST}""")
def r19_population(t):
    return _trend(t, "green_up")


@query("r19_trend_rank", f"""WITH {_TREND} SELECT entity, region, n, round(ma, 6) AS ma, round(drk / (SELECT MAX(rk) FROM rk) * 25, 6) AS trend, 'rank_up' AS trend_style FROM tr {_LAST}""")
def r19_rank(t):
    return _trend(t, "rank_up")


@query("r19_trend_absolute", f"""WITH {_TREND} SELECT entity, region, n, round(ma, 6) AS ma, round(ma * 25, 6) AS trend, 'abs' AS trend_style FROM tr {_LAST}""")
def r19_abs(t):
    return _trend(t, "abs")


@query("r20_trend_arrows", """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE (o_totalprice - 250000) / 150000 END AS trend FROM orders),
s AS (SELECT *, round_even(least(greatest(trend, -1), 1) * 2, 0) AS step FROM x)
SELECT o_orderkey, CASE WHEN trend IS NULL THEN '?' WHEN step = 0 THEN '→' WHEN step = 1 THEN '↗' WHEN step = 2 THEN '↑' WHEN step = -1 THEN '↘' ELSE '↓' END AS arrow FROM s""")
def r20(t):
    trend = F.when(F.col("o_orderstatus") != "P", (F.col("o_totalprice") - 250000) / 150000)
    return t.orders.select("o_orderkey", trend_arrow(trend).alias("arrow"))


_WARD = inputs.PLACED + """,
w0 AS (SELECT region AS entity, date, CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(*) FILTER (status <> 'P') AS DOUBLE) AS hospital, CAST(COUNT(*) FILTER (type = '5-LOW') AS DOUBLE) AS field,
  CAST(COUNT(*) FILTER (type = '5-LOW' AND segment = 'BUILDING') AS DOUBLE) AS field_a, CAST(COUNT(*) FILTER (segment = 'MACHINERY' AND status = 'O') AS DOUBLE) AS out,
  CASE WHEN day(date) <> 9 THEN CAST(COUNT(*) FILTER (status = 'F') AS DOUBLE) END AS severe, CASE WHEN day(date) <> 9 THEN CAST(COUNT(*) FILTER (status = 'F' AND type = '1-URGENT') AS DOUBLE) END AS vent FROM placed GROUP BY 1, 2),
ward0 AS (SELECT * REPLACE (SUM(out) OVER (PARTITION BY entity ORDER BY date) AS out), SUM(n) OVER (PARTITION BY entity ORDER BY date) AS cases FROM w0)"""
_WARD_COLS = "entity, date, hospital, field, field_a, out, severe, vent, cases"


@query("r21_condition_split", f"""WITH {_WARD}, {sqltext.interpolated('ward0', 'severe', out='w1')}, w1b AS (SELECT {_WARD_COLS} FROM w1), {sqltext.interpolated('w1b', 'vent', out='w2')},
k AS (SELECT *, COALESCE(severe - vent, 0) + COALESCE(vent, 0) + COALESCE(field, 0) AS known, greatest(field - field_a, 0) AS field_unknown FROM w2)
SELECT entity, date, round(severe - vent, 6) AS severe_only, round(hospital - known, 6) AS hospital_other, field_unknown,
  round(greatest(cases - known - out, 0), 6) AS other_active, round(greatest(hospital - (COALESCE(vent, 0) + COALESCE(severe, 0) + field_unknown + field_a), 0), 6) AS mild FROM k""")
def r21(t):
    s, y, g, day = F.col("status"), F.col("type"), F.col("segment"), F.dayofmonth("date")

    def count(cond):
        return F.count(F.when(cond, 1)).cast("double")

    ward = inputs.placed_orders(t).groupBy(F.col("region").alias("entity"), "date").agg(
        F.count("*").cast("double").alias("n"), count(s != "P").alias("hospital"), count(y == "5-LOW").alias("field"),
        count((y == "5-LOW") & (g == "BUILDING")).alias("field_a"), count((g == "MACHINERY") & (s == "O")).alias("out"),
        count(s == "F").alias("severe"), count((s == "F") & (y == "1-URGENT")).alias("vent"))
    so_far = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    ward = ward.withColumns({"cases": F.sum("n").over(so_far), "out": F.sum("out").over(so_far)}).withColumns(
        {c: F.when(day != 9, F.col(c)) for c in ("severe", "vent")})
    out = epi.condition_split(ward, ["entity"], "date", "hospital", "severe", "vent", "field", ["field_a"], "cases", ["out"])
    return out.select("entity", "date", *[r6(c).alias(c) for c in ("severe_only", "hospital_other", "field_unknown", "other_active", "mild")])


@query("r22_risk_share", f"""WITH {inputs.PLACED}, r AS (SELECT date, COUNT(*) FILTER (status = 'F') AS deaths, COUNT(*) FILTER (status = 'F' AND segment = 'BUILDING') AS risk_a, COUNT(*) FILTER (status = 'F' AND segment = 'HOUSEHOLD') AS risk_b FROM placed GROUP BY 1)
SELECT date, deaths, round(risk_a / NULLIF(deaths, 0) * 100, 6) AS risk_a_pct, round(risk_b / NULLIF(deaths, 0) * 100, 6) AS risk_b_pct FROM r""")
def r22(t):
    dead = F.col("status") == "F"
    r = inputs.placed_orders(t).groupBy("date").agg(
        F.count(F.when(dead, 1)).alias("deaths"), F.count(F.when(dead & (F.col("segment") == "BUILDING"), 1)).alias("risk_a"),
        F.count(F.when(dead & (F.col("segment") == "HOUSEHOLD"), 1)).alias("risk_b"))
    out = epi.shares_of(r, ["risk_a", "risk_b"], "deaths")
    return out.select("date", "deaths", r6("risk_a_pct").alias("risk_a_pct"), r6("risk_b_pct").alias("risk_b_pct"))


@query("r26_deaths_by_band", f"""WITH {inputs.PLACED}, b AS (SELECT {_band_sql('age', [15, 35, 60])} AS band, date, CAST(COUNT(*) AS DOUBLE) AS cases, COUNT(*) FILTER (status = 'F') / COUNT(*) * 100 AS cfr FROM placed GROUP BY 1, 2),
c AS (SELECT band, date, cfr, SUM(cases) OVER (PARTITION BY band ORDER BY date) AS cases_cum FROM b WHERE date >= DATE '1999-04-01' AND band IS NOT NULL)
SELECT band, date, round(CASE WHEN COUNT(cfr) OVER a >= 13 THEN AVG(cfr) OVER a END / 100 * CASE WHEN COUNT(cases_cum) OVER m >= 3 THEN AVG(cases_cum) OVER m END, 4) AS deaths_cum
FROM c WINDOW a AS (PARTITION BY band ORDER BY date ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING), m AS (PARTITION BY band ORDER BY date {CENTRE7})""")
def r26(t):
    b = inputs.placed_orders(t).withColumn("band", reshape.band("age", [15, 35, 60])).filter("band IS NOT NULL").groupBy("band", "date").agg(
        F.count("*").cast("double").alias("cases"), (ratio(F.count(F.when(F.col("status") == "F", 1)), F.count("*"), 100)).alias("cfr"))
    return epi.deaths_by_band(b, ["band"], "date", "cfr", "cases", "1999-04-01").select("band", "date", F.round("deaths_cum", 4).alias("deaths_cum"))


@query("r27_observed_and_forecast", f"""WITH {inputs.NATIONAL}, s AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS model FROM lineitem GROUP BY 1),
o AS (SELECT date, CAST(n AS DOUBLE) AS n FROM nat WHERE date < DATE '2001-06-01'), d AS (SELECT MAX(date) AS today FROM o)
SELECT s.date, CASE WHEN s.date <= today THEN model END AS estimated, CASE WHEN s.date <= today THEN o.n END AS reported, CASE WHEN s.date >= today THEN model END AS forecast
FROM s CROSS JOIN d LEFT JOIN o ON o.date = s.date WHERE s.date <= today + 60""")
def r27(t):
    model = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count("*").cast("double").alias("model"))
    seen = inputs.national(t).filter("date < DATE '2001-06-01'").select("date", F.col("n").cast("double").alias("n"))
    return epi.observed_and_forecast(model, seen, "date", "model", "n")


@query("r28_regional_coverage", f"""WITH {_DOSES}, {inputs.PLACES}, {sqltext.dense('doses', 'dose1')}, ff AS (SELECT entity, date, last_value(dose1 IGNORE NULLS) OVER ({W}) AS dose1 FROM dense),
cf AS (SELECT date FROM ff GROUP BY 1 HAVING COUNT(DISTINCT entity) = (SELECT COUNT(*) FROM nation)),
rg AS (SELECT region, date, SUM(dose1) AS dose1 FROM ff JOIN places USING (entity) WHERE date IN (SELECT date FROM cf) GROUP BY 1, 2),
pp AS (SELECT region, SUM(population) AS population FROM places GROUP BY 1), cv AS (SELECT region, date, NULLIF(dose1 / NULLIF(population, 0) * 100, 0) AS c FROM rg JOIN pp USING (region))
SELECT region, date, round(CASE WHEN c IS NOT NULL THEN MAX(c) OVER (PARTITION BY region ORDER BY date) END, 6) AS coverage FROM cv""")
def r28(t):
    filled = repair.forward_fill(repair.densify(doses(t).select("entity", "date", "dose1"), ["entity"]), ["entity"], "date", "dose1")
    expected = t.nation.agg(F.count("*")).scalar()
    return epi.coverage(filled, inputs.places(t), "entity", "date", "dose1", expected).select("region", "date", r6("coverage").alias("coverage"))


@query("r29_regional_daily_rate", f"""WITH {_DOSES}, {inputs.PLACES}, {sqltext.undipped('doses', 'dose1')}, u2 AS (SELECT entity, date, dose1 FROM undipped), {sqltext.dense('u2', 'dose1')}, {sqltext.interpolated('dense', 'dose1')},
dd AS (SELECT entity, date, dose1 - LAG(dose1) OVER ({W}) AS dose1 FROM filled),
cf AS (SELECT date FROM dd WHERE dose1 IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT entity) = (SELECT COUNT(*) FROM nation)),
pp AS (SELECT region, SUM(population) AS population FROM places GROUP BY 1)
SELECT region, date, round(SUM(dose1) / NULLIF(MAX(pp.population), 0) * 100000, 4) AS rate FROM dd JOIN places USING (entity) JOIN pp USING (region) WHERE date IN (SELECT date FROM cf) GROUP BY 1, 2""")
def r29(t):
    expected = t.nation.agg(F.count("*")).scalar()
    return epi.regional_daily_rate(doses(t), inputs.places(t), "entity", "date", "dose1", expected).select("region", "date", F.round("rate", 4).alias("rate"))
