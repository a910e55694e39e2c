"""Row-level expressions and calendar operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from epitide.functions import calendar as cal
from epitide.functions import scalar as sc
from epitide.operators import reshape
from epitide.plans import inputs
from epitide.plans.inputs import r6
from epitide.plans.registry import query

# ---- F ------------------------------------------------------------------------------------------


@query("f1_rename_and_select", """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS "Date", o_totalprice AS "Cases Total",
  o_orderstatus AS "Cases Status" FROM orders""")
def f1(t):
    renamed = t.orders.withColumnsRenamed({
        "o_orderkey": "id", "o_orderdate": "Date", "o_totalprice": "Cases Total", "o_orderstatus": "Cases Status"})
    keep = ["id", "Date"] + [c for c in renamed.columns if c.startswith("Cases")]
    return renamed.select(keep).withColumn("Date", F.to_date("Date"))


@query("f2_date_slices", f"""WITH {inputs.NATIONAL}
SELECT '3' AS period, date, n FROM nat WHERE date >= DATE '1999-04-01'
UNION ALL SELECT 'between', date, n FROM nat WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'
UNION ALL (SELECT '30d', date, n FROM nat ORDER BY date DESC LIMIT 30)""")
def f2(t):
    nat = inputs.national(t).select("date", "n")
    named = reshape.named_periods(nat, "date", {"3": ("1999-04-01", None), "between": ("1996-01-01", "1996-06-30")})
    return named.unionByName(reshape.last_rows(nat, "date", 30).withColumn("period", F.lit("30d")))


@query("f3_row_filters", f"""WITH {inputs.DAILY}
SELECT entity, date, n FROM daily WHERE entity <> 'NATION_0'
  AND date IN (SELECT date FROM daily GROUP BY 1 HAVING SUM(n) >= 5)""")
def f3(t):
    d = inputs.daily(t).filter(F.col("entity").isNotNull() & (F.col("entity") != "NATION_0"))
    return reshape.enough_samples(d, inputs.daily(t), "date", "n", 5).select("entity", "date", "n")


_RAW = "format('{:,}', CAST(round(o_totalprice) AS BIGINT))"


@query("f4_clean_numbers", f"""WITH raw AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '-' WHEN o_orderkey % 7 = 1 THEN '%null%'
  WHEN o_orderkey % 7 = 2 THEN 'n/a' ELSE {_RAW} END AS text FROM orders)
SELECT o_orderkey, text, CASE WHEN text = '-' THEN 0.0::DOUBLE WHEN text LIKE '%null%' THEN NULL
  ELSE TRY_CAST(replace(text, ',', '') AS DOUBLE) END AS value FROM raw""")
def f4(t):
    k = F.col("o_orderkey") % 7
    text = (F.when(k == 0, "-").when(k == 1, "%null%").when(k == 2, "n/a")
            .otherwise(F.format_number(inputs.units("o_totalprice"), 0)))
    return t.orders.select("o_orderkey", text.alias("text")).withColumn("value", sc.clean_number("text"))


@query("f5_sentinels", """SELECT l_orderkey, l_linenumber, l_partkey, NULLIF(l_discount, 0) AS discount,
  CASE WHEN l_tax <> 0 THEN round(l_discount / l_tax, 6) END AS ratio,
  CASE WHEN CAST(l_shipdate AS DATE) < DATE '1996-01-01' THEN COALESCE(NULLIF(l_tax, 0.08), 0) ELSE l_tax END AS tax FROM lineitem""")
def f5(t):
    early = F.to_date("l_shipdate") < F.lit("1996-01-01").cast("date")
    raw = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(sc.ratio("l_discount", "l_tax"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", sc.null_if("l_discount", 0.0).alias("discount"),
        r6(sc.finite(raw)).alias("ratio"),
        F.when(early, F.coalesce(sc.null_if("l_tax", 0.08), F.lit(0.0))).otherwise(F.col("l_tax")).alias("tax"))


@query("f6_strip_affixes", """SELECT s_suppkey, regexp_replace(regexp_replace(s_name, '^Supplier#', ''), '^0000', '') AS no_prefix,
  regexp_replace(s_name, '7$', '') AS no_suffix FROM supplier""")
def f6(t):
    return t.supplier.select("s_suppkey", sc.strip_prefixes("s_name", "Supplier#", "0000").alias("no_prefix"),
                             sc.strip_suffixes("s_name", "7").alias("no_suffix"))


@query("f7_first_match", """SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'RED|BLUE', 'i') THEN 'bright'
  WHEN regexp_matches(p_name, 'small', 'i') THEN 'little' ELSE p_name END AS label,
  CASE WHEN starts_with(upper(p_type), 'STA') THEN 'Standard' WHEN starts_with(upper(p_type), 'S') THEN 'S group'
  WHEN starts_with(upper(p_type), 'M') THEN 'M group' ELSE 'Other' END AS grp FROM part""")
def f7(t):
    return t.part.select(
        "p_partkey", sc.first_match("p_name", [("RED|BLUE", "bright"), ("small", "little")]).alias("label"),
        sc.prefix_group("p_type", [("M", "M group"), ("S", "S group"), ("STA", "Standard")]).alias("grp"))


@query("f8_any_all", """SELECT doc_id, (contains(text, 'the') OR contains(text, 'die')) AS any_word,
  (contains(text, 'the') AND contains(text, 'and')) AS all_words, regexp_matches(text, '[0-9]{3}') AS has_number FROM documents""")
def f8(t):
    return t.documents.select(
        "doc_id", sc.any_in("text", "the", "die").alias("any_word"), sc.all_in("text", "the", "and").alias("all_words"),
        sc.any_in("text", "[0-9]{3}", regex=True).alias("has_number"))


@query("f9_relabel_groups", r"""SELECT p_partkey, regexp_replace(regexp_replace(p_brand, '^Brand#(\d+)$', 'Dose \1'), 'Dose 1$', 'First dose') AS label FROM part""")
def f9(t):
    return t.part.select("p_partkey", sc.relabel("p_brand", [(r"^Brand#(\d+)$", "Dose $1"), ("Dose 1$", "First dose")]).alias("label"))


def _sensible_sql(x: str) -> str:
    def trim(places):
        return f"regexp_replace(printf('%.{places}f', round_even({x}, {places})), '\\.?0+$', '')"
    return (f"CASE WHEN {x} IS NULL THEN '' WHEN abs({x}) < 10 THEN {trim(2)} WHEN abs({x}) < 100 THEN {trim(1)} "
            f"ELSE printf('%.0f', round_even({x}, 0)) END")


@query("f10_human_numbers", f"""WITH c AS (SELECT c_custkey, c_acctbal, CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS total
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN abs(total) >= 1e9 THEN total / 1e9 WHEN abs(total) >= 1e6 THEN total / 1e6 WHEN abs(total) >= 1e3 THEN total / 1e3 ELSE total END AS scaled,
  CASE WHEN abs(total) >= 1e9 THEN 'G' WHEN abs(total) >= 1e6 THEN 'M' WHEN abs(total) >= 1e3 THEN 'k' ELSE '' END AS suffix FROM c)
SELECT c_custkey, {_sensible_sql('scaled')} || suffix AS human, {_sensible_sql('c_acctbal')} || '%' AS percent FROM s""")
def f10(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum(inputs.units("o_totalprice")).cast("double").alias("total"))
    return t.customer.join(totals, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", sc.human_format("total").alias("human"), sc.percent_format("c_acctbal").alias("percent"))


@query("f11_clip", """SELECT o_orderkey, greatest(o_totalprice, 50000.0::DOUBLE) AS lower_clip, least(greatest(o_totalprice, 50000.0::DOUBLE), 200000.0::DOUBLE) AS both_clip,
  CASE WHEN o_orderstatus <> 'P' THEN least(o_totalprice, 100000.0::DOUBLE) END AS null_safe FROM orders""")
def f11(t):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return t.orders.select("o_orderkey", sc.clip("o_totalprice", 50000.0).alias("lower_clip"),
                           sc.clip("o_totalprice", 50000.0, 200000.0).alias("both_clip"),
                           sc.clip(price, upper=100000.0).alias("null_safe"))


_BY_STATUS = inputs.PLACED + """,
w AS (SELECT entity, date, CAST(SUM(amount) FILTER (status = 'F') AS DOUBLE) AS f, CAST(SUM(amount) FILTER (status = 'O') AS DOUBLE) AS o,
  CAST(SUM(amount) FILTER (status = 'P') AS DOUBLE) AS p FROM placed GROUP BY 1, 2)"""


def _by_status(t):
    s = lambda x: F.sum(F.when(F.col("status") == x, F.col("amount"))).cast("double")
    return inputs.placed_orders(t).groupBy("entity", "date").agg(s("F").alias("f"), s("O").alias("o"), s("P").alias("p"))


@query("f12_null_aware_arithmetic", f"""WITH {_BY_STATUS}
SELECT entity, date, f - o AS strict, CASE WHEN f IS NOT NULL OR o IS NOT NULL THEN COALESCE(f, 0) - COALESCE(o, 0) END AS filled,
  CASE WHEN f IS NOT NULL OR p IS NOT NULL THEN COALESCE(f, 0) + COALESCE(p, 0) END AS added FROM w""")
def f12(t):
    return _by_status(t).select("entity", "date", sc.subtract("f", "o").alias("strict"),
                                sc.subtract("f", "o", 0.0).alias("filled"), sc.add("f", "p", 0.0).alias("added"))


@query("f13_row_aggregates", f"""WITH {_BY_STATUS}
SELECT entity, date, COALESCE(f, 0) + COALESCE(o, 0) + COALESCE(p, 0) AS skip, f + o + p AS strict,
  CASE WHEN COALESCE(f, o) IS NOT NULL THEN COALESCE(f, 0) + COALESCE(o, 0) END AS min1,
  round((COALESCE(f, 0) + COALESCE(o, 0) + COALESCE(p, 0)) / (CAST(f IS NOT NULL AS INT) + CAST(o IS NOT NULL AS INT) + CAST(p IS NOT NULL AS INT)), 4) AS mean,
  least(f, o, p) AS lo, greatest(f, o, p) AS hi FROM w""")
def f13(t):
    cs = ["f", "o", "p"]
    return _by_status(t).select(
        "entity", "date", sc.row_sum(cs).alias("skip"), sc.row_sum(cs, "strict").alias("strict"),
        sc.row_sum(["f", "o"], "min1").alias("min1"), F.round(sc.row_mean(cs), 4).alias("mean"),
        F.least(*cs).alias("lo"), F.greatest(*cs).alias("hi"))


@query("f14_reorder_columns", f"WITH {_BY_STATUS} SELECT date, entity, p, o, f FROM w")
def f14(t):
    df = _by_status(t)
    return df.select(sc.front(sc.front(df.columns, "date", "entity"), "o", "f", first=False))


@query("f15_unit_rates", f"""WITH {_BY_STATUS}
SELECT entity, date, round(f / NULLIF(o, 0) * 100, 5) AS positivity, round(o / NULLIF(f, 0), 5) AS per_case,
  round(p / NULLIF(f + o + p, 0) * 100, 5) AS share FROM w""")
def f15(t):
    return _by_status(t).select(
        "entity", "date", F.round(sc.ratio("f", "o", 100), 5).alias("positivity"),
        F.round(sc.ratio("o", "f"), 5).alias("per_case"),
        F.round(sc.ratio("p", sc.row_sum(["f", "o", "p"], "strict"), 100), 5).alias("share"))


@query("f16_inverted_rescale", f"""WITH {inputs.NATIONAL}, m AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM nat)
SELECT date, round((1 + (lo - value) / NULLIF(hi - lo, 0)) * 100, 5) AS reduced FROM nat, m""")
def f16(t):
    return reshape.inverted_rescale(inputs.national(t), "value", "reduced").select("date", F.round("reduced", 5).alias("reduced"))


@query("f17_family_rate", f"""WITH {inputs.PLACED},
e AS (SELECT entity, region, date, COUNT(*) FILTER (status = 'F') AS pos, COUNT(*) AS tests FROM placed GROUP BY ALL),
r AS (SELECT region, date, AVG(pos / tests) * 100 AS positivity FROM e GROUP BY 1, 2)
SELECT region, date, round(positivity, 6) AS positivity FROM r""")
def f17(t):
    cells = inputs.placed_orders(t).groupBy("entity", "region", "date").agg(
        F.count(F.when(F.col("status") == "F", 1)).alias("pos"), F.count("*").alias("tests"))
    return reshape.family_rate(cells, ["region", "date"], ["entity"], "pos", "tests", "positivity").withColumn(
        "positivity", r6("positivity"))


# ---- D ------------------------------------------------------------------------------------------

@query("d1_day_range", """SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS date FROM orders""")
def d1(t):
    spans = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("a"),
                            F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")).alias("b"))
    return cal.expand_days(spans, "a", "b").select("o_orderkey", "date")


@query("d2_week_end_date", """WITH w AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(strftime(o_orderdate, '%U') AS INTEGER) AS week FROM orders)
SELECT year, week, CAST(strptime(concat(year, '-01-01'), '%Y-%m-%d') AS DATE) + CAST((7 - dayofweek(make_date(year, 1, 1))) % 7 + (week - 1) * 7 + 6 AS INTEGER) AS date,
  CAST(strptime(concat(year, '-01-01'), '%Y-%m-%d') AS DATE) + CAST((7 - dayofweek(make_date(year, 1, 1))) % 7 + (week - 1) * 7 + 2 AS INTEGER) AS tuesday,
  CASE WHEN week > 2 THEN 2022 ELSE 2023 END AS guessed_year FROM w""")
def d2(t):
    weeks = t.orders.select(F.year("o_orderdate").alias("year"), cal.sunday_week(F.to_date("o_orderdate")).alias("week")).distinct()
    return weeks.select("year", "week", cal.week_end("year", "week").alias("date"), cal.week_end("year", "week", 4).alias("tuesday"),
                        cal.infer_year("week", dt.date(2023, 1, 10)).alias("guessed_year"))


@query("d3_epoch_weeks", """SELECT week, count(*) AS n, CASE WHEN week < 100 THEN DATE '1994-12-27' + 7 * week ELSE DATE '1995-01-01' + 7 * week END AS date
FROM (SELECT CAST(floor((CAST(o_orderdate AS DATE) - DATE '1994-12-27') / 7) AS INTEGER) AS week FROM orders) GROUP BY 1, 3""")
def d3(t):
    weeks = t.orders.select(F.floor(F.datediff(F.to_date("o_orderdate"), F.lit("1994-12-27").cast("date")) / 7).cast("int").alias("week"))
    counts = weeks.groupBy("week").agg(F.count("*").alias("n"))
    return counts.withColumn("date", cal.anchored_week("week", [(0, "1994-12-27"), (100, "1995-01-01")]))


@query("d4_months", """SELECT CAST(last_day(o_orderdate) AS DATE) AS month_end, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS next_month,
  strftime(date_trunc('month', o_orderdate), '%B') AS month, CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS amount FROM orders GROUP BY 1, 2, 3""")
def d4(t):
    monthly = t.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(
        F.sum(inputs.units("o_totalprice")).alias("amount"))
    end = cal.month_end("y", "m")
    return monthly.select(end.alias("month_end"), cal.month_start(end, 1).alias("next_month"), cal.month_name(end).alias("month"), "amount")


@query("d5_weekly_resample", f"""WITH {inputs.NATIONAL}
SELECT date + CAST(6 - dayofweek(date) AS INTEGER) AS week_end, round(AVG(n), 6) AS n FROM nat GROUP BY 1""")
def d5(t):
    return inputs.national(t).groupBy(cal.week_bucket("date").alias("week_end")).agg(r6(F.avg("n")).alias("n"))


@query("d6_calendar_years", """WITH y AS (SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN year(o_orderdate) + 543 WHEN 1 THEN (year(o_orderdate) + 543) % 100
  WHEN 2 THEN year(o_orderdate) ELSE (year(o_orderdate) % 100) END AS INTEGER) AS y FROM orders)
SELECT o_orderkey, y, CAST(CASE WHEN y < 100 THEN y + 2500 ELSE y END - 543 AS INTEGER) AS plain,
  CAST(CASE WHEN y > 2500 OR (y > 60 AND y < 100) THEN CASE WHEN y < 100 THEN y + 2500 ELSE y END - 543 ELSE y END AS INTEGER) AS guessed,
  CAST(CASE WHEN y < 100 THEN y + 2000 ELSE y END + 543 AS INTEGER) AS buddhist FROM y""")
def d6(t):
    y, k = F.year("o_orderdate"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, y + 543).when(k == 1, (y + 543) % 100).when(k == 2, y).otherwise(y % 100)
    return t.orders.select("o_orderkey", raw.alias("y")).select(
        "o_orderkey", "y", cal.to_gregorian_year("y").alias("plain"), cal.to_gregorian_year("y", guess=True).alias("guessed"),
        cal.to_buddhist_year("y").alias("buddhist"))


@query("d7_swapped_dates", """SELECT o_orderkey, CASE WHEN day(o_orderdate) < 13 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
  ELSE CAST(o_orderdate AS DATE) END AS date FROM orders""")
def d7(t):
    return t.orders.select("o_orderkey", cal.swap_day_month(F.to_date("o_orderdate")).alias("date"))


@query("d8_previous_day_of_month", """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS stop, CAST(1 + o_orderkey % 31 AS INTEGER) AS day FROM orders),
c AS (SELECT o_orderkey, stop, day, stop - CAST(k AS INTEGER) AS d FROM d, range(0, 62) r(k))
SELECT o_orderkey, stop, day, MAX(d) AS start FROM c WHERE day(d) = day GROUP BY 1, 2, 3""")
def d8(t):
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("stop"), (F.col("o_orderkey") % 31 + 1).cast("int").alias("day")).withColumn(
        "start", cal.previous_day_of_month("stop", "day"))
