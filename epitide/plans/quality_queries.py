"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.model import inline_table
from epitide.operators import quality
from epitide.plans import inputs
from epitide.plans.inputs import r6
from epitide.plans.registry import query
from epitide.sources.stage import settle

W = "PARTITION BY entity ORDER BY date"


@query("q1_cumulative_continuity", f"""WITH {inputs.CUMULATIVE},
l AS (SELECT entity, arg_max(COALESCE(value, 0), date) AS last FROM cum WHERE date < DATE '1998-03-13' GROUP BY 1),
f AS (SELECT entity, arg_min(COALESCE(value, 0) - 500000, date) AS next FROM cum WHERE date >= DATE '1998-03-13' GROUP BY 1)
SELECT entity, 'value' AS metric, last, next, next - last AS difference FROM l JOIN f USING (entity) WHERE next < last""")
def q1(t):
    c = inputs.cumulative(t)
    old, new = c.filter("date < DATE '1998-03-13'"), c.filter("date >= DATE '1998-03-13'").withColumn("value", F.coalesce("value", F.lit(0.0)) - 500000)
    return quality.continuity(old, new, ["entity"], "date", "value")


# Fixed rules of the example.
RULES = [
    ("cases", "1996-01-01", "2001-12-31", 1.0, 2.0),
    ("cases", "1998-01-01", "1998-12-31", None, 1.0),
    ("value", "1995-01-01", "2001-12-31", 20000.0, None),
]
_RULES_SQL = """rules(metric, a, b, lo, hi) AS (VALUES ('cases', DATE '1996-01-01', DATE '2001-12-31', 1.0, 2.0), ('cases', DATE '1998-01-01', DATE '1998-12-31', NULL, 1.0),
  ('value', DATE '1995-01-01', DATE '2001-12-31', 20000.0, NULL)),
checked AS (SELECT p.*, NOT EXISTS (SELECT 1 FROM rules r WHERE r.metric = p.metric AND p.date BETWEEN a AND b
  AND (p.value IS NULL OR COALESCE(p.value < lo, false) OR COALESCE(p.value > hi, false))) AS valid FROM published p)"""


def _checked(t):
    rules = inline_table(t.spark, "metric string, start date, end date, min double, max double", RULES)
    return quality.cell_validity(inputs.published(t), rules)


@query("q2_cell_validity", f"WITH {inputs.PUBLISHED}, {_RULES_SQL} SELECT entity, date, source, metric, value, valid FROM checked")
def q2(t):
    return _checked(t)


@query("q2_refetch_list", f"""WITH {inputs.PUBLISHED}, {_RULES_SQL}
SELECT entity, date, source, array_to_string(list_sort(list(metric)), ',') AS metrics FROM checked WHERE NOT valid GROUP BY 1, 2, 3""")
def q2_refetch(t):
    return quality.to_refetch(_checked(t), ["entity", "date", "source"]).withColumn("metrics", F.array_join("metrics", ","))


@query("q3_reconciliation", """WITH p AS (SELECT l_orderkey, SUM(CAST(round(l_extendedprice) AS BIGINT)) AS parts FROM lineitem GROUP BY 1),
r AS (SELECT o_orderkey, CAST(CAST(round(o_totalprice) AS BIGINT) AS DOUBLE) AS total, CAST(parts AS DOUBLE) AS parts,
  COALESCE(parts, 0) / NULLIF(CAST(CAST(round(o_totalprice) AS BIGINT) AS DOUBLE), 0) AS ratio FROM orders LEFT JOIN p ON l_orderkey = o_orderkey)
SELECT o_orderkey, total, parts, round(ratio, 6) AS ratio FROM r WHERE NOT COALESCE(ratio >= 0.77 AND ratio <= 1.3, false)
  AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def q3(t):
    parts = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), inputs.units("l_extendedprice").alias("part"))
    totals = t.orders.select("o_orderkey", inputs.units("o_totalprice").alias("price"), "o_orderstatus")
    return quality.reconcile(parts, totals, ["o_orderkey"], "part", "price", 0.77, 1.3, F.col("o_orderstatus") == "P").withColumn("ratio", r6("ratio"))


@query("q4_incomplete_periods", f"""WITH {inputs.CUBE}, m AS (SELECT year, month, COUNT(*) AS rows, SUM(deaths) AS total FROM cube GROUP BY 1, 2)
SELECT * FROM m WHERE rows < 690 OR NOT COALESCE(total > 18000, false)""")
def q4(t):
    return quality.incomplete_periods(inputs.cube(t), ["year", "month"], "deaths", 690, 18000)


@query("q5_extract_differences", f"""WITH {inputs.PUBLISHED}, a AS (SELECT * FROM published WHERE source = 'F'), b AS (SELECT * FROM published WHERE source = 'O')
SELECT a.entity, a.date, a.metric, a.value AS first, b.value AS second FROM a JOIN b USING (entity, date, metric)
WHERE COALESCE(a.value, 0) <> 0 AND COALESCE(b.value, 0) <> 0 AND a.value <> b.value""")
def q5(t):
    wide = inputs.published(t).groupBy("entity", "date", "source").pivot("metric", ["value", "cases"]).agg(F.first("value"))
    a, b = (wide.filter(F.col("source") == s) for s in ("F", "O"))
    return quality.extract_differences(a, b, ["entity", "date"], ["value", "cases"])


@query("q6_missing_cells", f"""WITH {inputs.PUBLISHED}, {_RULES_SQL}
SELECT date, entity, source FROM (SELECT DISTINCT date FROM published) CROSS JOIN (SELECT DISTINCT entity FROM published) CROSS JOIN (SELECT DISTINCT source FROM published)
EXCEPT SELECT date, entity, source FROM checked GROUP BY 1, 2, 3 HAVING bool_and(valid)""")
def q6(t):
    obs = settle(_checked(t), "cells")
    passed = obs.groupBy("date", "entity", "source").agg(F.bool_and("valid").alias("ok")).filter("ok")
    return quality.missing_cells(passed, {"entity": obs, "date": obs, "source": obs})


@query("q7_repeated_keys", """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def q7(t):
    return quality.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q7_percent_bounds", """SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * 1200, 6) AS pct FROM lineitem WHERE l_discount * 1200 > 100 OR l_discount * 1200 < 0""")
def q7_bounds(t):
    pct = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") * 1200).alias("pct"))
    return quality.out_of_bounds(pct, "pct", 0, 100).withColumn("pct", r6("pct"))


@query("q8_jump_test", f"""WITH {inputs.DAILY}, c AS (SELECT entity, date, value, (value - LAG(value) OVER ({W})) / NULLIF(LAG(value) OVER ({W}), 0) * 100 AS change FROM daily)
SELECT entity, date, value, round(change, 5) AS change FROM c WHERE abs(change) > 300""")
def q8(t):
    return quality.jumps(inputs.daily(t).select("entity", "date", "value"), ["entity"], "date", "value", 300).withColumn("change", F.round("change", 5))


def manifests(t):
    """What is cached and what is offered: document slices with different lengths and dates."""
    d = t.documents.select("doc_id", "n_chars", "lang", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")).alias("modified"))
    k = F.col("doc_id") % 6
    cached = d.filter("lang <> 'es'").select("doc_id", "modified", F.when(k == 1, F.lit(0)).when(k == 2, F.col("n_chars") - 1).when(k == 3, F.col("n_chars") + 5).otherwise(F.col("n_chars")).alias("size"))
    remote = d.filter("lang <> 'de'").select("doc_id", F.when(k == 4, F.date_add("modified", 3)).otherwise(F.col("modified")).alias("modified"), F.col("n_chars").alias("size"))
    return cached, remote


@query("q9_freshness_actions", """WITH d AS (SELECT doc_id, n_chars, lang, DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS m, doc_id % 6 AS k FROM documents),
c AS (SELECT doc_id, m AS cm, CASE k WHEN 1 THEN 0 WHEN 2 THEN n_chars - 1 WHEN 3 THEN n_chars + 5 ELSE n_chars END AS cs FROM d WHERE lang <> 'es'),
r AS (SELECT doc_id, CASE WHEN k = 4 THEN m + 3 ELSE m END AS rm, n_chars AS rs FROM d WHERE lang <> 'de'),
j AS (SELECT *, COALESCE(cs IS NULL OR cs <> rs OR rm > cm, false) AS stale FROM c FULL JOIN r USING (doc_id))
SELECT doc_id, CASE WHEN rs IS NULL AND rm IS NULL THEN 'gone' WHEN stale AND DATE '2024-11-01' - rm > 200 THEN 'too old' WHEN cs IS NULL THEN 'new' WHEN cs = 0 THEN 'fetch'
  WHEN cs < rs THEN 'resume' WHEN stale THEN 'fetch' ELSE 'keep' END AS action FROM j""")
def q9(t):
    cached, remote = manifests(t)
    return quality.freshness(cached, remote, "doc_id", F.lit("2024-11-01").cast("date"), 200)


@query("q10_newer_snapshot_gate", f"""WITH {inputs.DAILY}, s AS (SELECT entity, date, SUM(value) OVER ({W}) AS total, n FROM daily),
y AS (SELECT entity, date + 1 AS date, total AS c, n AS d FROM s)
SELECT s.entity, s.date, s.total, s.n FROM s LEFT JOIN y ON y.entity = s.entity AND y.date = s.date WHERE y.date IS NULL OR (c < total AND d <> n)""")
def q10(t):
    w = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    series = inputs.daily(t).select("entity", "date", F.sum("value").over(w).alias("total"), "n")
    return quality.newer_snapshots(series, series, ["entity"], "date", "total", "n")


@query("q11_accounting_identities", f"""WITH {inputs.PLACED}, r AS (SELECT entity, date, COUNT(*) AS n, COUNT(*) FILTER (status = 'F') AS f, COUNT(*) FILTER (status = 'O') AS o, COUNT(*) FILTER (type = '1-URGENT') AS u FROM placed GROUP BY 1, 2),
v AS (SELECT entity, date, 'parts equal whole' AS rule FROM r WHERE NOT (f + o = n) UNION ALL SELECT entity, date, 'subset of whole' FROM r WHERE NOT (u <= f)
  UNION ALL SELECT entity, date, 'not increasing' FROM r WHERE NOT (n >= f AND f >= o) UNION ALL SELECT entity, date, 'plausible range' FROM r WHERE NOT (n BETWEEN 1 AND 4)
  UNION ALL SELECT entity, date, 'tolerance band' FROM r WHERE NOT ((f + o) / n BETWEEN 0.94 AND 1.01))
SELECT * FROM v WHERE NOT (rule = 'plausible range' AND date < DATE '1997-01-01')""")
def q11(t):
    s = F.col("status")
    r = inputs.placed_orders(t).groupBy("entity", "date").agg(
        F.count("*").alias("n"), F.count(F.when(s == "F", 1)).alias("f"), F.count(F.when(s == "O", 1)).alias("o"),
        F.count(F.when(F.col("type") == "1-URGENT", 1)).alias("u"))
    known = r.filter("date < DATE '1997-01-01'").select("entity", "date", F.lit("plausible range").alias("rule"))
    return quality.rule_violations(r, ["entity", "date"], {
        "parts equal whole": F.expr("f + o = n"), "subset of whole": F.expr("u <= f"), "not increasing": F.expr("n >= f AND f >= o"),
        "plausible range": F.expr("n BETWEEN 1 AND 4"), "tolerance band": F.expr("try_divide(f + o, n) BETWEEN 0.94 AND 1.01"),
    }, known)
