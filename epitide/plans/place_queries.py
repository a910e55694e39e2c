"""Joins to dimensions, exact and fuzzy."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.functions import calendar as cal
from epitide.model import inline_table
from epitide.operators import places, temporal
from epitide.plans import inputs
from epitide.plans.registry import query
from epitide.sources.stage import settle


@query("j1_dimension_join", f"""WITH {inputs.DAILY}, {inputs.PLACES}
SELECT d.entity, date, p.region AS place_region, population, n FROM daily d LEFT JOIN places p ON p.entity = d.entity""")
def j1(t):
    dim = inputs.places(t).withColumnRenamed("region", "place_region")
    return inputs.daily(t).join(dim, "entity", "left").select("entity", "date", "place_region", "population", "n")


def misspelt(t):
    """Part types with a typing error: a letter lost, doubled or replaced, or the text unusable."""
    k, i = F.col("p_partkey") % 5, (F.col("p_partkey") % 3 + 2).cast("int")
    head, tail = F.substring("p_type", F.lit(1), i - 1), F.substring("p_type", i + 1, F.lit(50))
    letter = F.substring("p_type", i, F.lit(1))
    wrong = (F.when(k == 0, F.col("p_type")).when(k == 1, F.concat(head, tail))
             .when(k == 2, F.concat(head, letter, letter, tail)).when(k == 3, F.concat(head, F.lit("X"), tail))
             .otherwise(F.concat(F.lit("Type "), F.col("p_type"), F.lit("."))))
    wrong = F.when(F.col("p_partkey") % 97 == 0, F.lit("??")).when(F.col("p_partkey") % 89 == 0, None).otherwise(wrong)
    return t.part.select("p_partkey", wrong.alias("written"), "p_size")


MISSPELT = """misspelt AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 97 = 0 THEN '??' WHEN p_partkey % 89 = 0 THEN NULL ELSE
  CASE p_partkey % 5 WHEN 0 THEN p_type WHEN 1 THEN head || tail WHEN 2 THEN head || letter || letter || tail
  WHEN 3 THEN head || 'X' || tail ELSE 'Type ' || p_type || '.' END END AS written
  FROM (SELECT *, substr(p_type, 1, i - 1) AS head, substr(p_type, i + 1, 50) AS tail, substr(p_type, i, 1) AS letter
        FROM (SELECT *, CAST(p_partkey % 3 + 2 AS INTEGER) AS i FROM part)))"""


def kinds(t):
    return t.part.groupBy("p_type").agg(F.count("*").alias("parts"), F.min("p_brand").alias("first_brand"))


KINDS = "kinds AS (SELECT p_type, COUNT(*) AS parts, MIN(p_brand) AS first_brand FROM part GROUP BY 1)"

# Edit similarity at least 0.74, best score then later key; names are trimmed of 'Type ' and dots first.
EDIT_MATCH = f"""{MISSPELT}, {KINDS},
names AS (SELECT DISTINCT written, regexp_replace(regexp_replace(trim(written), '^Type ', ''), '^[ .]+|[ .]+$', '', 'g') AS trimmed FROM misspelt WHERE written IS NOT NULL),
scored AS (SELECT written, p_type, 1 - levenshtein(trimmed, p_type) / greatest(length(trimmed), length(p_type)) AS score
  FROM names, kinds WHERE written NOT IN (SELECT p_type FROM kinds)),
matched AS (SELECT written, p_type AS match, 'fuzzy' AS how FROM scored WHERE score >= 0.74 - 1e-9
    QUALIFY row_number() OVER (PARTITION BY written ORDER BY score DESC, p_type DESC) = 1
  UNION ALL SELECT written, written, 'exact' FROM names WHERE written IN (SELECT p_type FROM kinds))"""


def _trim(c):
    return places.trim_place(c, ["Type "])


@query("j2_fuzzy_join_edit", f"""WITH {EDIT_MATCH}
SELECT p_partkey, m.written, x.match AS matched, k.parts, k.first_brand FROM misspelt m LEFT JOIN matched x ON x.written = m.written
LEFT JOIN kinds k ON k.p_type = x.match""")
def j2(t):
    dim = kinds(t).withColumn("matched", F.col("p_type"))
    return places.fuzzy_join(misspelt(t), dim, "written", "p_type", trim=_trim).select(
        "p_partkey", "written", "matched", "parts", "first_brand")


@query("j2_fuzzy_join_blocks", f"""WITH {EDIT_MATCH}
SELECT p_partkey, x.match AS written, k.parts, k.first_brand FROM misspelt m LEFT JOIN matched x ON x.written = m.written
LEFT JOIN kinds k ON k.p_type = x.match""")
def j2_blocks(t):
    """The written name replaced by the matched one."""
    return places.fuzzy_join(misspelt(t), kinds(t), "written", "p_type", trim=_trim, replace_with="p_type").select(
        "p_partkey", "written", "parts", "first_brand")


WORDS = r"""words AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w FROM {0}))"""


def vocabulary(df, column="w"):
    """Every word of the texts: runs of letters of any script, lower-cased."""
    return df.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias(column)).distinct()


# The SQL engine counts edits in bytes, so each accented letter stands there as one capital or digit, which no word has.
_ACCENTED, _SINGLE = "ßàáâãäåæçèéêëìíîïñòóôõöùúûüýÿœ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123"
assert len(_ACCENTED) == len(_SINGLE)


def _bytes(word):
    return f"translate({word}, '{_ACCENTED}', '{_SINGLE}')"


@query("j2_fuzzy_vocabulary", f"""WITH {WORDS.format('documents')}, dict AS (SELECT w AS d FROM ({'WITH ' + WORDS.format('benchmark')} SELECT w FROM words)),
a AS (SELECT w, length(w) AS lw, {_bytes('w')} AS bw FROM words), b AS (SELECT d, length(d) AS ld, {_bytes('d')} AS bd FROM dict),
s AS (SELECT w, d, 1 - levenshtein(bw, bd) / greatest(lw, ld) AS score FROM a, b WHERE least(lw, ld) >= 0.85 * greatest(lw, ld) - 1e-9)
SELECT w, d AS match, round(score, 6) AS score FROM s WHERE score >= 0.85 - 1e-9 QUALIFY row_number() OVER (PARTITION BY w ORDER BY score DESC, d DESC) = 1""")
def j2_vocabulary(t):
    dictionary = settle(vocabulary(t.benchmark, "d"), "dictionary")
    return places.closest(vocabulary(t.documents), "w", dictionary, "d", 0.85).select(
        "w", "match", F.round("score", 6).alias("score"))


def gazetteer(t):
    """Nations with the other spellings in which their suppliers' rows write them."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("name"), F.col("r_name").alias("region"),
        F.array(F.concat(F.lit("N"), F.col("n_nationkey")), F.regexp_replace("n_name", "_", " No ")).alias("aliases"))


def free_text_places(t):
    k = F.col("s_suppkey") % 4
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit("N"), F.col("n_nationkey")))
        .when(k == 2, F.regexp_replace("n_name", "_", " No ")).otherwise(F.concat(F.lit("Prov. "), F.col("n_name"), F.lit(" State"))).alias("place"))


@query("j3_alias_canonical_names", """SELECT s_suppkey, n_name AS place, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def j3(t):
    aliases = places.alias_table(gazetteer(t), "name", "aliases", ["region"])
    return places.canonical_places(free_text_places(t), aliases, "place", ["region"], cutoff=0.99,
                                   prefixes=["Prov."], suffixes=[" State"]).select("s_suppkey", "place", "region")


@query("j4_match_audit", f"""WITH {EDIT_MATCH}
SELECT m.written, x.match AS guess, COUNT(*) AS count FROM misspelt m LEFT JOIN matched x ON x.written = m.written
WHERE m.written IS NOT NULL AND COALESCE(x.how, '') <> 'exact' GROUP BY 1, 2""")
def j4(t):
    return places.match_audit(misspelt(t), kinds(t), "written", "p_type", trim=_trim)


_GROUPS = [("HOUSEHOLD", "Home"), ("FURNITURE", "Home"), ("MACHINERY", "Works"), ("BUILDING", "Works")]


@query("j5_category_standard", """SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Home'
  WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Works' ELSE 'Unknown' END AS kind,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Home' WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Works' ELSE c_mktsegment END AS kind_or_own FROM customer""")
def j5(t):
    mapping = inline_table(t.spark, "segment string, kind string", _GROUPS)
    people = t.customer.select("c_custkey", "c_mktsegment")
    once = places.standardise(people, "c_mktsegment", mapping, "segment", "kind", "kind")
    return places.standardise(once, "c_mktsegment", mapping, "segment", "kind", "kind_or_own", default=None).select(
        "c_custkey", "kind", "kind_or_own")


@query("j6_alias_enrichment", """WITH f AS (
  SELECT n_name AS alias, n_name AS name, CAST(NULL AS VARCHAR) AS region, 0 AS p FROM nation
  UNION ALL SELECT 'N' || n_nationkey, n_name, NULL, 1 FROM nation
  UNION ALL SELECT n_name, 'ignored', r_name, 2 FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT s_name, n_name, NULL, 3 FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT alias, arg_min(name, p) FILTER (name IS NOT NULL) AS name, arg_min(region, p) FILTER (region IS NOT NULL) AS region FROM f GROUP BY 1""")
def j6(t):
    own = t.nation.select(F.col("n_name").alias("alias"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("region"))
    short = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("alias"), F.col("n_name").alias("name"))
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("alias"), F.lit("ignored").alias("name"), F.col("r_name").alias("region"))
    parts = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("alias"), F.col("n_name").alias("name"))
    return places.merge_aliases(own, short, regions, parts)


@query("j7_parent_by_code", """SELECT c.p_partkey, c.p_name, p.p_name AS parent FROM part c LEFT JOIN part p ON p.p_partkey = c.p_partkey // 100""")
def j7(t):
    return places.attach_parent(t.part.select("p_partkey", "p_name"), "p_partkey", "p_name", "parent")


@query("j8_rebased_cumulative", f"""WITH {inputs.DAILY},
w AS (SELECT entity, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, SUM(value) AS value FROM daily GROUP BY 1, 2, 3),
c AS (SELECT entity, year, month, SUM(value) OVER (PARTITION BY entity, year < 1999 ORDER BY year, month) AS total FROM w),
closing AS (SELECT entity, arg_max(total, (year, month)) AS last FROM c WHERE year < 1999 GROUP BY 1)
SELECT entity, year, month, CASE WHEN year < 1999 THEN total ELSE COALESCE(total + last, total) END AS total FROM c LEFT JOIN closing USING (entity)""")
def j8(t):
    monthly = inputs.daily(t).groupBy("entity", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("value").alias("value"))
    def running(df):
        w = Window.partitionBy("entity").orderBy("year", "month").rowsBetween(Window.unboundedPreceding, 0)
        return df.select("entity", "year", "month", F.sum("value").over(w).alias("total"))
    return places.rebase_cumulative(running(monthly.filter("year < 1999")), running(monthly.filter("year >= 1999")),
                                    ["entity"], ["year", "month"], ["total"])


@query("j9_spread_intervals", f"""WITH {inputs.WEEKLY}
SELECT entity, CAST(unnest(generate_series(date - 6, date, INTERVAL 1 DAY)) AS DATE) AS date, round(value / 7, 6) AS value FROM weekly""")
def j9(t):
    spans = inputs.weekly(t).select("entity", F.date_sub("date", 6).alias("start"), F.col("date").alias("stop"), "value")
    return cal.spread_evenly(spans, "start", "stop", ["value"]).select("entity", "date", inputs.r6("value").alias("value"))


# ---- joins to tables with validity ----------------------------------------------------------------

_HISTORY = f"""{inputs.DAILY}, history AS (SELECT entity, date, value, n FROM daily WHERE n > 1 OR day(date) <= 10)"""


def history(t):
    """Figures of a place that hold until the next ones."""
    return inputs.daily(t).filter("n > 1 OR day(date) <= 10").select("entity", F.col("date").alias("since"), "value", "n")


@query("j9_as_of_history", f"""WITH {_HISTORY}, facts AS (SELECT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS shipped, n_name AS entity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT f.l_orderkey, f.l_partkey, f.shipped, f.entity, h.value, h.n FROM facts f ASOF LEFT JOIN history h ON f.entity = h.entity AND f.shipped >= h.date""")
def j9_as_of(t):
    """Every line item with its supplier's place's figures in force when it was shipped."""
    facts = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("shipped"), F.col("n_name").alias("entity"))
    return temporal.as_of(facts, history(t), ["entity"], "shipped", "since", ["value", "n"], width=366)


@query("j9_open_intervals", """WITH i AS (SELECT o_orderpriority AS type, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) END AS b FROM orders),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT date, type, COUNT(*) AS open FROM days JOIN i ON date >= a AND (b IS NULL OR date <= b) GROUP BY 1, 2""")
def j9_open(t):
    """How many orders are open on each day; some are never closed."""
    start = F.to_date("o_orderdate")
    spans = t.orders.select(F.col("o_orderpriority").alias("type"), start.alias("opened"),
                            F.when(F.col("o_orderkey") % 50 != 0, F.date_add(start, (F.col("o_orderkey") % 45).cast("int"))).alias("closed"))
    days = t.orders.select(start.alias("date")).distinct()
    return temporal.interval_join(days, spans, "date", "opened", "closed").groupBy("date", "type").agg(F.count("*").alias("open"))


@query("a7_bands_from_table", """WITH b AS (SELECT p_brand AS brand, p_partkey AS band, p_size AS lo, p_size + p_partkey % 9 AS hi FROM part WHERE p_partkey % 5 = 0)
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, band FROM lineitem JOIN part ON l_partkey = p_partkey JOIN b ON brand = p_brand AND l_quantity BETWEEN lo AND hi""")
def a7_bands(t):
    """Quantities in the bands of their brand; bands are rows of a table and may overlap."""
    bands = t.part.filter("p_partkey % 5 = 0").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("band"), F.col("p_size").alias("lo"),
                                                    (F.col("p_size") + F.col("p_partkey") % 9).alias("hi"))
    facts = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.col("p_brand").alias("brand"))
    return temporal.interval_join(facts, bands, "l_quantity", "lo", "hi", ["brand"], repeated=True).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "band")
