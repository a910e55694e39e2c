"""Panel inputs derived from the given tables, once for Spark and once as SQL text.

Amounts are summed as whole units (exact in a double), so the order of summation cannot matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitide.plans.registry import Tables


def units(c: str):
    return F.round(F.col(c)).cast("bigint")


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---- orders with their place ----------------------------------------------------------------

def placed_orders(t: Tables) -> DataFrame:
    """Orders as a line list: id, date, place, region, type, status, segment, age, amount."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("person"),
            F.to_date("o_orderdate").alias("date"),
            F.col("n_name").alias("entity"),
            F.col("r_name").alias("region"),
            F.col("o_orderpriority").alias("type"),
            F.col("o_orderstatus").alias("status"),
            F.col("c_mktsegment").alias("segment"),
            F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"),
            units("o_totalprice").alias("amount"),
        )
    )


PLACED = """placed AS (
  SELECT o_orderkey AS id, o_custkey AS person, CAST(o_orderdate AS DATE) AS date, n_name AS entity, r_name AS region,
         o_orderpriority AS type, o_orderstatus AS status, c_mktsegment AS segment,
         CAST(floor(c_acctbal / 100) AS INTEGER) AS age, CAST(round(o_totalprice) AS BIGINT) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def daily(t: Tables) -> DataFrame:
    """(entity, region, date, value, n): one row per place and day with any order."""
    return placed_orders(t).groupBy("entity", "region", "date").agg(
        F.sum("amount").cast("double").alias("value"), F.count("*").alias("n"))


DAILY = PLACED + """,
daily AS (SELECT entity, region, date, CAST(SUM(amount) AS DOUBLE) AS value, COUNT(*) AS n
          FROM placed GROUP BY ALL)"""


def national(t: Tables) -> DataFrame:
    """(date, value, n) over all places."""
    return t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.sum(units("o_totalprice")).cast("double").alias("value"), F.count("*").alias("n"))


NATIONAL = """nat AS (SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS value, COUNT(*) AS n
  FROM orders GROUP BY 1)"""


# ---- three publishers of the same figures -----------------------------------------------------

SOURCES_IN_ORDER = ["F", "O", "P"]


def published(t: Tables) -> DataFrame:
    """Long observations from three overlapping sources; source F leaves its values out mid-month."""
    cells = placed_orders(t).groupBy("entity", "date", F.col("status").alias("source")).agg(
        F.sum("amount").cast("double").alias("value"), F.count("*").cast("double").alias("cases"))
    cells = cells.withColumn(
        "value", F.when(~((F.col("source") == "F") & (F.dayofmonth("date") == 15)), F.col("value")))
    return cells.unpivot(["entity", "date", "source"], ["value", "cases"], "metric", "value")


PUBLISHED = PLACED + """,
published AS (
  SELECT entity, date, status AS source, unnest(['value', 'cases']) AS metric,
         unnest([CASE WHEN status = 'F' AND day(date) = 15 THEN NULL ELSE CAST(SUM(amount) AS DOUBLE) END,
                 CAST(COUNT(*) AS DOUBLE)]) AS value
  FROM placed GROUP BY entity, date, status)"""


# ---- a cumulative series with faults ----------------------------------------------------------

def cumulative(t: Tables) -> DataFrame:
    """(entity, date, value): running totals, too low on each 13th, missing on each 20th."""
    w = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("value").over(w)
    day = F.dayofmonth("date")
    return daily(t).select(
        "entity", "date",
        F.when(day == 13, total - 300000).when(day != 20, total).alias("value"))


CUMULATIVE = DAILY + """,
running AS (SELECT entity, date, SUM(value) OVER (PARTITION BY entity ORDER BY date) AS total FROM daily),
cum AS (SELECT entity, date, CASE WHEN day(date) = 13 THEN total - 300000 WHEN day(date) <> 20 THEN total END AS value
        FROM running)"""


# ---- weekly figures ---------------------------------------------------------------------------

def weekly(t: Tables) -> DataFrame:
    """(entity, date, value): totals stamped with the Saturday closing the week."""
    from epitide.functions.calendar import week_bucket
    return placed_orders(t).groupBy("entity", week_bucket("date").alias("date")).agg(
        F.sum("amount").cast("double").alias("value"))


WEEKLY = PLACED + """,
weekly AS (SELECT entity, date + CAST(6 - dayofweek(date) AS INTEGER) AS date, CAST(SUM(amount) AS DOUBLE) AS value
           FROM placed GROUP BY 1, 2)"""


# ---- place dimension and demographic cube -----------------------------------------------------

def places(t: Tables) -> DataFrame:
    """Gazetteer: name, region, population (customers living there)."""
    people = t.customer.groupBy("c_nationkey").agg(F.count("*").cast("double").alias("population"))
    return (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(people, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select(F.col("n_name").alias("entity"), F.col("r_name").alias("region"), "population"))


PLACES = """places AS (
  SELECT n_name AS entity, r_name AS region, CAST(p.n AS DOUBLE) AS population
  FROM nation JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1) p ON p.c_nationkey = n_nationkey)"""


def cube(t: Tables) -> DataFrame:
    """(year, month, entity, region, gender, age, deaths) from line items."""
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
                 F.col("n_name").alias("entity"), F.col("r_name").alias("region"),
                 F.col("l_linestatus").alias("gender"), F.col("p_size").alias("age"))
        .agg(F.sum("l_quantity").alias("deaths")))


CUBE = """cube AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, n_name AS entity,
         r_name AS region, l_linestatus AS gender, p_size AS age, SUM(l_quantity) AS deaths
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""
