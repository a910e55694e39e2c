"""Sources, sinks and incremental loads over data written from the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epitide.model import inline_table
from epitide.operators import repair
from epitide.operators.merge import append_distinct
from epitide.plans import inputs, sqltext
from epitide.plans.registry import query
from epitide.sources import bucketed, io, panel
from epitide.sources.stage import settle
from epitide.streaming import incremental


@query("s1_csv_import", f"WITH {inputs.DAILY} SELECT entity, date, value, n FROM daily")
def s1(t):
    folder = io.work_folder(t.spark, "s1")
    io.export(inputs.daily(t).select("entity", "date", "value", "n"), "panel", folder, csv_only=True)
    schema = "entity string, date date, value double, n bigint"
    missing = io.read_csv(t.spark, f"{folder}/absent.csv", schema)
    return io.read_csv(t.spark, f"{folder}/panel.csv", schema).unionByName(missing)


@query("s2_export_json", f"WITH {inputs.CUMULATIVE} SELECT entity, strftime(date, '%Y-%m-%d') AS date, value FROM cum")
def s2(t):
    folder = io.work_folder(t.spark, "s2")
    io.export(inputs.cumulative(t), "panel", folder)
    return t.spark.read.schema("entity string, date string, value double").json(f"{folder}/panel")


@query("s2_partitioned_store", f"""WITH {inputs.DAILY} SELECT entity, date, CASE WHEN year(date) = 1999 THEN value * 2 ELSE value END AS value, CAST(year(date) AS INTEGER) AS year FROM daily""")
def s2_store(t):
    path = io.work_folder(t.spark, "s2p") + "/panel"
    panel = inputs.daily(t).select("entity", "date", "value", F.year("date").alias("year"))
    io.write_panel(panel, path, ["year"])
    io.write_panel(panel.filter("year = 1999").withColumn("value", F.col("value") * 2), path, ["year"])
    return t.spark.read.schema("entity string, date date, value double, year int").parquet(path)


BUCKETS = 8


@query("s2_bucketed_panel", f"""WITH {inputs.DAILY}, cum0 AS (SELECT entity, date, CAST(SUM(value) OVER (PARTITION BY entity ORDER BY date) AS DOUBLE) AS total, value AS own FROM daily),
cum AS (SELECT entity, date, CASE WHEN year(date) = 1999 THEN total + 5 ELSE total END AS value FROM cum0), {sqltext.undipped('cum', 'value')}, {sqltext.dense('undipped', 'value')}, {sqltext.interpolated('dense', 'value')}
SELECT entity, date, round(value - LAG(value) OVER (PARTITION BY entity ORDER BY date), 4) AS value FROM filled""")
def s2_buckets(t):
    """Cumulative figures in buckets; a batch of corrections merged in place; repaired from the buckets."""
    w = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    cum = inputs.daily(t).select("entity", "date", F.sum("value").over(w).alias("value"))
    first = t.spark.table(bucketed.write_buckets(cum, ["entity"], "date", BUCKETS))
    batch = first.filter("year(date) = 1999").withColumn("value", F.col("value") + 5)
    merged = bucketed.merge_batch(first, batch, ["entity"], "date", ["value"], BUCKETS)
    second = t.spark.table(bucketed.write_buckets(merged, ["entity"], "date", BUCKETS))
    return repair.cumulative_to_daily(second, ["entity"]).withColumn("value", F.round("value", 4))


@query("s3_json_records", """SELECT event_id AS "Id", CAST(ts AS DATE) AS "Date", CAST(json_extract(props, '$.k') AS BIGINT) AS "Cases" FROM events""")
def s3(t):
    folder = io.work_folder(t.spark, "s3")
    t.events.select("event_id", F.to_date("ts").alias("txn_date"), F.from_json("props", "k bigint")["k"].alias("new_case"), "event_type").write.mode(
        "overwrite").json(f"{folder}/records")
    return io.read_records(t.spark, f"{folder}/records", "event_id bigint, txn_date date, new_case bigint, event_type string",
                           {"event_id": "Id", "txn_date": "Date", "new_case": "Cases"}, ["Id", "Date", "Cases"])


def payloads(t):
    """Nested JSON per customer: two features, and counts by single year of age as numbered fields."""
    feature = [F.struct(F.struct(F.lit(x).alias("kind"), (F.floor("c_acctbal") + i).cast("bigint").alias("beds")).alias("attributes"))
               for i, x in enumerate(("ward", "field"))]
    ages = [(F.col("c_custkey") % (a + 2)).cast("double").alias(f"lsAge{a}") for a in range(5)]
    return t.customer.select("c_custkey", F.to_json(F.struct(F.array(*feature).alias("features"))).alias("features"),
                             F.to_json(F.struct(F.col("c_acctbal").alias("lsSumTotTot"), *ages)).alias("ages"))


@query("s4_nested_features", """SELECT c_custkey, 'ward' AS kind, CAST(floor(c_acctbal) AS BIGINT) AS beds FROM customer UNION ALL SELECT c_custkey, 'field', CAST(floor(c_acctbal) AS BIGINT) + 1 FROM customer""")
def s4(t):
    return io.flatten_features(payloads(t), "features", "kind: string, beds: bigint", ["c_custkey"])


@query("s4_age_fields", """SELECT c_custkey, CAST(a AS INTEGER) AS age, CAST(c_custkey % (a + 2) AS DOUBLE) AS value FROM customer, range(5) r(a)""")
def s4_ages(t):
    return io.flatten_ages(payloads(t), "ages", ["c_custkey"])


@query("s5_files_newest_first", f"""WITH {inputs.PUBLISHED}, w AS (SELECT entity, date, source, MAX(value) FILTER (metric = 'value') AS value, MAX(value) FILTER (metric = 'cases') AS cases FROM published GROUP BY 1, 2, 3)
SELECT entity, date, COALESCE(p.value, o.value, f.value) AS value, COALESCE(p.cases, o.cases, f.cases) + 0 AS cases FROM (SELECT * FROM w WHERE source = 'F') f
FULL JOIN (SELECT * FROM w WHERE source = 'O') o USING (entity, date) FULL JOIN (SELECT * FROM w WHERE source = 'P') p USING (entity, date)""")
def s5(t):
    folder = io.work_folder(t.spark, "s5")
    wide = inputs.published(t).groupBy("entity", "date", "source").pivot("metric", ["value", "cases"]).agg(F.max("value"))
    for source, day in (("F", "2021.01.09"), ("O", "2021.01.16"), ("P", "2021.01.23")):
        # The date in a file's name ranks it; Spark names the files, so the folder carries the date here.
        wide.filter(F.col("source") == source).drop("source").write.mode("overwrite").parquet(f"{folder}/{day}_tests")
    schema = "entity string, date date, value double, cases double"
    files = io.read_dated_files(t.spark, f"{folder}/*_tests", schema)
    return io.fold_newest_first(files, ["entity", "date"], ["value", "cases"])


@query("s6_shifted_snapshots", """SELECT o_orderkey, o_orderpriority, o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def s6(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "c_mktsegment")
    good = rows.filter("o_orderstatus <> 'P'")
    shifted = rows.filter("o_orderstatus = 'P'").select(
        "o_orderkey", F.col("c_mktsegment").alias("o_orderpriority"), F.col("o_orderpriority").alias("o_orderstatus"), F.col("o_orderstatus").alias("c_mktsegment"))
    return io.mend_shifted(io.union_snapshots(good, shifted), F.length("c_mktsegment") == 1,
                           ["o_orderkey", "c_mktsegment", "o_orderpriority", "o_orderstatus"])


@query("s7_tail_replacement", """WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders),
c AS (SELECT * FROM r WHERE date < DATE '2000-06-30' OR (date = DATE '2000-06-30' AND price > 200000)), b AS (SELECT MAX(date) AS d FROM c)
SELECT * FROM c WHERE date < (SELECT d FROM b) UNION ALL SELECT o_orderkey, date, price + 1 FROM r WHERE date >= (SELECT d FROM b)""")
def s7(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("price"))
    # The cache ends within 30 June: rows of that day are incomplete and their values have changed since.
    cached = rows.filter("date < DATE '2000-06-30' OR (date = DATE '2000-06-30' AND price > 200000)")
    fresh = rows.filter("date >= DATE '2000-01-01'").withColumn("price", F.col("price") + 1)
    return io.replace_tail(cached, fresh, "date")


@query("s7_first_load", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders""")
def s7_first(t):
    """Nothing is cached yet."""
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("price"))
    return io.replace_tail(rows.limit(0), rows, "date")


@query("s7_composite_key", """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice AS price FROM orders)
SELECT o_orderkey, year, month, CASE WHEN year IS NULL OR (year, month) >= (1999, 4) THEN price + 1 ELSE price END AS price FROM r""")
def s7_composite(t):
    """The key is (year, month); the cache ends with April 1999; some rows have no year."""
    when = F.to_date("o_orderdate")
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.year(when)).alias("year"), F.month(when).alias("month"), F.col("o_totalprice").alias("price"))
    cached = rows.filter("year IS NULL OR year < 1999 OR (year = 1999 AND month <= 4)")
    return io.replace_tail(cached, rows.withColumn("price", F.col("price") + 1), ["year", "month"])


@query("s7_incremental_stream", f"""WITH {inputs.PUBLISHED}, w AS (SELECT entity, date, source, MAX(value) FILTER (metric = 'value') AS value, MAX(value) FILTER (metric = 'cases') AS cases FROM published GROUP BY 1, 2, 3)
SELECT entity, date, COALESCE(p.value, o.value, f.value) AS value, COALESCE(p.cases, o.cases, f.cases) AS cases FROM (SELECT * FROM w WHERE source = 'F') f FULL JOIN (SELECT * FROM w WHERE source = 'O') o USING (entity, date)
FULL JOIN (SELECT * FROM w WHERE source = 'P') p USING (entity, date)""")
def s7_stream(t):
    folder = io.work_folder(t.spark, "s7")
    wide = inputs.published(t).groupBy("entity", "date", "source").pivot("metric", ["value", "cases"]).agg(F.max("value"))
    for source in inputs.SOURCES_IN_ORDER:
        arrived = wide.filter(F.col("source") == source).drop("source")
        arrived.write.mode("append").parquet(f"{folder}/in")
        incremental.load_new_files(t.spark, f"{folder}/in", arrived.schema, f"{folder}/store", f"{folder}/checkpoint")
    return incremental.current_panel(t.spark, f"{folder}/store", ["entity", "date"], ["value", "cases"])


_STREAMED = f"""WITH {inputs.PUBLISHED}, w AS (SELECT entity, date, source, MAX(value) FILTER (metric = 'value') AS value, MAX(value) FILTER (metric = 'cases') AS cases FROM published GROUP BY 1, 2, 3)"""


def arrivals(t):
    """One wide table of each source, in the order in which they arrive."""
    wide = inputs.published(t).groupBy("entity", "date", "source").pivot("metric", ["value", "cases"]).agg(F.max("value"))
    wide = settle(wide, "arrivals")
    return [(s, wide.filter(F.col("source") == s).drop("source")) for s in inputs.SOURCES_IN_ORDER]


def store(folder, schema):
    return panel.Panel(folder, schema, ("entity", "date"), ("value", "cases"), F.date_format("date", "yyyy-MM"))


@query("s7_merged_panel", f"""{_STREAMED}
SELECT entity, date, COALESCE(p.value, o.value, f.value) AS value, COALESCE(p.cases, o.cases, f.cases) AS cases FROM (SELECT * FROM w WHERE source = 'F') f FULL JOIN (SELECT * FROM w WHERE source = 'O') o USING (entity, date)
FULL JOIN (SELECT * FROM w WHERE source = 'P') p USING (entity, date)""")
def s7_merged(t):
    """Three batches of files merged into a stored panel by a stream; a start without new files changes nothing."""
    folder, kept = io.work_folder(t.spark, "s7m"), None
    for _, arrived in arrivals(t):
        arrived.write.mode("append").parquet(f"{folder}/in")
        kept = kept or store(f"{folder}/panel", arrived.schema)
        for _ in range(2):
            incremental.merge_new_files(t.spark, f"{folder}/in", kept, f"{folder}/checkpoint")
    return kept.read(t.spark)


@query("s7_late_batch", f"""{_STREAMED}, m AS (SELECT DISTINCT source, strftime(date, '%Y-%m') AS part FROM w WHERE source = 'F' OR (source = 'O' AND month(date) = 3))
SELECT CAST(v AS BIGINT) AS version, part, CAST(MAX(CASE WHEN source = 'O' AND v = 2 THEN 2 WHEN source = 'F' THEN 1 END) AS BIGINT) AS written
FROM m, (VALUES (1), (2)) x(v) GROUP BY 1, 2 HAVING written IS NOT NULL""")
def s7_late(t):
    """What each version reads where: a batch of corrections to every March rewrites those months only; run again, nothing."""
    folder = io.work_folder(t.spark, "s7l")
    (_, first), (_, second), _ = arrivals(t)
    kept = store(folder, first.schema)
    kept.merge(first, "first")
    for _ in range(2):
        kept.merge(second.filter("month(date) = 3"), "corrections")
    return kept.history(t.spark)


@query("s7_repeated_arrivals", """SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2""")
def s7_repeated(t):
    """Events arrive in three batches out of order, many of them twice or three times; each counts once."""
    folder = io.work_folder(t.spark, "s7d")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    for k in range(3):
        events.filter((F.col("event_id") % 3 == k) | (F.col("event_id") % 7 <= k)).orderBy(F.xxhash64("event_id")).write.mode("append").parquet(f"{folder}/in")
        incremental.load_new_files(t.spark, f"{folder}/in", events.schema, f"{folder}/store", f"{folder}/checkpoint",
                                   identity=["event_id"], event_time="ts", delay="60 days")
    return t.spark.read.schema(events.schema).parquet(f"{folder}/store").groupBy(F.to_date("ts").alias("date"), "event_type").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("s7_audited_panel", f"""WITH {inputs.DAILY}
SELECT entity, date, CASE WHEN year(date) = 1997 THEN value + 1 ELSE value END AS value, CAST(n AS DOUBLE) AS cases FROM daily""")
def s7_audited(t):
    """Write, audit, publish: the second batch lowers published figures, is refused, and leaves the panel as it was."""
    folder = io.work_folder(t.spark, "s7a")
    days = settle(inputs.daily(t).select("entity", "date", "value", F.col("n").cast("double").alias("cases")), "days")
    kept = store(folder, days.schema)
    checks = {"not falling": panel.continuous("value"), "keys once": panel.single_rows(), "bounds": panel.none_of(F.col("cases") < 0),
              "shares": panel.reconciled(F.col("cases"), F.col("value"), 0, 1)}
    early, year = days.filter("date < DATE '1998-01-01'"), days.filter("year(date) = 1997")
    kept.merge(early, "early", checks)
    try:
        kept.merge(year.withColumn("value", F.col("value") - 1), "lower", checks)
    except panel.Refused as refused:
        assert refused.broken == ["not falling"], refused
    else:
        raise AssertionError("a batch that lowers published figures was published")
    kept.merge(year.withColumn("value", F.col("value") + 1), "higher", checks)
    kept.merge(days.filter("date >= DATE '1998-01-01'"), "late", checks)
    return kept.read(t.spark)


def open_payloads(t):
    """JSON per customer with a field that only some have, one of another type, and texts that are no JSON."""
    k = F.col("c_custkey")
    body = F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), k.alias("beds"), F.when(k % 3 == 0, k * 2).alias("tents"),
                              F.when(k % 4 == 0, F.lit(1.5)).alias("rate"), F.when(k % 5 == 0, F.lit("n/a")).alias("note")))
    return t.customer.select("c_custkey", F.when(k % 11 == 0, "{broken").otherwise(body).alias("payload"))


@query("s4_open_payload", """SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS beds FROM customer""")
def s4_open(t):
    """Known fields typed, out of a stored table that holds the whole payloads as VARIANT."""
    folder = io.work_folder(t.spark, "s4o")
    io.open_payload(open_payloads(t), "payload", ["c_custkey"], {"segment": "string", "beds": "bigint"}).write.parquet(folder)
    return t.spark.read.parquet(folder).select("c_custkey", "segment", "beds")


@query("s4_unknown_metrics", """SELECT c_custkey, metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT c_custkey, 'tents' AS metric, c_custkey * 2 AS value FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey, 'rate', 1.5 FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 11 <> 0)""")
def s4_unknown(t):
    """Numbers that the schema does not know come out as metrics."""
    rows = io.open_payload(open_payloads(t), "payload", ["c_custkey"], {"segment": "string", "beds": "bigint"})
    return io.other_metrics(rows, ["c_custkey"], ["segment", "beds"])


@query("s8_yearly_location", f"""WITH {inputs.DAILY} SELECT DISTINCT date, value, n FROM daily WHERE entity = 'NATION_7'""")
def s8(t):
    folder = io.work_folder(t.spark, "s8") + "/years"
    panel = inputs.daily(t).select("entity", "date", "value", "n")
    panel.filter("date <= DATE '1998-12-31'").write.mode("overwrite").parquet(f"{folder}/a")
    panel.filter("date >= DATE '1998-06-01'").write.mode("overwrite").parquet(f"{folder}/b")
    files = t.spark.read.schema(panel.schema).parquet(f"{folder}/*")
    return io.yearly_for_location(files, "entity", "NATION_7")


@query("s9_append_distinct", f"""WITH {inputs.DAILY} SELECT entity, date, n FROM daily WHERE date < DATE '1999-01-01' UNION SELECT entity, date, CASE WHEN day(date) = 1 THEN n + 1 ELSE n END FROM daily WHERE date > DATE '1998-01-01'""")
def s9(t):
    d = inputs.daily(t).select("entity", "date", "n")
    later = d.filter("date > DATE '1998-01-01'").withColumn("n", F.when(F.dayofmonth("date") == 1, F.col("n") + 1).otherwise(F.col("n")))
    return append_distinct(d.filter("date < DATE '1999-01-01'"), later)


def sheet(t):
    """A spreadsheet with three header rows and a totals row: quantity by place, year, status and return flag."""
    facts = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    years = sorted(r[0] for r in facts.select(F.year("l_shipdate")).distinct().collect())  # one row per calendar year
    wanted = [(y, s, r) for y in years for s in ("F", "O") for r in ("R", "N")]

    def cell(y, s, r):
        flag = F.col("l_returnflag") == "R" if r == "R" else F.col("l_returnflag") != "R"
        return F.sum(F.when((F.year("l_shipdate") == y) & (F.col("l_linestatus") == s) & flag, F.col("l_quantity")))

    names = [f"c{i}" for i in range(len(wanted))]
    body = facts.groupBy(F.col("n_name").alias("place")).agg(*[F.format_number(cell(*w), 0).alias(n) for n, w in zip(names, wanted)])
    total = facts.agg(*[F.format_number(cell(*w), 0).alias(n) for n, w in zip(names, wanted)]).withColumn("place", F.lit("Total"))
    head = [
        [str(y) if i % 4 == 0 else None for i, (y, _, _) in enumerate(wanted)],
        [f"Type {s}" if i % 2 == 0 else None for i, (_, s, _) in enumerate(wanted)],
        ["detected" if r == "R" else "tested" for _, _, r in wanted],
    ]

    top = inline_table(t.spark, "row int, place string, " + ", ".join(f"{n} string" for n in names),
                       [[i, None, *h] for i, h in enumerate(head)])
    rows = body.unionByName(total).withColumn("row", F.lit(3))
    return top.unionByName(rows)


@query("s10_sheet_to_rows", """WITH f AS (SELECT n_name AS place, CAST(year(l_shipdate) AS VARCHAR) AS year, l_linestatus AS s, l_returnflag = 'R' AS pos, l_quantity AS q
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT place, year, SUM(q) FILTER (s = 'F' AND NOT pos) AS "Type F Tests", SUM(q) FILTER (s = 'F' AND pos) AS "Type F Pos", SUM(q) FILTER (s = 'O' AND NOT pos) AS "Type O Tests", SUM(q) FILTER (s = 'O' AND pos) AS "Type O Pos" FROM f GROUP BY 1, 2""")
def s10(t):
    tidy = io.tidy_sheet(sheet(t), "row", "place", {0: "year", 1: "test", 2: "outcome"}, ["Total"])
    return io.tested_metrics(tidy, "place", "year", "test", "outcome", ["Type F", "Type O"])


@query("s11_snapshot_stamp", """WITH n AS (SELECT DATE '2024-02-01' AS date, n_name AS entity, SUM(CAST(round(c_acctbal) AS BIGINT)) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2),
h AS (SELECT DATE '2024-01-31' AS date, entity, balance FROM n UNION ALL SELECT * FROM n WHERE entity < 'NATION_2')
SELECT DISTINCT date, entity, CAST(balance AS BIGINT) AS balance FROM (SELECT * FROM h UNION ALL SELECT * FROM n)""")
def s11(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("entity"), inputs.units("c_acctbal").alias("balance"))
    before = io.stamp_snapshot(people, "entity", ["balance"], "2024-01-31")
    some = io.stamp_snapshot(people, "entity", ["balance"], "2024-02-01").filter("entity < 'NATION_2'")
    return io.stamp_snapshot(people, "entity", ["balance"], "2024-02-01", before.unionByName(some))
