"""Segmented scans, joins to validity, dictionaries, gram index, dates, sketches: against plain Python, at any width."""

import bisect
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from epitide.operators import corpus, epi, places, quality, repair, scan, sketches, temporal
from epitide.sources import io


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ---- scans ------------------------------------------------------------------------------------------

def series(seed, n=300, keys=3):
    r = random.Random(seed)
    return [(r.choice([None, *range(keys)]), i, r.choice([None, r.randrange(50)]), r.random() < 0.4) for i in r.sample(range(-400, 900), n)]


@pytest.mark.parametrize("width", [None, 1, 7, 100, 5000])
def test_running_values(spark, width):
    rows = series(1)
    df = spark.createDataFrame(rows, "k int, t int, v int, hit boolean").repartition(5)
    got = scan.running(df, ["k"], "t", {"last": ("last", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))}, width)
    want, state = {}, {}
    for k, t, v, _ in sorted(rows, key=lambda x: x[1]):
        last, low, high = state.get(k, (None, None, None))
        if v is not None:
            last, low, high = v, v if low is None else min(low, v), v if high is None else max(high, v)
        state[k] = want[k, t] = (last, low, high)
    assert {(r.k, r.t): (r["last"], r.low, r.high) for r in got.collect()} == want
    assert got.columns == ["k", "t", "v", "hit", "last", "low", "high"]


@pytest.mark.parametrize("width", [None, 1, 9, 2000])
def test_run_numbers(spark, width):
    rows = series(2)
    df = spark.createDataFrame(rows, "k int, t int, v int, hit boolean")
    want, state = {}, {}
    for k, t, _, hit in sorted(rows, key=lambda x: x[1]):
        was, run = state.get(k, (False, 0))
        run += hit != was
        state[k], want[k, t] = (hit, run), run
    got = scan.run_numbers(df, ["k"], "t", F.col("hit"), width=width)
    assert {(r.k, r.t): r.run for r in got.collect()} == want


def test_long_keys_are_split(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    for split in (scan.running(df, ["k"], "t", {"x": ("last", F.col("v"))}, 3), scan.run_numbers(df, ["k"], "t", F.col("v") > 4, width=3)):
        plan = plan_of(split).split("== Physical Plan ==")[1]
        assert re.search(r"hashpartitioning\(k#\d+L?, _piece#", plan)


# ---- validity -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("width", [None, 30])
def test_as_of(spark, width):
    r = random.Random(4)
    day = dt.date(2020, 1, 1)
    dim = [(r.choice([None, "a", "b"]), day + dt.timedelta(r.randrange(300)), r.choice([None, r.randrange(9)]), k) for k in range(60)]
    facts = [(k, r.choice([None, "a", "b", "c"]), None if k % 17 == 0 else day + dt.timedelta(r.randrange(-20, 320))) for k in range(200)]
    d = spark.createDataFrame(dim, "place string, since date, rate int, n int")
    f = spark.createDataFrame(facts, "id int, place string, at date")
    out = temporal.as_of(f, d, ["place"], "at", "since", ["rate", "n"], width)
    assert out.columns == ["id", "place", "at", "rate", "n"] and "BroadcastNestedLoop" not in plan_of(out)
    latest = {}
    for p, s, v, n in dim:
        if p is not None:
            latest[p, s] = max(latest.get((p, s), (None, -1)), (v, n), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = {}
    for i, p, at in facts:
        before = [s for q, s in latest if q == p and at is not None and s <= at]
        want[i] = latest[p, max(before)] if before else (None, None)
    assert {x.id: (x.rate, x.n) for x in out.collect()} == want


def test_interval_join(spark):
    r = random.Random(6)
    spans = [(k, r.choice("xy"), a, r.choice([None, a + r.choice([0, 1, 3, 50, 700, -1])])) for k, a in enumerate(r.choices(range(-300, 600), k=150))] + [(999, "x", None, 5)]
    points = [(k, r.choice(["x", "y", None]), r.choice([None, r.randrange(-320, 1400)])) for k in range(200)]
    i = spark.createDataFrame(spans, "span int, g string, a int, b int")
    p = spark.createDataFrame(points, "id int, g string, at int")
    fits = [(q, s) for q, h, t in points for s, g, a, b in spans if t is not None and a is not None and a <= t and (b is None or t <= b)]
    assert sorted((x.id, x.span) for x in temporal.interval_join(p, i.drop("g"), "at", "a", "b").collect()) == sorted(fits)
    keyed = [(q, s) for q, s in fits if dict((k, h) for k, h, _ in points)[q] == dict((k, g) for k, g, _, _ in spans)[s]]
    out = temporal.interval_join(p, i, "at", "a", "b", ["g"])
    assert sorted((x.id, x.span) for x in out.collect()) == sorted(keyed) and out.columns == ["id", "g", "at", "span", "a", "b"]


def test_interval_join_of_repeated_points(spark):
    """The same pairs, and no row of a point for every level: only distinct points are dealt to cells."""
    nan = float("nan")
    i = spark.createDataFrame([(1, "x", 0.0, 9.0), (2, "x", 2.5, 2.5), (3, "y", -3.0, None), (4, None, 0.0, 9.0), (2, "x", 2.5, 2.5)], "span int, g string, a double, b double")
    values = [("x", 2.5), ("x", 0.0), ("x", -0.0), ("y", nan), ("y", 2.5), ("x", None), (None, 2.5), ("x", nan)]
    p = spark.createDataFrame([(k, *values[k % len(values)]) for k in range(800)], "id int, g string, at double")
    plain, out = temporal.interval_join(p, i, "at", "a", "b", ["g"]), temporal.interval_join(p, i, "at", "a", "b", ["g"], repeated=True)
    assert out.columns == plain.columns
    assert sorted((x.id, x.span) for x in out.collect()) == sorted((x.id, x.span) for x in plain.collect()) != []
    distinct = r"Aggregate \[g#\d+, at#\d+\]"
    assert re.search(distinct, plan_of(out)) and not re.search(distinct, plan_of(plain))


def test_intervals_of_repeated_points_are_met_in_lists(spark, monkeypatch):
    """A fact meets lists of bounded length, not a joined row for each interval; equal intervals, and all of a full list, are kept."""
    monkeypatch.setattr(temporal, "PACK", 4)
    i = spark.createDataFrame([(k // 2, "xy"[k % 2], -(k % 3), None if k % 5 == 0 else 3 + k % 4) for k in range(50)] * 2, "span int, g string, a int, b int")
    p = spark.createDataFrame([(k, "xyz"[k % 3], k % 7) for k in range(90)], "id int, g string, at int")
    for keys in (["g"], []):
        spans = i if keys else i.drop("g")
        plain, out = temporal.interval_join(p, spans, "at", "a", "b", keys), temporal.interval_join(p, spans, "at", "a", "b", keys, repeated=True)
        assert out.columns == plain.columns and sorted(map(str, out.collect())) == sorted(map(str, plain.collect())) != []
        assert "Generate explode(_found" in plan_of(out)


def test_fractions_and_times(spark):
    p = spark.createDataFrame([(1, 2.7), (2, 2.5), (3, -0.2)], "id int, at double")
    i = spark.createDataFrame([("x", 2.5, 2.6), ("y", -0.5, 2.55)], "name string, a double, b double")
    assert sorted((r.id, r.name) for r in temporal.interval_join(p, i, "at", "a", "b").collect()) == [(2, "x"), (2, "y"), (3, "y")]


def test_a_hundred_thousand_intervals(spark):
    """Joined rows stay near the result, and no nested loop is planned."""
    i = spark.range(100_000).select(F.col("id").alias("span"), (F.col("id") * 7).alias("a"), (F.col("id") * 7 + F.col("id") % 60).alias("b"))
    p = spark.range(20_000).select((F.col("id") * 31).alias("at"))
    out = temporal.interval_join(p, i, "at", "a", "b")
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    starts = [k * 7 for k in range(100_000)]
    want = 0
    for at in range(0, 20_000 * 31, 31):
        j = bisect.bisect_right(starts, at) - 1
        want += sum(1 for k in range(max(0, j - 9), j + 1) if k * 7 <= at <= k * 7 + k % 60)
    assert out.count() == want


# ---- dictionaries -------------------------------------------------------------------------------------

def test_dictionary_hits(spark):
    words = [("heart", "a"), ("heart attack", "b"), ("Heart Attack", "c"), ("kidney", "d"), ("โรคไต", "e"), ("x-ray", "f")]
    d = spark.createDataFrame(words, "spelling string, category string")
    texts = [(1, "A HEART  attack, heart; kidneys kidney"), (2, "โรคไต x-ray x ray"), (3, None), (4, "")]
    got = corpus.dictionary_hits(spark.createDataFrame(texts, "id int, text string"), ["id"], "text", d, "spelling", "category")
    assert sorted((r.id, r.pos, r.category) for r in got.collect()) == [(1, 1, "b"), (1, 1, "c"), (1, 4, "a"), (1, 7, "d"), (2, 0, "e"), (2, 1, "f")]
    none = corpus.dictionary_hits(spark.createDataFrame(texts, "id int, text string"), ["id"], "text", d.limit(0), "spelling", "category")
    assert none.count() == 0


def test_dictionary_numbers(spark):
    d = spark.createDataFrame([("engine", "e"), ("motor", "e"), ("paint job", "p")], "spelling string, category string")
    texts = [(1, "Engine fault (1,200) motor (3) paint job (7", 1500), (2, "paint job: none (9) engine (10)", 9), (3, "engine) 5", 9)]
    got = corpus.dictionary_numbers(spark.createDataFrame(texts, "id int, text string, total int"), ["id"], "text", d, "spelling", "category", total="total")
    found = sorted((r.id, r.category, r.value) for r in got.collect())
    assert found == [(1, "e", 3), (1, "e", 1200), (2, "p", 9)]
    assert sorted((r.id, r.category, r.value) for r in corpus.first_numbers(got, ["id"]).collect()) == [(1, "e", 1200), (2, "p", 9)]


def test_five_thousand_spellings_read_the_text_once(spark):
    d = spark.range(5000).select(F.concat(F.lit("term "), F.col("id").cast("string")).alias("spelling"), (F.col("id") % 9).cast("string").alias("category"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    texts = spark.range(50).select("id", F.concat_ws(" ", F.lit("a term"), (F.col("id") * 97).cast("string"), F.lit("and term"), F.col("id").cast("string")).alias("text")).mapInArrow(count, "id long, text string")
    assert corpus.dictionary_hits(texts, ["id"], "text", d, "spelling", "category").count() == 100
    assert seen.value == 50


# ---- names --------------------------------------------------------------------------------------------

def names_of(seed, n, low, high):
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    keys = sorted({"".join(r.choices(letters, k=r.randint(low, high))) for _ in range(n)})
    out = set()
    for k in keys:
        x = list(k)
        for _ in range(r.randint(0, 2)):
            i = r.randrange(len(x) + 1)
            what = r.randrange(3)
            x[i:i + (what > 0)] = [] if what == 1 else [r.choice(letters)]
        out.add("".join(x) or "a")
    return sorted(out), keys


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("cutoff,low,high", [(0.5, 1, 9), (0.6, 4, 6), (0.7, 1, 12), (0.74, 3, 14), (0.9, 8, 25), (0.4, 3, 6)])
def test_no_near_pair_is_lost(spark, cutoff, low, high):
    names, keys = names_of(low + high, 150, low, high)
    names += ["aaaa", "aaaaaaa", "abababab"]
    keys += ["aaaaa", "aaaaaa", "babababa"]
    a, b = spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame([(k,) for k in keys], "k string")
    got = {(r._name, r._key) for r in places.candidate_pairs(a, "n", b, "k", cutoff).collect()}
    want = {(n, k) for n in names for k in keys if 1 - distance(n, k) / max(len(n), len(k)) >= cutoff - 1e-9}
    assert want <= got


@pytest.mark.parametrize("cutoff,low,high", [(0.6, 4, 6), (0.74, 5, 14)])
def test_gram_candidates_are_few(spark, cutoff, low, high):
    names, keys = names_of(11, 700, low, high)
    a, b = spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame([(k,) for k in keys], "k string")
    assert places.gram_pairs(a, "n", b, "k", cutoff).count() < 0.05 * len(names) * len(keys)


# ---- dates --------------------------------------------------------------------------------------------

D = dt.date


@pytest.mark.parametrize("text,start,end", [
    ("11-17/04/2563", D(2020, 4, 11), D(2020, 4, 17)), ("28 ธันวาคม - 3 มกราคม 2565", D(2021, 12, 28), D(2022, 1, 3)),
    ("28 ธันวาคม 2564 ถึง 3 มกราคม", D(2021, 12, 28), D(2022, 1, 3)), ("5 กรกฎาคม 2564 – 9 สิงหาคม 2564", D(2021, 7, 5), D(2021, 8, 9)),
    ("from 4 to 9 เม.ย. 2563 at 10-12", D(2020, 4, 4), D(2020, 4, 9)), ("99-100 of 5/6 and 3 - 7 nothing 2563", None, None), ("", None, None), (None, None, None),
    ("1/2 - 3 . 30-31 ม.ค. 2563", D(2020, 1, 30), D(2020, 1, 31))])
def test_ranges_take_from_either_side(spark, text, start, end):
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    assert [tuple(r) for r in corpus.date_ranges(docs, "id", "text", corpus.month_names(spark)).collect()] == [(1, start, end)]


# ---- sketches, payloads, groupings, grids ---------------------------------------------------------------

def test_merged_sketches_are_near_the_exact_ranks(spark):
    r = random.Random(8)
    rows = [(k % 3, dt.date(2020, 1, 1) + dt.timedelta(k % 50), r.lognormvariate(0, 2)) for k in range(60_000)] + [(0, dt.date(2020, 1, 1), None), (0, dt.date(2020, 1, 1), float("nan"))]
    days = sketches.day_sketches(spark.createDataFrame(rows, "k int, date date, v double"), ["k"], "date", "v")
    wanted = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    for x in sketches.merged(days, ["k"], wanted).collect():
        own = sorted(v for k, _, v in rows if k == x.k and v is not None and v == v)
        assert x.n == len(own)
        for name, q in wanted.items():
            assert abs(bisect.bisect_left(own, x[name]) / len(own) - q) < 0.02
    last = sketches.moving(days, ["k"], "date", 7, {"q50": 0.5}).filter("k = 1 AND date = DATE '2020-02-10'").first()
    own = sorted(v for k, d, v in rows if k == 1 and dt.date(2020, 2, 4) <= d <= dt.date(2020, 2, 10))
    assert last.n == len(own) and abs(bisect.bisect_left(own, last.q50) / len(own) - 0.5) < 0.02


def test_open_payloads(spark):
    df = spark.createDataFrame([(1, '{"a": 5, "b": "x", "c": 1.5, "d": {"e": 1}}'), (2, '{"a": "no"}'), (3, "{"), (4, None), (5, "[1]")], "id int, body string")
    rows = io.open_payload(df, "body", ["id"], {"a": "bigint", "b": "string"})
    assert {r.id: (r.a, r.b) for r in rows.select("id", "a", "b").collect()} == {1: (5, "x"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert [tuple(r) for r in io.other_metrics(rows, ["id"], ["a", "b"]).collect()] == [(1, "c", 1.5)]


def test_excess_over_keeps_null_groups_apart(spark):
    rows = [(g, b, y, 1, float(y - 1990 + (g is None))) for g in (None, "x") for b in ("p", None) for y in range(1995, 2002)]
    df = spark.createDataFrame(rows, "region string, band string, year int, month int, deaths double")
    years = range(1995, 2002)
    out = epi.excess_over(df, {"region": ["region"], "band": ["band"], "both": ["band", "region"]}, "deaths", years, 1999, [1995, 1996], [1995, 1996, 1997])
    for name, keys in (("region", ["region"]), ("band", ["band"]), ("both", ["region", "band"])):
        alone = epi.excess(df, keys, "deaths", years, 1999, [1995, 1996], [1995, 1996, 1997]).select(*keys, "year", "excess").collect()
        both = out.filter(F.col("grouping") == name).select(*keys, "year", "excess").collect()
        assert sorted(map(str, alone)) == sorted(map(str, both)) and len(both) == 3 * 2 ** len(keys)
    with pytest.raises(ValueError):
        epi.excess_over(df, {"a": ["region"], "b": ["region"]}, "deaths", years, 1999, [1995], [1995])


def test_grids(spark):
    have = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 2, "x")], "e string, d int, s string")
    got = quality.missing_cells(have, {"e": have, "d": have, "s": have})
    assert {tuple(r) for r in got.select("e", "d", "s").collect()} == {(e, d, s) for e in "ab" for d in (1, 2) for s in "xy"} - {("a", 1, "x"), ("b", 2, "y"), ("a", 2, "x")}
    many = spark.range(30).select(F.lit("a").alias("entity"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit(1).alias("n"))
    assert repair.densify_grid(many, ["entity"]).count() == 30
