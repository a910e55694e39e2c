"""Names, dates and text: documented vectors and brute-force comparisons."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from epitide.functions import calendar as cal
from epitide.functions import scalar as sc
from epitide.functions import text as tx
from epitide.operators import corpus, places

D = dt.date


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def noisy_names(seed, n, letters="abcde"):
    rnd = random.Random(seed)
    keys = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 11))) for _ in range(n)})
    names = set()
    for k in keys * 2:
        w = list(k)
        for _ in range(rnd.randrange(0, 4)):
            at = rnd.randrange(len(w) + 1)
            act = rnd.randrange(3)
            if act == 0:
                w.insert(at, rnd.choice(letters))
            elif act == 1 and len(w) > 1:
                w.pop(min(at, len(w) - 1))
            elif w:
                w[min(at, len(w) - 1)] = rnd.choice(letters)
        names.add("".join(w))
    return sorted(names), keys


@pytest.mark.parametrize("cutoff", [0.55, 0.74, 0.9])
def test_closest_edit_equals_brute_force(spark, cutoff):
    names, keys = noisy_names(11, 60)
    a = spark.createDataFrame([(n,) for n in names], "n string")
    b = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["n"]: r["match"] for r in places.closest(a, "n", b, "k", cutoff).collect()}
    want = {}
    for n in names:
        best = max((1 - levenshtein(n, k) / max(len(n), len(k)), k) for k in keys)
        if best[0] >= cutoff - 1e-9:
            want[n] = best[1]
    assert got == want


def test_fuzzy_join_exact_wins_and_unmatched_stay(spark):
    a = spark.createDataFrame([("Bangkok", 1), ("Bangkoc", 2), ("zzz", 3), (None, 4)], "place string, n int")
    dim = spark.createDataFrame([("Bangkok", "C", "Bangkok"), ("Bangkokk", "X", "Other")], "key string, region string, name string")
    got = {r["n"]: (r["place"], r["region"]) for r in places.fuzzy_join(a, dim, "place", "key", replace_with="name").collect()}
    assert got[1] == ("Bangkok", "C") and got[2] == ("Bangkok", "C") and got[3] == (None, None) and got[4] == (None, None)
    with pytest.raises(Exception, match="unmatched name"):
        places.fuzzy_join(a, dim, "place", "key", require_match=True).collect()
    audit = {r["place"]: (r["guess"], r["count"]) for r in places.match_audit(a, dim, "place", "key").collect()}
    assert audit == {"Bangkoc": ("Bangkok", 1), "zzz": (None, 1)}


def test_candidates_are_few(spark):
    """Pairs that reach the comparison, against the product of the two lists, at the default cutoff."""
    names, keys = noisy_names(5, 300)
    a = spark.createDataFrame([(n,) for n in names], "n string")
    b = spark.createDataFrame([(k,) for k in keys], "k string")
    assert places.candidate_pairs(a, "n", b, "k", places.CUTOFF).count() < 0.05 * len(names) * len(keys)


def test_week_end_vectors(spark):
    rows = [(2022, 52), (2023, 1)]
    df = spark.createDataFrame(rows, "y int, w int").select("w", cal.week_end("y", "w").alias("d"), cal.week_end("y", "w", 4).alias("t"),
                                                           cal.infer_year("w", D(2023, 1, 10)).alias("g"))
    got = {r["w"]: (r["d"], r["t"], r["g"]) for r in df.collect()}
    assert got == {52: (D(2022, 12, 31), D(2022, 12, 27), 2022), 1: (D(2023, 1, 7), D(2023, 1, 3), 2023)}


def test_year_vectors(spark):
    assert one(spark, "2565", lambda c: cal.to_gregorian_year(c)) == 2022
    assert one(spark, "2565", lambda c: cal.to_gregorian_year(c, guess=True)) == 2022
    assert one(spark, "2022", lambda c: cal.to_gregorian_year(c, guess=True)) == 2022
    assert one(spark, "64", lambda c: cal.to_gregorian_year(c)) == 2021


@pytest.mark.parametrize("name,want", [
    ("files/report-100264.pdf", D(2021, 2, 10)), ("Daily Report 20220118", D(2022, 1, 18)),
    ("inputs/x/2023.01.28_แยกประเภทของผล-รายจังหวัด.xlsx", D(2023, 1, 28)), ("a/2021-3-4.csv", D(2021, 3, 4)), ("none.txt", None)])
def test_file_dates(spark, name, want):
    assert one(spark, name, tx.file_date) == want


TEXT_DATES = [
    ("17 เม.ย. 2563", [D(2020, 4, 17)]), ("28 กุมภำพันธ์  – 18 กรกฎำคม 2564", [D(2021, 7, 18)]), ("20 ต.ค. 64", [D(2021, 10, 20)]),
    ("สำหรับจำนวนผู้ได้รับวัคซีนโควิด 19 ในวันที่ 10 พฤษภาคม 2564 ผู้ได้รับวัคซีนทั้งหมด 88,560 โดส ", [D(2021, 5, 10)]),
    ("10 พฤษภาม 2564", [D(2021, 5, 10)]), ("10 พฤษ 2564", [D(2021, 5, 10)]),
    ("สะสมตั้งแต่วันที่ 28 กุมภำพันธ์ 2564 – 10 มกรำคม 2565", [D(2021, 2, 28), D(2022, 1, 10)]),
    ("nวนัที่ 23 - 27 มกราคม 2566", [D(2023, 1, 27)]),
    ("28 กุมภำพันธ์ 2564 ผลกำรให้บริกำรวัคซีน ณ วันที่ 27 มกรำคม 2566 เวลำ 16.00", [D(2021, 2, 28), D(2023, 1, 27)]),
]


def test_text_dates(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXT_DATES)], "id int, text string")
    got = {}
    for r in sorted(corpus.text_dates(docs, "id", "text", corpus.month_names(spark)).collect(), key=lambda r: (r["id"], r["pos"])):
        got.setdefault(r["id"], []).append(r["date"])
    assert got == {i: want for i, (_, want) in enumerate(TEXT_DATES)}


RANGES = [
    ("11-17 เม.ย. 2563", D(2020, 4, 11), D(2020, 4, 17)), ("10 กรกฎาคม ถึง 16 กรกฎาคม 2565", D(2022, 7, 10), D(2022, 7, 16)),
    ("04/04/2563 - 12/06/2563", D(2020, 4, 4), D(2020, 6, 12)), ("27/02/2565 - 05-03/2565", D(2022, 2, 27), D(2022, 3, 5)),
    ("01/04/2021 – 04/03/2022", D(2021, 4, 1), D(2022, 3, 4)), ("29 - 3/03/2565", D(2022, 1, 29), D(2022, 3, 3)), ("nothing", None, None),
]


def test_date_ranges(spark):
    docs = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RANGES)], "id int, text string")
    got = {r["id"]: (r["start"], r["end"]) for r in corpus.date_ranges(docs, "id", "text", corpus.month_names(spark)).collect()}
    assert got == {i: r[1:] for i, r in enumerate(RANGES)}


def test_numbers_near(spark):
    t = "Cases 1,234 and 56 then deaths 7.5 - end 9"
    assert one(spark, t, lambda c: tx.numbers_near(c, ["none", "Cases"], until="then")) == [1234, 56]
    assert one(spark, t, lambda c: tx.numbers_near(c, ["deaths"], ints=False, dash_as_zero=True)) == [7.5, 0.0, 9.0]
    assert one(spark, t, lambda c: tx.numbers_near(c, ["deaths"], before=True)) == [56, 1234]
    assert one(spark, t, lambda c: tx.numbers_near(c, ["Cases"], until="absent", require_until=True)) == []
    assert one(spark, t, lambda c: tx.number_near(c, ["zzz"], default=-1)) == -1


def test_links(spark):
    page = '<a class="x" href="b.pdf">Report <b>one</b></a><a href="/c.pdf">two</a><a href="b.pdf">again</a><a href="//o.org/d.html">d</a>'
    df = spark.createDataFrame([(1, "http://h.org/dir/index.html?q=1", page)], "id int, url string, html string")
    got = {r["link"]: r["position"] for r in corpus.links(df, "id", "url", "html").collect()}
    assert got == {"http://h.org/dir/b.pdf": 0, "http://h.org/c.pdf": 1, "http://o.org/d.html": 3}
    assert [r["link"] for r in corpus.links(df, "id", "url", "html", ".pdf", "Report one").collect()] == ["http://h.org/dir/b.pdf"]


def test_runs_and_pairs(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1, 2, 3, 4])], "k int, i int, v int")
    got = {r["i"]: r["run"] for r in corpus.runs(df, ["k"], "i", F.col("v") == 2).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 2}
    assert {(r["pair"], r["first"], r["second"]) for r in corpus.pairs(df, ["k"], "i", "v").collect()} == {(0, 1, 2), (1, 3, 4)}


def test_number_formats(spark):
    rows = [(0.0, "0"), (1.5, "1.5"), (12.34, "12.3"), (999.0, "999"), (1234.0, "1.23k"), (1e6, "1M"), (-25000.0, "-25k"), (2.5e9, "2.5G")]
    df = spark.createDataFrame([(r[0],) for r in rows], "x double").select(sc.human_format("x").alias("y"))
    assert [r["y"] for r in df.collect()] == [r[1] for r in rows]
    assert one(spark, None, sc.percent_format, "double") == "%"
    assert one(spark, 8_500_000.0, lambda c: sc.population_format(c, F.lit(69_630_000.0)), "double") == "12.2%\n8.5M"


def test_sub_counts_come_off_their_place(spark):
    df = spark.createDataFrame([(1, "Chiang Mai (12) (prison 5), Phuket (3), Curaçao (4) ภูเก็ต (1,002)")], "id int, text string")
    assert {(r["place"], r["n"]) for r in corpus.place_counts(df, "id", "text").collect()} == {
        ("Chiang Mai", 7), ("Phuket", 3), ("Curaçao", 4), ("ภูเก็ต", 1002)}
