"""Corpus jobs: the same extraction over every document of a table.

Texts are read whole. Dictionaries and layouts are literal tables or expressions; names are resolved
on their distinct values only; sequences are numbered by exact range-split running counts, so a very
long conversation is spread over many tasks and never collected into one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.functions.calendar import previous_day_of_month, to_gregorian_year
from epitide.functions.text import absolute_url, has_extension, number_near, numbers_in
from epitide.model import inline_table
from epitide.operators import places
from epitide.operators.merge import priority_merge
from epitide.operators.ordered import exact_quantile, join_same, running_total
from epitide.operators.scan import run_numbers
from epitide.sources.stage import settle

# Thai month names, full and abbreviated, January first.
FULL_MONTHS = ["มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน", "กรกฎาคม", "สิงหาคม", "กันยายน",
               "ตุลาคม", "พฤศจิกายน", "ธันวาคม"]
SHORT_MONTHS = ["ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.", "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค."]

# ---- dates in text ------------------------------------------------------------------------------

MAX_MONTH_NAMES = 500


def month_names(spark, full: Sequence[str] = FULL_MONTHS, short: Sequence[str] = SHORT_MONTHS) -> DataFrame:
    """(name, month, start): names to be matched closely, and their unambiguous starts, which must be met exactly."""
    names = [(name, i % 12 + 1) for group in (full, short) for i, name in enumerate(group)]
    starts: dict[str, set[int]] = {}
    for name, month in names:
        for n in range(3, len(name)):
            starts.setdefault(name[:n], set()).add(month)
    known = {name for name, _ in names}
    short_forms = [(s, min(m), True) for s, m in starts.items() if len(m) == 1 and s not in known]
    return inline_table(spark, "name string, month int, start boolean", [(*n, False) for n in names] + short_forms)


def month_numbers(words: DataFrame, word: str, months: DataFrame, cutoff: float) -> DataFrame:
    """(word, month): the month each distinct word names, though misspelt or shortened; words that name none are left out.

    The list of names is part of the plan and short, so it is unfolded beside each distinct word.
    """
    names = months.limit(MAX_MONTH_NAMES + 1).collect()
    if len(names) > MAX_MONTH_NAMES:
        raise ValueError(f"more than {MAX_MONTH_NAMES} month names")
    listed = F.array(*[F.struct(F.lit(r["name"]).alias("name"), F.lit(r["month"]).alias("month"), F.lit(r["start"]).alias("start")) for r in names])
    pairs = words.select(word).filter(F.col(word).isNotNull()).distinct().select(word, F.explode(listed).alias("_m")).select(word, "_m.*")
    near = places.edit_similarity(F.col(word), F.col("name"))
    # A start counts if it is the very word, and less than any name that is near enough.
    scored = pairs.withColumn("_score", F.when(F.col("start"), F.when(F.col(word) == F.col("name"), -1.0)).otherwise(near))
    fit = scored.filter((F.col("_score") >= cutoff - places.EPS) | (F.col("start") & F.col("_score").isNotNull()))
    return fit.groupBy(word).agg(F.max_by("month", F.struct("_score", "name")).alias("month"))


# A text is read as its numbers and the gaps between them: what can be a date is told by a number and the gap behind it.
DIGITS = "[0-9]+"
# A gap of one word, of a mark or word that leads on to a second date, or of both.
GAP = "^\\s*(\\p{L}[^\\s–-]*)?\\s*([/–-]|to|ถึง)?\\s*$"
ONE_WORD = r"^\s*(\p{L}\S*)\s*$"
LEADS_ON = ("-", "–", "to", "ถึง")


def _numbers_and_gaps(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, _n, _g): the numbers of a text, and the gaps; gap i stands before number i, the last one after the last."""
    return df.filter(F.col(text).rlike(DIGITS)).select(
        doc, F.regexp_extract_all(F.col(text), F.lit(DIGITS), F.lit(0)).alias("_n"), F.split(F.col(text), DIGITS, -1).alias("_g"))


def _places(numbers: Column, holds) -> Column:
    """One row per place of a number for which `holds`."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.size(numbers) - 1), holds)).alias("pos")


def _iso(year: Column, month: Column, day: Column) -> Column:
    parts = [F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]).try_cast("date")


def text_dates(df: DataFrame, doc: str, text: str, months: DataFrame, cutoff: float = 0.60) -> DataFrame:
    """(doc, pos, date) for every date in words: two numbers, a day and a year, with one word between them.

    Month names may be misspelt. Years are Buddhist, two digits mean 25xx. pos is the number of the day among the numbers
    of the text.
    """
    def dated(i):
        year = F.get("_n", i + 1)
        return (F.length(F.get("_n", i)) <= 2) & F.get("_g", i + 1).rlike(ONE_WORD) & (
            (F.length(year) == 2) | ((F.length(year) == 4) & F.startswith(year, F.lit("25"))))

    cells = _numbers_and_gaps(df, doc, text).select(doc, "_n", "_g", _places(F.col("_n"), dated)).select(
        doc, "pos", F.get("_n", F.col("pos")).cast("int").alias("_day"), F.regexp_extract(F.get("_g", F.col("pos") + 1), ONE_WORD, 1).alias("_word"),
        F.get("_n", F.col("pos") + 1).cast("int").alias("_year"))
    cells = settle(cells.filter(F.col("_day") <= 31), "dates")
    found = cells.join(month_numbers(cells, "_word", months, cutoff).withColumnRenamed("month", "_month"), "_word")
    return found.select(doc, "pos", _iso(to_gregorian_year("_year"), F.col("_month"), F.col("_day")).alias("date")).filter(F.col("date").isNotNull())


def last_text_date(df: DataFrame, doc: str, text: str, months: DataFrame, **options) -> DataFrame:
    return text_dates(df, doc, text, months, **options).groupBy(doc).agg(
        F.min_by("date", "pos").alias("first"), F.max_by("date", "pos").alias("last"), F.count("*").alias("n"))


# A piece of a date: any field but the day may be missing; `width` numbers belong to it.
PIECE = "struct<day: int, month: int, word: string, year: int, width: int>"


def _piece(kind: Column, day: Column, month: Column | None, word: Column | None, year: Column | None, width: int) -> Column:
    none = F.lit(None)
    cells = [day, none if month is None else month, none if word is None else word, none if year is None else year]
    fields = [c if i == 2 else c.try_cast("int") for i, c in enumerate(cells)]
    return F.when(F.coalesce(kind, F.lit(False)), F.struct(*fields, F.lit(width)).cast(PIECE))


def date_pieces(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, pos, piece, next): pieces of dates, and the place of the number after the mark that leads on, if one does.

    A piece is all numbers (day, month, year between slashes or dashes), a day, a month word and a year, a day and a
    month word, or a bare day; at one place several readings may be possible.
    """
    here = F.col("pos")

    def number(k):
        return F.get("_n", here + k)

    def gap(k):
        return F.get("_g", here + k + 1)

    def word(k):
        return F.regexp_extract(gap(k), GAP, 1)

    def lead(k):
        """What leads on in the gap behind number k; a word that does so may be the gap's only word."""
        return F.when(F.regexp_extract(gap(k), GAP, 2).isin(*LEADS_ON), F.regexp_extract(gap(k), GAP, 2)).when(word(k).isin(*LEADS_ON), word(k))

    def month_word(k):
        return (word(k) != "") & ~word(k).isin(*LEADS_ON)

    def tight(k):
        return gap(k).isin("/", "-")

    near = _numbers_and_gaps(df, doc, text).select(doc, "_n", "_g", _places(F.col("_n"), lambda i: (F.length(F.get("_n", i)) <= 2) & (
        F.get("_g", i + 1).rlike(GAP) | F.get("_g", i + 1).rlike(r"^\s*\p{L}"))))
    year = F.length(number(1)) == 4
    open_word = F.regexp_extract(gap(0), r"^\s*(\p{L}\S*)", 1)
    readings = [
        (_piece(tight(0) & tight(1) & (F.length(number(1)) <= 2) & F.length(number(2)).isin(2, 4), number(0), number(1), None, number(2), 3), lead(2)),
        (_piece(month_word(0) & (F.regexp_extract(gap(0), GAP, 2) == "") & year, number(0), None, word(0), number(1), 2), lead(1)),
        (_piece(open_word != "", number(0), None, F.when(month_word(0), word(0)).otherwise(open_word), None, 1), F.when(month_word(0), lead(0))),
        (_piece((word(0) == "") | ~month_word(0), number(0), None, None, None, 1), F.when(~F.endswith(F.get("_g", here), F.lit("/")), lead(0)))]
    every = F.array_compact(F.array(*[F.when(p.isNotNull(), F.struct(p.alias("piece"), F.when(l.isNotNull(), here + p["width"]).alias("next"))) for p, l in readings]))
    return near.select(doc, "pos", F.explode(every).alias("_r")).select(doc, "pos", "_r.*")


def date_ranges(df: DataFrame, doc: str, text: str, months: DataFrame, cutoff: float = 0.85) -> DataFrame:
    """(doc, start, end) of the first date range in a text, null if there is none; `doc` identifies a text.

    Pieces that something leads on from are paired with the piece it leads to, and take from each other what they lack:
    a month or a year stated once, on either side, holds for both. A bare day is the last such day up to the end.
    """
    pieces = settle(date_pieces(df, doc, text).select(doc, "pos", "next", "piece.*"), "pieces")
    left = pieces.filter(F.col("next").isNotNull()).select(doc, "next", F.col("pos").alias("_at"), *[F.col(c).alias(f"_{c}1") for c in ("day", "month", "word", "year", "width")])
    right = pieces.filter("month IS NOT NULL OR word IS NOT NULL").select(doc, F.col("pos").alias("next"), *[F.col(c).alias(f"_{c}2") for c in ("day", "month", "word", "year", "width")])
    pairs = settle(left.join(right, [doc, "next"]), "pairs")
    words = pairs.select(F.explode(F.array("_word1", "_word2")).alias("_word"))
    known = month_numbers(words, "_word", months, cutoff)
    for n in (1, 2):
        pairs = pairs.join(known.select(F.col("_word").alias(f"_word{n}"), F.col("month").alias(f"_named{n}")), f"_word{n}", "left").withColumn(
            f"_month{n}", F.coalesce(f"_month{n}", f"_named{n}"))
    stated1, stated2 = (to_gregorian_year(f"_year{n}", guess=True) for n in (1, 2))
    pairs = pairs.withColumns({"_y1": F.coalesce(stated1, stated2), "_y2": F.coalesce(stated2, stated1)}).filter("_word1 IS NULL OR _month1 IS NOT NULL")
    start, end = _iso(F.col("_y1"), F.col("_month1"), F.col("_day1")), _iso(F.col("_y2"), F.col("_month2"), F.col("_day2"))
    pairs = pairs.withColumns({"start": start, "end": end})
    turned = F.col("start") > F.col("end")  # a year stated once, across a new year
    pairs = pairs.withColumns({
        "start": F.when(turned & F.col("_year1").isNull(), F.add_months("start", -12)).otherwise(F.col("start")),
        "end": F.when(turned & F.col("_year2").isNull(), F.add_months("end", 12)).otherwise(F.col("end"))})
    pairs = pairs.withColumn("start", F.when(F.col("_month1").isNull(), previous_day_of_month("end", "_day1")).otherwise(F.col("start")))
    rank = F.struct("_at", -F.col("_width1"), -F.col("_width2"))
    best = pairs.filter("start <= end").groupBy(doc).agg(F.min_by(F.struct("start", "end"), rank).alias("_best"))
    return join_same(df.select(doc), best, [doc], "left").select(doc, "_best.start", "_best.end")


# ---- links --------------------------------------------------------------------------------------

LINK = r"(?is)<a\b[^>]*?\bhref=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def links(df: DataFrame, page: str, url: str, html: str, ext: str | None = None, match: str | None = None) -> DataFrame:
    """(page, position, link): distinct absolute links per page in order of first appearance."""
    found = F.arrays_zip(*[F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(i)).alias(n) for i, n in ((1, "href"), (2, "label"))])
    label = F.trim(F.regexp_replace(F.regexp_replace(F.col("_a.label"), r"(?s)<[^>]*>", " "), r"\s+", " "))
    all_links = df.select(page, F.col(url).alias("_url"), F.posexplode(found).alias("_pos", "_a")).select(
        page, "_pos", "_url", F.trim(F.regexp_replace("_a.href", "&amp;", "&")).alias("_href"), label.alias("_label")).filter((F.col("_href") != "") & has_extension(F.col("_href"), ext))
    if match:
        all_links = all_links.filter(F.col("_label").rlike(match))
    return all_links.groupBy(page, absolute_url(F.col("_href"), F.col("_url")).alias("link")).agg(F.min("_pos").alias("position"))


# ---- sequences ----------------------------------------------------------------------------------

def positions(df: DataFrame, keys: Sequence[str], order: str, out: str = "pos", width: float | None = None) -> DataFrame:
    """1, 2, 3 ... along a unique numeric order within keys. `width` splits long keys, as in `running_total`."""
    return running_total(df.withColumn("_one", F.lit(1)), keys, order, "_one", out, width).drop("_one")


def runs(df: DataFrame, keys: Sequence[str], order: str, condition: Column, out: str = "run", width: float | None = None) -> DataFrame:
    """Number of the alternating run each item is in; run 0 holds items before the first that meets the condition.

    `width` splits long sequences, as in `scan.run_numbers`.
    """
    return run_numbers(df, keys, order, condition, out, width)


def pairs(df: DataFrame, keys: Sequence[str], order: str, value: str, width: float | None = None) -> DataFrame:
    """Items paired up in order: first with second, third with fourth; an odd last item is left out."""
    placed = positions(df.select(*keys, order, value), keys, order, "_pos", width)
    two = placed.groupBy(*keys, F.floor((F.col("_pos") - 1) / 2).alias("pair")).agg(
        F.min_by(value, "_pos").alias("first"), F.max_by(value, "_pos").alias("second"), F.count("*").alias("_n"))
    return two.filter("_n = 2").drop("_n")


def threads(df: DataFrame, thread: Sequence[str], order: str, text: str, condition: Column, width: float | None = None) -> DataFrame:
    """(thread, part, text): matching messages of a thread in order, repeated texts once.

    The thread stays in rows; with a `width` a thread of any length is numbered by many tasks.
    """
    firsts = df.filter(condition).groupBy(*thread, text).agg(F.min(order).alias("_at"))
    return positions(firsts, thread, "_at", "part", width).select(*thread, "part", text)


# ---- statistics from reports ----------------------------------------------------------------------

def report_statistics(df: DataFrame, keys: Sequence[str], text: str, prio: str, metrics: Mapping[str, Sequence[str]], **options) -> DataFrame:
    """One row per key with a number per metric from anchored text; better sources outrank others per cell."""
    parsed = df.select(*keys, prio, *[number_near(text, anchors, **options).alias(m) for m, anchors in metrics.items()])
    return priority_merge(parsed, keys, list(metrics), prio)


# A place name in any script with its count in brackets, and an optional second bracket with a sub-count.
_NAME = r"\p{L}[\p{L}\p{M}\p{N}_. ]*?"
PLACE_COUNT = rf"({_NAME}) *\((\d[\d,]*)\)(?: *\({_NAME} (\d[\d,]*)\))?"


def place_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, place, n): every 'Place (n)' of a text; a sub-count in a second bracket is taken off its place."""
    found = F.arrays_zip(*[F.regexp_extract_all(F.col(text), F.lit(PLACE_COUNT), F.lit(i)).alias(n) for i, n in ((1, "place"), (2, "n"), (3, "sub"))])

    def number(c):
        return F.coalesce(F.regexp_replace(c, ",", "").try_cast("bigint"), F.lit(0))

    return df.select(doc, F.explode(found).alias("_p")).select(
        doc, F.trim("_p.place").alias("place"), (number(F.col("_p.n")) - number(F.col("_p.sub"))).alias("n"))


def checked_place_counts(df: DataFrame, doc: str, text: str, total: str, aliases: DataFrame, **options) -> DataFrame:
    """(doc, place, n, total, agrees): canonical places with their sum, compared with the stated total."""
    read = settle(place_counts(df, doc, text), "places")
    listed = settle(places.canonical_places(read, aliases, "place", **options).groupBy(doc, "place").agg(F.sum("n").alias("n")), "listed")
    sums = listed.groupBy(doc).agg(F.sum("n").alias("_sum"))
    return listed.join(sums, doc).join(df.select(doc, total), doc).select(
        doc, "place", "n", total, (F.col("_sum") == F.col(total)).alias("agrees"))


def table_lines(df: DataFrame, doc: str, text: str, numbers: int, ints: bool = True) -> DataFrame:
    """(doc, line, label, numbers): lines that are a label followed by exactly so many numbers."""
    lines = df.select(doc, F.posexplode(F.split(F.col(text), "\n")).alias("line", "_text"))
    label = F.trim(F.regexp_extract("_text", r"^([^\d]*)", 1))
    return lines.select(doc, "line", label.alias("label"), numbers_in("_text", ints).alias("numbers")).filter(
        (F.size("numbers") == numbers) & (F.col("label") != ""))


def people_summary(df: DataFrame, keys: Sequence[str], age: str, gender: str, female: str, male: str, width: float | None = None) -> DataFrame:
    """Median, lowest and highest age and counts by gender per key."""
    basic = df.groupBy(*keys).agg(
        F.min(age).alias("age_min"), F.max(age).alias("age_max"), F.count(F.when(F.col(gender) == female, 1)).alias("female"),
        F.count(F.when(F.col(gender) == male, 1)).alias("male"), F.count("*").alias("n"))
    return basic.join(exact_quantile(df, keys, age, 0.5, "age_median", width), list(keys), "left")


def resolve_tokens(df: DataFrame, doc: str, text: str, dim: DataFrame, key: str, name: str, cutoff: float = places.CUTOFF,
                   split: str = r"[\s,]+") -> DataFrame:
    """(doc, name): the places named in a run-together text, only if every token resolves."""
    tokens = settle(df.select(doc, F.explode(F.split(F.trim(F.col(text)), split)).alias("_token")).filter("_token <> ''"), "tokens")
    found = places.resolve(tokens, dim, "_token", key, cutoff)
    looked = tokens.join(found, "_token", "left").join(dim.select(F.col(key).alias("match"), F.col(name).alias("_name")), "match", "left")
    whole = looked.groupBy(doc).agg(F.bool_and(F.col("match").isNotNull()).alias("_all")).filter("_all").select(doc)
    return looked.join(whole, doc, "left_semi").select(doc, F.col("_name").alias(name))


def dictionary_counts(df: DataFrame, keys: Sequence[str], text: str, total: str, dictionary: Mapping[str, Sequence[str]], until: str = r"\)") -> DataFrame:
    """Per category the number after its first spelling found, up to a required closing mark.

    A number above the document's own total is not believed.
    """
    def counted(spellings):
        n = number_near(text, spellings, until=until, require_until=True)
        return F.when(n <= F.col(total), n)

    return df.select(*keys, *[counted(s).alias(c) for c, s in dictionary.items()])


# Tokens of a text that is looked up: numbers, words, and single other marks.
TOKEN = r"[0-9]+(?:,[0-9]{3})*|[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"
LONGEST_SPELLING = 16


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def dictionary_hits(df: DataFrame, keys: Sequence[str], text: str, dictionary: DataFrame, spelling: str, category: str) -> DataFrame:
    """(keys, pos, words, spelling, category): every place where a text has a spelling, case aside, whole words only.

    A text is read once however many spellings there are: each of its tokens starts one phrase for every length a spelling
    can have, and phrases meet the dictionary in one equi-join, which Spark broadcasts or shuffles by the dictionary's size.
    At one place the longest spelling counts, in all its categories. Spellings of more than LONGEST_SPELLING tokens are an
    error. `keys` identify a text.
    """
    known = dictionary.select(F.col(spelling).alias("spelling"), F.col(category).alias("category"), _tokens(F.col(spelling)).alias("_t")).filter(F.size("_t") > 0)
    known = known.select("spelling", "category", F.size("_t").alias("words"), F.array_join("_t", " ").alias("_phrase")).distinct()
    lengths = [r[0] for r in known.select("words").distinct().limit(LONGEST_SPELLING + 1).collect()]
    if lengths and max(lengths) > LONGEST_SPELLING:
        raise ValueError(f"a spelling has more than {LONGEST_SPELLING} words")
    sizes = F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>")
    starts = df.select(*keys, _tokens(F.col(text)).alias("_t")).filter(F.size("_t") > 0).select(
        *keys, "_t", F.explode(F.sequence(F.lit(0), F.size("_t") - 1)).alias("pos")).select(
        *keys, "pos", F.slice("_t", F.col("pos") + 1, F.lit(max(lengths, default=1))).alias("_next"))
    phrases = starts.select(*keys, "pos", "_next", F.explode(sizes).alias("words")).filter(F.size("_next") >= F.col("words")).select(
        *keys, "pos", "words", F.array_join(F.slice("_next", F.lit(1), F.col("words")), " ").alias("_phrase"))
    hits = phrases.join(known, ["_phrase", "words"]).drop("_phrase")
    longest = F.max("words").over(Window.partitionBy(*keys, "pos"))
    return hits.withColumn("_longest", longest).filter(F.col("words") == F.col("_longest")).select(*keys, "pos", "words", "spelling", "category")


def dictionary_numbers(df: DataFrame, keys: Sequence[str], text: str, dictionary: DataFrame, spelling: str, category: str,
                       until: str = r"\)", total: str | None = None) -> DataFrame:
    """(keys, part, pos, spelling, category, value): the first number after each spelling, up to a required closing mark.

    The text is cut at the marks; what follows the last one is closed by nothing and not read. A number above the text's
    own total is not believed, and a spelling without a number gives nothing.
    """
    cut = F.split(F.col(text), until, -1)
    more = [total] if total else []
    parts = df.select(*keys, *more, F.posexplode(F.slice(cut, F.lit(1), F.greatest(F.size(cut) - 1, F.lit(0)))).alias("part", "_text"))
    hits = dictionary_hits(parts, [*keys, "part"], "_text", dictionary, spelling, category)
    read = hits.join(parts, [*keys, "part"])
    after = F.slice(_tokens(F.col("_text")), F.col("pos") + F.col("words") + 1, F.size(_tokens(F.col("_text"))))
    first = F.get(F.filter(after, lambda t: t.rlike("^[0-9]")), F.lit(0))
    value = F.regexp_replace(first, ",", "").try_cast("bigint")
    out = read.withColumn("value", value).filter("value IS NOT NULL")
    if total:
        out = out.filter(F.col("value") <= F.col(total))
    return out.select(*keys, "part", "pos", "spelling", "category", "value")


def first_numbers(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, category, value): per category what follows its first spelling in the text."""
    return found.groupBy(*keys, "category").agg(F.min_by("value", F.struct("part", "pos", "spelling")).alias("value"))


def layout_rows(df: DataFrame, keys: Sequence[str], kind: Column, numbers: Column, layouts: DataFrame) -> DataFrame:
    """(keys, metric, value): numbers of a row become named metrics by table kind and how many there are.

    `layouts` has (kind, n, pos, metric). Rows no layout fits come out once, as metric 'unmatched'.
    """
    rows = df.select(*keys, kind.alias("kind"), numbers.alias("_numbers")).withColumn("n", F.size("_numbers"))
    known = layouts.select("kind", "n").distinct().withColumn("_known", F.lit(True))
    tagged = rows.join(known, ["kind", "n"], "left")
    cells = tagged.filter("_known").select(*keys, "kind", "n", F.posexplode("_numbers").alias("pos", "value"))
    matched = cells.join(layouts, ["kind", "n", "pos"]).select(*keys, "metric", "value")
    errors = tagged.filter("_known IS NULL").select(*keys, F.lit("unmatched").alias("metric"), F.col("n").cast("bigint").alias("value"))
    return matched.unionByName(errors)


