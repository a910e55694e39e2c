"""Expressions over text: anchored numbers, dates in file names, links."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers with thousands commas, with and without decimals.
INTEGERS = r"\d+(?:\,\d+)*"
NUMBERS = r"\d+(?:\,\d+)*(?:\.\d+)?"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numbers_in(text: str | Column, ints: bool = True, dash_as_zero: bool = False) -> Column:
    """All numbers of a text in order, commas removed."""
    t = _c(text)
    if dash_as_zero:
        t = F.regexp_replace(t, "-", "0")
    kind = "bigint" if ints else "double"
    found = F.regexp_extract_all(t, F.lit(INTEGERS if ints else NUMBERS), F.lit(0))
    return F.transform(found, lambda x: F.regexp_replace(x, ",", "").try_cast(kind))


def numbers_near(text: str | Column, anchors: Sequence[str], until: str | None = None, before: bool = False,
                 ints: bool = True, dash_as_zero: bool = False, require_until: bool = False) -> Column:
    """Numbers after (or, nearest first, before) the first anchor pattern found, up to a stop pattern.

    Anchors are tried in order; with require_until, one whose stop is not found is passed over. No
    usable anchor gives an empty array.
    """
    t = _c(text)
    out = None
    for anchor in anchors or [""]:
        if anchor:
            sides = F.split(t, anchor, 2)
            usable = F.size(sides) == 2
            found = F.get(sides, F.lit(0 if before else 1))
        else:
            usable, found = F.lit(True), t
        if until is not None:
            cut = F.split(found, until, 2)
            if require_until:
                usable = usable & (F.size(cut) == 2)
            found = F.get(cut, F.lit(0))
        numbers = numbers_in(found, ints, dash_as_zero)
        if before:
            numbers = F.reverse(numbers)
        out = F.when(usable, numbers) if out is None else out.when(usable, numbers)
    return out.otherwise(F.array().cast("array<bigint>" if ints else "array<double>"))


def number_near(text: str | Column, anchors: Sequence[str], default=None, **options) -> Column:
    first = F.get(numbers_near(text, anchors, **options), F.lit(0))
    return first if default is None else F.coalesce(first, F.lit(default))


def file_date(name: str | Column) -> Column:
    """Date in a file name: 2021-02-10, 2021.2.10, 20210210, or ddmmyy with a 6x year as Buddhist."""
    base = F.regexp_replace(F.regexp_extract(_c(name), r"([^/]*)$", 1), r"\.[^.]*$", "")
    iso = F.regexp_extract(base, r"\d{4}-\d{1,2}-\d{1,2}", 0)
    dotted = F.regexp_replace(F.regexp_extract(base, r"\d{4}\.\d{1,2}\.\d{1,2}", 0), r"\.", "-")
    digits = F.regexp_extract(base, r"\d{8}|\d{6}", 0)

    def part(start, size):
        return F.substring(digits, start, size)

    short_year = part(5, 2).try_cast("int") + F.when(part(5, 1) == "6", F.lit(1957)).otherwise(F.lit(2000))
    return (
        F.when(iso != "", iso.try_cast("date"))
        .when(dotted != "", dotted.try_cast("date"))
        .when(F.length(digits) == 8, F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2)).try_cast("date"))
        .when(F.length(digits) == 6, F.concat_ws("-", short_year.cast("string"), part(3, 2), part(1, 2)).try_cast("date")))


def slash_dates(text: str | Column, buddhist: bool = True) -> Column:
    """Distinct dd/mm/yyyy dates of a text, ascending."""
    def parsed(x):
        year = F.substring(x, 7, 4).cast("int") - (543 if buddhist else 0)
        return F.concat_ws("-", year.cast("string"), F.substring(x, 4, 2), F.substring(x, 1, 2)).try_cast("date")

    found = F.regexp_extract_all(_c(text), F.lit(r"[0-9]{2}/[0-9]{2}/2[0-9]{3}"), F.lit(0))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(found, parsed))))


def absolute_url(href: Column, page: Column) -> Column:
    """A link relative to the page it stands on."""
    origin = F.regexp_extract(page, r"^[a-zA-Z]+://[^/?#]+", 0)
    scheme = F.regexp_extract(page, r"^[a-zA-Z]+:", 0)
    folder = F.regexp_extract(F.regexp_replace(page, r"[?#].*$", ""), r"^([a-zA-Z]+://[^/]+(?:/.*)?/)[^/]*$", 1)
    folder = F.when(F.length(folder) > F.length(origin), folder).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(page, r"#.*$", ""), href))
        .otherwise(F.concat(folder, href)))


def has_extension(href: Column, ext: str | None) -> Column:
    return F.lit(True) if not ext else F.size(F.split(href, re.escape(ext))) == 2
