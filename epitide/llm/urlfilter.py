"""URL filtering by rules and by a learned tree of path templates.

Per host, the segments of the paths form a tree. Going down from the host, a segment becomes a wildcard where it is
variable (rare below its parent, or a number), has no label, or where its share of bad pages does not differ from that of
its siblings together (two-proportion z test). The branches that differ are merged by bands of that share, so that the
members of one class are alike among themselves however many there are; a class is named by its least segment, with "+"
if there are more. The tree goes down as long as a parent has both bad and good pages and a branch that can be judged;
below, paths are told apart by whether they go on, and by more than one segment. A branch is judged by its own support:
neither the size of its parent nor its depth matters. Each template so found gets a smoothed share of bad pages: its
labelled pages, shrunk to its host, which is shrunk to all pages. Templates whose share reaches a threshold are blocked.

Segments that hold "*", "+" or "%" are written with percent codes in a template, so that no page can pass for a wildcard.

Defined cases: a null url or one without "://" has empty host and path and is judged like any other; a page without a
label counts only as a page; repeated rows are judged alike; without any label nothing is blocked by the method; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.sources.stage import settle

SUPPORT = 20       # pages that a branch needs at least
Z = 1.96           # least difference of a branch and its siblings, in standard errors
BANDS = (0.04, 0.15, 0.31, 0.5, 0.69, 0.85, 0.96)  # cuts of the share of bad pages, of about one width after the arc sine
STRENGTH = 10.0    # labelled pages that the prior is worth
LIMIT = 0.5        # smoothed share of bad pages from which a template is blocked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting (rule, verdict) of a short list of rules like ("example.net/en/", "allow")."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in reversed(ordered):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _branches(open_: DataFrame, support: int) -> DataFrame:
    """(host, template, seg, n, lab, bad, all_lab, all_bad): what can be judged below parents with bad and good pages."""
    child = open_.filter("seg IS NOT NULL").groupBy("host", "template", "seg").agg(
        F.count("*").alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    parent = child.groupBy("host", "template").agg(F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad")).filter(
        (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_lab")))
    sure = (F.col("n") >= support) & (F.col("lab") > 0) & ~F.col("seg").rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$")
    return child.filter(sure).join(parent, ["host", "template"])


def _classes(branches: DataFrame, z: float) -> DataFrame:
    """(host, template, seg, name) of the branches that differ from their siblings together."""
    others, bad_others = F.col("all_lab") - F.col("lab"), F.col("all_bad") - F.col("bad")
    pool = F.col("all_bad") / F.col("all_lab")
    error = F.sqrt(pool * (1 - pool) * (1 / F.col("lab") + 1 / others))
    differs = (others > 0) & (F.abs(F.col("bad") / F.col("lab") - bad_others / others) > z * error)
    share, band = (F.col("bad") + 0.5) / (F.col("lab") + 1.0), F.lit(0)
    for cut in BANDS:
        band = band + (share >= cut).cast("int")
    apart = branches.filter(F.when(F.col("all_lab") > F.col("lab"), differs).otherwise(False)).select("host", "template", "seg", band.alias("band"))
    named = apart.groupBy("host", "template", "band").agg(F.min("seg").alias("least"), F.count("*").alias("many"))
    plain = F.replace(F.replace(F.replace("least", F.lit("%"), F.lit("%25")), F.lit("*"), F.lit("%2A")), F.lit("+"), F.lit("%2B"))
    return apart.join(named, ["host", "template", "band"]).select(
        "host", "template", "seg", F.concat(plain, F.when(F.col("many") > 1, "+").otherwise("")).alias("name"))


def templates(pages: DataFrame, support: int = SUPPORT, z: float = Z) -> DataFrame:
    """`pages` (id, host, path, bad: 1, 0 or null) with the template of each path.

    Each level is one aggregation by (host, parent, segment), which a hot host enters with one row per task and segment,
    and joins with the few branches that can be judged, which are broadcast while small. Only pages whose parent may
    still split go on to the next level.
    """
    steps = F.filter(F.split("path", "/"), lambda s: s != "")
    df = settle(pages.select("*", steps.alias("steps"), F.lit("").alias("template")), "tree")
    ended, level = [], 0
    while True:
        left = F.size("steps") - level
        rest = F.concat("template", F.when(left > 1, "/**").when(left == 1, "/*").otherwise(""))
        seen = df.withColumn("seg", F.get("steps", F.lit(level)))
        branches = settle(_branches(seen, support), "branches")
        if branches.isEmpty():
            break
        going = branches.select("host", "template").distinct().withColumn("going", F.lit(True))
        stays = F.coalesce("going", F.lit(False)) & F.col("seg").isNotNull()
        step = seen.join(going, ["host", "template"], "left").join(_classes(branches, z), ["host", "template", "seg"], "left").select(
            "id", "host", "path", "bad", "steps", F.when(stays, F.concat("template", F.lit("/"), F.coalesce("name", F.lit("*")))).otherwise(rest).alias("template"),
            stays.alias("stays"))
        step = settle(step, "tree")
        ended.append(step.filter("NOT stays").select("id", "host", "path", "bad", "template"))
        df, level = step.filter("stays").drop("stays"), level + 1
    return reduce(DataFrame.union, [*ended, df.select("id", "host", "path", "bad", rest.alias("template"))])


def purity(found: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """(host, template, bad_share): labelled shares of bad pages, shrunk from template to host to all pages."""
    cells = settle(found.groupBy("host", "template").agg(
        F.count("*").alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "cells")
    hosts = cells.groupBy("host").agg(F.sum("lab").alias("host_lab"), F.sum("bad").alias("host_bad"))
    total = cells.agg(F.coalesce(F.sum("lab"), F.lit(0)).alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    base = F.lit(total["bad"] / total["lab"] if total["lab"] else 0.0)
    prior = (F.col("host_bad") + strength * base) / (F.col("host_lab") + strength)
    return cells.join(hosts, "host").select("host", "template", ((F.col("bad") + strength * prior) / (F.col("lab") + strength)).alias("bad_share"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], limit: float = LIMIT, **tree) -> DataFrame:
    """(id, host, path, rule, verdict, template, bad_share) from (id, url, bad)."""
    host, path = parts(F.col("url"))
    found = settle(templates(pages.select("id", host.alias("host"), path.alias("path"), F.col("bad").cast("bigint").alias("bad")), **tree), "found")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bad_share") >= limit, "block").otherwise("allow")
    return found.join(purity(found), ["host", "template"]).select(
        "id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "template", "bad_share")
