"""Merkle manifest of a dataset: leaf hashes, trees of fixed arity per group, a tree over the groups, inclusion proofs.

A leaf is the SHA-256 (lowercase hex) of the named fields, each `-` if null and otherwise its byte count, `:` and its
value. Leaves of a group are numbered in key order. Per level, every `ARITY` consecutive nodes are a run: fixed-offset
lag and lead columns, masked by the node's slot and the run's length, give each node its siblings, and the row in slot 0
hashes the run to the parent. The subroots, in order of their group, form the upper tree in the same way.

No task holds a group. Numbers come from one range sort, of which each sorted part counts its own rows and small sums
per (group, part) give the starts. A window's partition is a run, so it has ARITY rows at most, and the join that hands
the parents' paths down reuses the shuffle and the order of that window. Only the hashes are sorted; texts are read once.

Defined cases: a null group is a group and comes first; a null key comes first in its group; rows that repeat a key are
ordered by their leaf (equal rows are interchangeable); null and empty fields have different hashes; a group of one leaf
is its own subroot and a dataset of one group has that group's subroot as its root; a proof without siblings is the hash
of nothing; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.llm.common import col, pick
from epitide.sources.stage import settle

ARITY = 8
PART = 33  # bits that monotonically_increasing_id() leaves to a row's place within its partition


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts; nulls are nothing."""
    return F.sha2(F.concat_ws("", *texts), 256)


def field(value: Column) -> Column:
    """One field of a leaf, self-delimiting: `-`, or byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


# ---- numbering --------------------------------------------------------------------------------------

def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """All columns, `i` (place within the group from 0) and `n` (size of the group); the group must not be null."""
    placed = settle(rows.orderBy(group, *[F.col(c).asc_nulls_first() for c in order]).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", PART)
    counts = placed.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    sizes = counts.groupBy(group).agg(F.sum("_n").alias("n"))
    return placed.withColumn("_part", part).join(starts, [group, "_part"]).join(sizes, group).withColumn(
        "i", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


# ---- one level --------------------------------------------------------------------------------------

def siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """`nodes` (grp, i, n, node, ...) with run, slot, left and right: the hashes before and after the node in its run.

    The masks hold for any partition of the window that keeps runs whole; the run itself is the least such partition.
    """
    run = Window.partitionBy("grp", "run").orderBy("i")
    rows = nodes.withColumns({"run": F.floor(F.col("i") / arity), "slot": F.col("i") % arity})
    length = F.least(F.lit(arity), F.col("n") - F.col("run") * arity)
    lags = [F.when(F.col("slot") >= k, F.lag("node", k).over(run)) for k in range(arity - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < length, F.lead("node", k).over(run)) for k in range(1, arity)]
    return rows.withColumns({"left": F.concat_ws("", *lags), "right": F.concat_ws("", *leads)})


def parents(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level: the first child of every run, hashed with the siblings to its right. Groups of one node are done."""
    first = siblings(nodes.filter("n > 1"), arity).filter("slot = 0")
    return first.select("grp", F.col("run").alias("i"), F.ceil(F.col("n") / arity).alias("n"), digest(F.col("node"), F.col("right")).alias("node"))


def climb(leaves: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """The levels (grp, i, n, node) from the leaves up; a group's last node is its root. Each level is written, an eighth of the one below."""
    levels = [leaves]
    while levels[-1].filter("n > 1").limit(1).count():
        levels.append(settle(parents(levels[-1], arity), "level"))
    return levels


def descend(levels: list[DataFrame], tops: DataFrame | None = None, arity: int = ARITY) -> DataFrame:
    """The leaves with `path`: (left, right) from the leaf's level up, then what `tops` (grp, path) says of the group's root (nothing, by default)."""
    known, nothing = None, F.array().cast("array<struct<left:string,right:string>>")
    for nodes in reversed(levels):
        roots = nodes.filter("n = 1").select("grp")
        roots = roots.withColumn("path", nothing) if tops is None else roots.join(tops, "grp")
        roots = roots.select("grp", F.lit(0).cast("bigint").alias("run"), F.col("path").alias("above"))
        known = roots if known is None else known.unionByName(roots)
        own = F.array(F.struct("left", "right"))
        rows = siblings(nodes, arity).join(known, ["grp", "run"])
        rows = rows.withColumn("path", F.when(F.col("n") > 1, F.concat(own, "above")).otherwise(F.col("above")))
        if nodes is levels[0]:
            return rows.drop("run", "slot", "left", "right", "above")
        known = settle(rows.select("grp", F.col("i").alias("run"), F.col("path").alias("above")), "paths")
    raise AssertionError


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


# ---- the operator -----------------------------------------------------------------------------------

def manifest(df: DataFrame, key: str, group: str, fields: Mapping[str, Column], tampered: Mapping[str, Column], where: Column, arity: int = ARITY) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified), one row per input row.

    `fields` are the leaf's columns in order; rows `where` holds are folded again from the leaf of the `tampered` values
    (by name, for those fields that differ), the others from their own leaf.
    """
    own, other = list(fields.values()), [tampered.get(name, value) for name, value in fields.items()]
    changed = F.coalesce(where, F.lit(False))
    rows = pick(df, key=key, grp=F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit("")), node=leaf(*own),
                shown=F.when(changed, leaf(*other)), uid=F.monotonically_increasing_id())
    hashed = settle(rows, "leaves")  # uid only deals equal rows over the parts of the sort
    leaves = numbered(hashed, "grp", "key", "node", "uid").drop("uid")
    levels = climb(leaves.select("grp", "i", "n", "node"), arity)
    subroots = levels[0].filter("n = 1").select("grp", "node")
    for nodes in levels[1:]:
        subroots = subroots.union(nodes.filter("n = 1").select("grp", "node"))
    upper = numbered(subroots.select(F.substring("grp", 1, 0).alias("grp"), F.col("grp").alias("name"), "node"), "grp", "name")
    above = climb(upper.select("grp", "i", "n", "node"), arity)
    roots = above[0].filter("n = 1").select("node")
    for nodes in above[1:]:
        roots = roots.union(nodes.filter("n = 1").select("node"))
    named = upper.select("name", "i", F.col("node").alias("subroot"))
    tops = descend(above, None, arity).join(named, "i").select(F.col("name").alias("grp"), "path", "subroot")
    tops = settle(tops.withColumn("root", roots.agg(F.max("node")).scalar()), "tops")
    paths = descend([leaves, *levels[1:]], tops.select("grp", "path"), arity)
    subs = tops.select("grp", "subroot", "root")
    return paths.join(subs, "grp").select(
        F.col("key").alias(key), F.col("node").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("shown", "node"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
