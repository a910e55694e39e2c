"""Running values and run numbers along an order, for keys of any size.

A plain ordered window sends all rows of a key to one task. With a `width` the order column is cut into pieces of that
width: each piece is scanned by itself, one row per (key, piece) says what the piece hands on, these rows are scanned in
turn, and what arrives at a piece is joined back to its rows. Results are the same for any width and without one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.operators.ordered import join_same

_KINDS = {"last": lambda c: F.last(c, ignorenulls=True), "min": F.min, "max": F.max}


def _combined(kind: str, carried: Column, own: Column) -> Column:
    if kind == "last":
        return F.coalesce(own, carried)
    return F.least(carried, own) if kind == "min" else F.greatest(carried, own)  # both skip nulls


def running(df: DataFrame, keys: Sequence[str], order: str, wanted: Mapping[str, tuple[str, Column]], width: float | None = None,
            ties: Sequence[str] = ()) -> DataFrame:
    """Adds columns: the last non-null value ("last"), or the lowest or highest ("min", "max"), up to and including each row.

    `wanted` maps a new name to (kind, value). Rows go by `order` (numeric, not null), then by `ties`; rows that agree in
    both must not differ in the values, or the result is any of theirs.
    """
    named = df.withColumns({f"_v_{n}": v for n, (_, v) in wanted.items()})
    parts, along = list(keys), [order, *ties]
    if width is not None:
        named = named.withColumn("_piece", F.floor(F.col(order) / F.lit(width)))
        parts.append("_piece")
    within = Window.partitionBy(*parts).orderBy(*along).rowsBetween(Window.unboundedPreceding, 0)
    own = {n: _KINDS[kind](F.col(f"_v_{n}")).over(within) for n, (kind, _) in wanted.items()}
    drop = [f"_v_{n}" for n in wanted]
    if width is None:
        return named.withColumns(own).drop(*drop)
    place = F.struct(*along) if ties else F.col(order)

    def handed(n, kind):
        v = F.col(f"_v_{n}")
        return F.max_by(v, F.when(v.isNotNull(), place)) if kind == "last" else _KINDS[kind](v)

    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    given = named.groupBy(*parts).agg(*[handed(n, kind).alias(f"_h_{n}") for n, (kind, _) in wanted.items()])
    given = given.select(*parts, *[_KINDS[kind](F.col(f"_h_{n}")).over(before).alias(f"_c_{n}") for n, (kind, _) in wanted.items()])
    met = join_same(named.withColumns({f"_o_{n}": c for n, c in own.items()}), given, parts)
    met = met.withColumns({n: _combined(kind, F.col(f"_c_{n}"), F.col(f"_o_{n}")) for n, (kind, _) in wanted.items()})
    return met.drop("_piece", *drop, *[f"_{x}_{n}" for n in wanted for x in "oc"])


def run_numbers(df: DataFrame, keys: Sequence[str], order: str, condition: Column, out: str = "run", width: float | None = None) -> DataFrame:
    """Adds `out`: how often the condition has changed up to a row; it counts as false before the first row.

    `order` must be numeric, not null and unique per key.
    """
    hit = df.withColumn("_hit", F.coalesce(condition, F.lit(False)))
    parts = list(keys)
    if width is not None:
        hit = hit.withColumn("_piece", F.floor(F.col(order) / F.lit(width)))
        parts.append("_piece")
    along = Window.partitionBy(*parts).orderBy(order)
    before = F.lag("_hit").over(along)
    if width is None:
        before = F.coalesce(before, F.lit(False))
    changes = hit.withColumn("_change", F.coalesce(F.col("_hit") != before, F.lit(False)).cast("int"))  # the first row of a piece waits
    own = changes.withColumn(out, F.sum("_change").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    if width is None:
        return own.drop("_hit", "_change")
    pieces = Window.partitionBy(*keys).orderBy("_piece")
    ends = changes.groupBy(*parts).agg(F.sum("_change").alias("_inner"), F.min_by("_hit", order).alias("_first"), F.max_by("_hit", order).alias("_last"))
    ends = ends.withColumn("_entry", (F.col("_first") != F.coalesce(F.lag("_last").over(pieces), F.lit(False))).cast("int"))
    base = ends.select(*parts, F.sum(F.col("_inner") + F.col("_entry")).over(pieces.rowsBetween(Window.unboundedPreceding, 0)).alias("_all"), "_inner")
    base = base.select(*parts, (F.col("_all") - F.col("_inner")).alias("_base"))
    return join_same(own, base, parts).withColumn(out, F.col(out) + F.col("_base")).drop("_hit", "_change", "_piece", "_base")
