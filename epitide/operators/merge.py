"""Merging sources: first non-null value by source priority, per cell.

In long form any number of sources merge in one shuffle: rows are united with their priority and
one aggregation picks, per (key, metric), the non-null value of the best source. The aggregation
combines on the map side, so a key with very many rows sends one row per task to its reducer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.model import cols

SOURCES = "sources"  # metadata of a priority column: how many sources are stacked


def stack_sources(*sources: DataFrame, prio: str = "prio") -> DataFrame:
    """Union of sources, best first; a column absent from one source is null there.

    The priority column says in its metadata how many sources there are, so that a merge need not be told.
    """
    tagged = [s.withColumn(prio, F.lit(i).alias(prio, metadata={SOURCES: len(sources)})) for i, s in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def priority_merge(df: DataFrame, keys: Sequence[str], values: str | Sequence[str] = "value",
                   prio: str | Column = "prio", provenance: str | None = None,
                   levels: Sequence[int] | Mapping[int, str] | None = None, also: Mapping[str, Column] | None = None) -> DataFrame:
    """Per key and value column, the first non-null value in order of `prio` (low number wins).

    `provenance` names a column: its value on the winning row is returned as `<value>_<provenance>`. Of
    rows with one priority the least value wins, then the least provenance, however the rows are dealt;
    value and provenance come from one row. A null priority comes last.

    `levels` lists the priorities there are, best first (the sources of `stack_sources` are known); as a mapping it
    also names the provenance of each level, which then needs no column. With known levels each is one plain minimum,
    so that numbers stay in hash aggregation; priorities that are not listed come after those that are. Without, the
    minimum is taken over (priority, value) as a struct, for which Spark sorts. `also` adds further aggregates.
    """
    more = [c.alias(n) for n, c in (also or {}).items()]
    if levels is None and isinstance(prio, str) and prio in df.columns and not provenance:
        levels = range(df.schema[prio].metadata.get(SOURCES, 0)) or None
    p = F.col(prio) if isinstance(prio, str) else prio
    if levels is not None and (provenance is None or isinstance(levels, Mapping)):
        slots = [p == n for n in levels] + [~F.coalesce(p.isin(*levels), F.lit(False))]
        picks = [F.min(F.when(slot, F.col(v))).alias(f"_{i}_{v}") for v in cols(values) for i, slot in enumerate(slots)]
        found = df.groupBy(*keys).agg(*picks, *more)
        names = [*levels.values()] if isinstance(levels, Mapping) else []
        out = []
        for v in cols(values):
            out.append(F.coalesce(*[F.col(f"_{i}_{v}") for i in range(len(slots))]).alias(v))
            if provenance:
                out.append(F.coalesce(*[F.when(F.col(f"_{i}_{v}").isNotNull(), F.lit(n)) for i, n in enumerate(names)]).alias(f"{v}_{provenance}"))
        return found.select(*keys, *out, *(also or {}))
    source = [F.col(provenance).alias("s")] if provenance else []
    best = [F.min(F.when(F.col(v).isNotNull(), F.struct(p.isNull().alias("n"), p.alias("p"), F.col(v).alias("v"), *source))).alias(f"_best_{v}") for v in cols(values)]
    out = [x for v in cols(values) for x in (
        F.col(f"_best_{v}.v").alias(v), *([F.col(f"_best_{v}.s").alias(f"{v}_{provenance}")] if provenance else []))]
    return df.groupBy(*keys).agg(*best, *more).select(*keys, *out, *(also or {}))


def combine_first(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two wide sources: union of keys and columns, cells of `first` preferred."""
    shared = [c for c in first.columns if c in second.columns and c not in keys]
    renamed = second.withColumnsRenamed({c: f"__{c}" for c in shared})
    joined = first.join(renamed, list(keys), "full")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in shared}).drop(
        *[f"__{c}" for c in shared])


def latest_wins(df: DataFrame, keys: Sequence[str], arrival: str | Sequence[str], newest: bool = True) -> DataFrame:
    """One whole row per key: the last to arrive (or the first, with newest=False).

    Of rows that arrived together the greatest (least) in its other columns is taken, so the choice does
    not depend on how rows are dealt. A maximum over the row as a struct keeps map-side combining, which
    row_number would not.
    """
    first = cols(arrival)
    rest = first + [c for c in df.columns if c not in keys and c not in first]
    row = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg((F.max(row) if newest else F.min(row)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def apply_corrections(df: DataFrame, corrections: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    """Overrides: a row of `corrections` (on..., bad_value, new_value, only_bad) replaces the value.

    With only_bad, the override is used only where the present value equals bad_value. new_value may
    be null, which blanks the cell.
    """
    c = corrections.select(*on, "bad_value", "new_value", "only_bad", F.lit(True).alias("_hit"))
    joined = df.join(c, list(on), "left")
    applies = F.col("_hit") & (~F.col("only_bad") | F.col(value).eqNullSafe(F.col("bad_value")))
    return joined.withColumn(
        value, F.when(F.coalesce(applies, F.lit(False)), F.col("new_value")).otherwise(F.col(value))
    ).select(*df.columns)


def append_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append and drop exact duplicate rows; rows that differ anywhere are both kept."""
    return a.unionByName(b).distinct()
