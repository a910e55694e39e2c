"""A panel kept up to date: batches merge into stored partitions, are audited in the same pass, and then published.

A store is a folder with two parts. `data/version=<n>/part=<p>` holds what version n wrote: the partitions its batch
touched, and no others. `manifest` holds one small file per published version: for each partition the version that wrote
it last, and the name of the batch. Readers follow the newest manifest, so that a version is visible as
a whole or not at all; a batch that fails, is refused, or dies half-way leaves files that nobody reads. A batch whose name
a manifest knows changes nothing, which is what a streaming query needs that runs a batch again after a failure.

The manifest has one row per partition (a month, a year), so the driver reads no more than a file listing would give it.
`max_parts` bounds it: choose wider partitions beyond that.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitide.operators.merge import priority_merge

PLAIN = re.compile(r"[A-Za-z0-9_.-]+")  # names that are the same as folders
MANIFEST = "part string, written bigint, batch string, version bigint"


@dataclass(frozen=True)
class Check:
    """A condition of publishing: an aggregate over the rows to be written, and the bounds it must keep.

    The rows have the store's columns, `old_<value>` (what the store held in that cell, null if nothing) and `arrivals`
    (rows of the batch for that key; 0 for rows that only the store has). An aggregate that is null counts as kept, as
    there is nothing to judge.
    """

    aggregate: Column
    low: float | None = None
    high: float | None = None

    def holds(self, found) -> bool:
        return found is None or ((self.low is None or found >= self.low) and (self.high is None or found <= self.high))


def none_of(condition: Column) -> Check:
    """No row may fulfil the condition."""
    return Check(F.count_if(F.coalesce(condition, F.lit(False))), high=0)


def continuous(value: str) -> Check:
    """A cumulative figure may not fall below what the store held in the cell."""
    return none_of(F.col(value) < F.col(f"old_{value}"))


def single_rows() -> Check:
    """A batch may bring a key once only."""
    return none_of(F.col("arrivals") > 1)


def reconciled(part: Column, total: Column, low: float, high: float) -> Check:
    """The arriving parts must sum to the arriving totals, within bounds of their ratio."""
    new = F.col("arrivals") > 0
    return Check(F.try_divide(F.sum(F.when(new, part)).cast("double"), F.sum(F.when(new, total)).cast("double")), low, high)


class Refused(ValueError):
    """A batch broke a check; `metrics` has all figures, `broken` the names of the checks."""

    def __init__(self, batch: str, metrics: Mapping[str, float], broken: Sequence[str]):
        super().__init__(f"batch {batch} refused: " + ", ".join(f"{name} = {metrics[name]}" for name in broken))
        self.metrics, self.broken = dict(metrics), list(broken)


@dataclass(frozen=True)
class Merged:
    """What a batch did: the version readers see now, the partitions rewritten, and the figures of the checks."""

    version: int
    parts: tuple[str, ...] = ()
    metrics: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class Panel:
    """A store of one row per key; `part` says from key columns alone in which partition a row lies, and is never null."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    values: tuple[str, ...]
    part: Column
    max_parts: int = 20_000

    # -- reading --------------------------------------------------------------------------------------

    def _manifests(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _state(self, spark: SparkSession, version: int | None = None) -> tuple[int, dict[str, int]]:
        """(version, partition -> version that wrote it) of the newest manifest, or of an older version."""
        found = self._manifests(spark)
        if found is None:
            return 0, {}
        if version is not None:
            found = found.filter(F.col("version") <= version)
        last = found.agg(F.max("version")).scalar()
        rows = found.filter(F.col("version") == last).limit(self.max_parts + 1).collect()
        if len(rows) > self.max_parts:
            raise ValueError(f"more than {self.max_parts} partitions: choose wider ones")
        return (rows[0]["version"] if rows else 0), {r["part"]: r["written"] for r in rows if r["part"] is not None}

    def _knows(self, spark: SparkSession, batch: str) -> bool:
        found = self._manifests(spark)
        return found is not None and bool(found.filter(F.col("batch") == batch).limit(1).count())

    def _read(self, spark: SparkSession, written: Mapping[str, int]) -> DataFrame:
        folders = [f"{self.path}/data/version={v}/part={p}" for p, v in sorted(written.items())]
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The panel as published last, or at an older version; of `parts` only, where given."""
        written = self._state(spark, version)[1]
        return self._read(spark, written if parts is None else {p: v for p, v in written.items() if p in set(parts)})

    def history(self, spark: SparkSession) -> DataFrame:
        """(version, part, written): which version each published version reads a partition from."""
        found = self._manifests(spark)
        empty = spark.createDataFrame([], MANIFEST)
        return (empty if found is None else found).filter("part IS NOT NULL").select("version", "part", "written")

    # -- writing --------------------------------------------------------------------------------------

    def merged(self, old: DataFrame, batch: DataFrame) -> DataFrame:
        """One row per key: the batch's value where it has one, else the stored one, and the columns checks may use.

        Rows of a batch that share a key have one priority, so that the least value of each column is taken.
        """
        both = old.withColumn("_prio", F.lit(1)).unionByName(batch.withColumn("_prio", F.lit(0)))
        cells = both.select(*self.keys, "_prio", *self.values, *[F.when(F.col("_prio") == 1, F.col(v)).alias(f"old_{v}") for v in self.values],
                            F.when(F.col("_prio") == 0, 1).otherwise(0).alias("arrivals"))
        return priority_merge(cells, self.keys, self.values, "_prio", levels=(0, 1), also={
            **{f"old_{v}": F.min(f"old_{v}") for v in self.values}, "arrivals": F.sum("arrivals")})

    def merge(self, batch: DataFrame, name: str, checks: Mapping[str, Check] | None = None, parts: Sequence[str] | None = None) -> Merged:
        """Merge a batch into the partitions it touches, audit what is written, and publish it, or raise Refused.

        The batch is read for the merge, in which the checks are observed, and before that for the partitions it touches,
        unless the caller knows them (`parts`, as from the names of its files). Rows outside stated parts are an error.
        """
        spark = batch.sparkSession
        version, written = self._state(spark)
        if self._knows(spark, name):
            return Merged(version)
        rows = batch.select(*self.schema.names)
        part = self.part.cast("string")
        if parts is None:
            touched = [r[0] for r in rows.select(part).distinct().limit(self.max_parts + 1).collect()]
        else:
            touched = sorted(set(parts))
            message = F.concat(F.lit("a row of another partition than stated: "), F.coalesce(part, F.lit("null")))
            rows = rows.filter(F.when(F.coalesce(part.isin(touched), F.lit(False)), True).otherwise(F.raise_error(message).cast("boolean")))
        if len(touched) > self.max_parts or not all(p and PLAIN.fullmatch(p) for p in touched):
            raise ValueError(f"partitions must have plain names and be {self.max_parts} at most")
        new = version + 1
        checks, watch = dict(checks or {}), Observation()
        full = self.merged(self._read(spark, {p: written[p] for p in touched if p in written}), rows)
        if checks:
            full = full.observe(watch, *[c.aggregate.alias(n) for n, c in checks.items()])
        if touched:
            full.select(*self.schema.names, self.part.cast("string").alias("part")).write.mode("overwrite").option(
                "partitionOverwriteMode", "static").partitionBy("part").parquet(
                f"{self.path}/data/version={new}")
            metrics = watch.get if checks else {}
            broken = [n for n, c in checks.items() if not c.holds(metrics[n])]
            if broken:
                raise Refused(name, metrics, broken)
        else:
            metrics = {}
        self._publish(spark, new, {**written, **dict.fromkeys(touched, new)}, name)
        return Merged(new, tuple(sorted(touched)), metrics)

    def _publish(self, spark: SparkSession, version: int, written: Mapping[str, int], batch: str) -> None:
        """One file, written last: with it the version exists."""
        rows = [(p, v, batch, version) for p, v in sorted(written.items())] or [(None, None, batch, version)]  # a store may be empty
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
