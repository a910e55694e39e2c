"""Expressions and helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def pick(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under names of our own, so that no other column of `df` can clash."""
    return df.select(*[(col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def word_count(text: str | Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(col(text) if isinstance(text, str) else text, F.lit(WORD)).cast("bigint"), F.lit(0))


def seeded_unit(seed: int, *keys: Column) -> Column:
    """A repeatable number in [0, 1) from the keys, with 52 random bits; any engine that has MD5 can say it."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def batches_of(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 8 << 20, by: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded rows and bounded bytes of the column `by`, however long single texts are."""
    for batch in batches:
        lengths = batch.column(by).nbytes if batch.num_rows else 0
        step = max(1, min(rows, int(rows if not lengths else size * batch.num_rows / max(lengths, 1))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


@contextmanager
def conf(spark: SparkSession, name: str, value: str):
    """A setting for the jobs of this block; as it was afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Hand whole texts to Python a few at a time while the jobs of this block run, so that a worker holds little of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
