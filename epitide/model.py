"""Schemas, null rules and small helpers shared by every operator.

The canonical shape is the long observation table: one row per (entity, date, metric).
Operators take the key, date and value column names as parameters, so any panel works.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBS = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("prio", T.IntegerType()),
])

# Rule tables, dictionaries and band lists are part of the program, not of the data. Short ones become
# expressions of the plan; a longer one becomes a local relation with the same rows.
MAX_INLINE_ROWS = 2_000


def cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def inline_table(spark: SparkSession, schema: str, rows: Iterable[Sequence]) -> DataFrame:
    """A literal table; a short one as part of the plan (no Python worker, size known to the optimizer)."""
    rows = list(rows)
    fields = T.StructType.fromDDL(schema).fields
    if not rows or len(rows) > MAX_INLINE_ROWS:
        return spark.createDataFrame([tuple(row) for row in rows], T.StructType(fields))
    structs = [
        F.struct(*[
            (F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v))
            .cast(f.dataType).alias(f.name)
            for v, f in zip(row, fields)
        ])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN is a value to Spark but a missing cell to the data: map it to NULL at ingest."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    wanted = floats if columns is None else [c for c in columns if c in floats]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in wanted})


def day_number(date: str | Column) -> Column:
    """Days since 1970-01-01, so that calendar frames can use rangeBetween on an integer."""
    return F.unix_date(F.col(date) if isinstance(date, str) else date)


def melt(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metric columns to the long (keys, metric, value) shape."""
    return df.unpivot(list(keys), [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
