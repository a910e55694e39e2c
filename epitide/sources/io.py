"""Reading and writing: CSV, JSON and parquet, ranked file sets, snapshots, sheets and incremental loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitide.functions.scalar import strip_prefixes
from epitide.functions.text import file_date
from epitide.model import nan_to_null
from epitide.operators.merge import priority_merge
from epitide.sources.stage import work_folder  # noqa: F401


# ---- tables ---------------------------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, return_empty: bool = False) -> DataFrame:
    """A CSV export with an explicit schema; a missing one (or return_empty) gives no rows."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not return_empty:
        try:
            return nan_to_null(spark.read.schema(wanted).option("header", True).csv(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], wanted)


def export(df: DataFrame, name: str, folder: str, csv_only: bool = False) -> None:
    """`<name>.csv` with ISO dates and, unless csv_only, JSON records in `<name>`."""
    if not csv_only:
        df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}")
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(f"{folder}/{name}.csv")


def write_panel(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Main store: parquet by partition, replacing only the partitions present in `df`."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def read_records(spark: SparkSession, path: str, schema: str, rename: Mapping[str, str], keep: Sequence[str],
                 multiline: bool = False) -> DataFrame:
    """JSON records with their fields renamed and only some kept."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path).withColumnsRenamed(dict(rename)).select(*keep)


# ---- nested payloads --------------------------------------------------------------------------------

def flatten_features(df: DataFrame, payload: str, attributes: str, keys: Sequence[str] = ()) -> DataFrame:
    """features[].attributes of a JSON text: one row per feature."""
    parsed = F.from_json(payload, f"features array<struct<attributes: struct<{attributes}>>>")
    return df.select(*keys, F.explode(parsed["features"]["attributes"]).alias("_a")).select(*keys, "_a.*")


def flatten_ages(df: DataFrame, payload: str, keys: Sequence[str], prefix: str = "lsAge", out: str = "value") -> DataFrame:
    """Fields '<prefix>0', '<prefix>1', ... of a JSON text: one row per age."""
    fields = df.select(*keys, F.explode(F.from_json(payload, "map<string, double>")).alias("_k", out))
    age = F.regexp_extract("_k", f"^{prefix}(\\d+)$", 1)
    return fields.filter(age != "").select(*keys, age.cast("int").alias("age"), out)


def open_payload(df: DataFrame, payload: str, keys: Sequence[str], known: Mapping[str, str], rest: str = "rest") -> DataFrame:
    """(keys, <known fields, typed>, rest): a JSON text as a VARIANT column beside the fields the schema knows.

    Nothing is lost to a schema: `rest` holds the whole payload, null where the text is no JSON, and can be stored as it is.
    A field that is absent, or does not fit its type, is null.
    """
    parsed = df.select(*keys, F.try_parse_json(payload).alias(rest))
    typed = [F.try_variant_get(rest, f"$.{name}", kind).alias(name) for name, kind in known.items()]
    return parsed.select(*keys, *typed, rest)


def other_metrics(df: DataFrame, keys: Sequence[str], known: Sequence[str], rest: str = "rest") -> DataFrame:
    """(keys, metric, value): every number at the top of a payload that is not among the known fields."""
    cells = df.select(*keys, rest).lateralJoin(df.sparkSession.tvf.variant_explode(F.col(rest).outer()))
    number = F.try_variant_get("value", "$", "double")
    return cells.select(*keys, F.col("key").alias("metric"), number.alias("value")).filter(
        F.col("metric").isNotNull() & ~F.col("metric").isin(*known) & F.col("value").isNotNull())


# ---- file sets ----------------------------------------------------------------------------------------

def read_dated_files(spark: SparkSession, path: str, schema: str, form: str = "parquet") -> DataFrame:
    """All files of a set in one scan, with the date in each file's name as `file_date`.

    Where a file is one part of a folder that has a date in its name, as Spark writes them, that date holds.
    """
    place = F.col("_metadata.file_path")
    folder = F.concat(F.element_at(F.split(place, "/"), -2), F.lit(".x"))
    return spark.read.schema(schema).format(form).load(path).withColumn("file_date", F.coalesce(file_date(folder), file_date(place)))


def fold_newest_first(df: DataFrame, keys: Sequence[str], values: Sequence[str], repair: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Per cell the first non-null value going from the newest file to the oldest."""
    repaired = repair(df) if repair else df
    return priority_merge(repaired, keys, values, -F.unix_date("file_date"))


def mend_shifted(df: DataFrame, bad: Column, actual: Sequence[str]) -> DataFrame:
    """Rows of a snapshot whose columns came in another order, put right.

    `actual` says what the columns, in their present order, really hold on such rows.
    """
    source = dict(zip(actual, df.columns))
    return df.select(*[
        F.when(F.coalesce(bad, F.lit(False)), F.col(source[c])).otherwise(F.col(c)).alias(c) if c in source else F.col(c)
        for c in df.columns])


def union_snapshots(*weeks: DataFrame) -> DataFrame:
    out = weeks[0]
    for w in weeks[1:]:
        out = out.unionByName(w, allowMissingColumns=True)
    return out


# ---- incremental loads -----------------------------------------------------------------------------------

def replace_tail(cached: DataFrame, fresh: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Cached rows before the last key held, fresh rows from it on (the last key may have changed).

    A key of several columns is compared column by column. An empty cache takes all fresh rows. Rows with
    a missing key have no place in the order: the fresh ones replace the cached ones.
    """
    names = [key] if isinstance(key, str) else list(key)
    whole = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    place = F.struct(*names)
    boundary = cached.filter(whole).agg(F.max(place)).scalar()
    kept = cached.filter(whole & (place < boundary))
    return kept.unionByName(fresh.filter(~whole | boundary.isNull() | (place >= boundary)))


def load_is_complete(df: DataFrame, total: int) -> bool:
    return df.count() == total


def yearly_for_location(files: DataFrame, column: str, location: str, drop: Sequence[str] = ()) -> DataFrame:
    """One location out of a set of yearly files, overlapping rows once; the filter reaches the scan."""
    return files.filter(F.col(column) == location).drop(column, *drop).distinct()


def stamp_snapshot(rows: DataFrame, entity: str, values: Sequence[str], day: str, history: DataFrame | None = None) -> DataFrame:
    """Totals per entity stamped with the load date and appended to the history without repeats."""
    now = rows.groupBy(entity).agg(*[F.sum(v).alias(v) for v in values]).select(F.lit(day).cast("date").alias("date"), entity, *values)
    return now if history is None else history.unionByName(now).distinct()


# ---- sheets ---------------------------------------------------------------------------------------------

def tidy_sheet(sheet: DataFrame, row: str, label: str, headers: Mapping[int, str], drop_labels: Sequence[str] = ()) -> DataFrame:
    """Long form (label, <header names>, value) of a sheet with several header rows.

    A header written once above several columns holds for all of them. Header cells are few (one per
    sheet column), so they are filled forward in one small window and joined to the data cells.
    """
    columns = [c for c in sheet.columns if c not in (row, label)]
    cells = sheet.unpivot([row, label], columns, "_column", "value")
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("_column"))
    heads = cells.filter(F.col(row).isin(*headers)).withColumn("_o", order)
    filled = heads.withColumn("value", F.last("value", ignorenulls=True).over(
        Window.partitionBy(row).orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)))
    titles = filled.groupBy("_column").agg(*[
        F.max(F.when(F.col(row) == r, F.col("value"))).alias(name) for r, name in headers.items()])
    data = cells.filter(~F.col(row).isin(*headers) & ~F.col(label).isin(*drop_labels) & F.col("value").isNotNull())
    return data.join(titles, "_column").select(label, *headers.values(), F.regexp_replace("value", ",", "").try_cast("double").alias("value"))


def tested_metrics(tidy: DataFrame, label: str, date: str, test: str, outcome: str, tests: Sequence[str], positive: str = "detected") -> DataFrame:
    """(label, date) x '<test> Tests' / '<test> Pos' from a tidied sheet."""
    metric = F.concat(strip_prefixes(F.col(test)), F.lit(" "), F.when(F.col(outcome) == positive, "Pos").otherwise("Tests"))
    wanted = [f"{t} {k}" for t in tests for k in ("Tests", "Pos")]
    return tidy.withColumn("_m", metric).groupBy(label, date).pivot("_m", wanted).agg(F.sum("value"))
