"""Incremental loading with Structured Streaming: new files in, an up-to-date panel out.

`load_new_files` keeps every batch in a folder of its own; `merge_new_files` merges each batch into a stored panel
(`sources/panel.py`), rewriting only the partitions it touches. In both a batch that is run again after a failure
changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitide.operators.merge import priority_merge
from epitide.sources.panel import Check, Panel


def _reader(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source)


def load_new_files(spark: SparkSession, source: str, schema: T.StructType, store: str, checkpoint: str,
                   files_per_batch: int | None = None, identity: Sequence[str] = (), event_time: str | None = None, delay: str = "0 days") -> None:
    """Append every file not seen before to the store and stop (checkpoint and store on shared storage).

    With `identity`, rows that arrive again are left out, as in `arrivals_once`.
    """
    rows = _reader(spark, source, schema, files_per_batch)
    if identity:
        rows = arrivals_once(rows, identity, event_time, delay)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")

    run = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()
    run.awaitTermination()


def current_panel(spark: SparkSession, store: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Latest non-null value per cell over all batches."""
    return priority_merge(spark.read.parquet(store), keys, values, -F.col("batch"))


def arrivals_once(rows: DataFrame, identity: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """A stream without repeats: of rows that agree in `identity` the first to arrive stays.

    Identities are remembered until the watermark (the latest event time less `delay`) has passed them by `delay`, so the
    state is bounded by what arrives in that span. A repeat that comes later than that is a new row, which a merge by key
    puts into the cell it already has. Rows later than the watermark are dropped by Spark, so `delay` must cover the
    latest correction that is to count.
    """
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(identity))


def merge_new_files(spark: SparkSession, source: str, panel: Panel, checkpoint: str, checks: Mapping[str, Check] | None = None,
                    files_per_batch: int | None = None, schema: T.StructType | None = None, identity: Sequence[str] = (),
                    event_time: str | None = None, delay: str = "0 days", name: str = "batch") -> list:
    """Merge every file not seen before into the panel, a batch at a time, and stop; returns what each batch did.

    With `identity`, rows that arrive again within `delay` of event time are dropped before they are merged. A refused
    batch raises and stops the query; when it is started again the batch comes again, under the same name.
    """
    rows = _reader(spark, source, schema or panel.schema, files_per_batch)
    if identity:
        rows = arrivals_once(rows, identity, event_time, delay)
    done = []

    def merge(batch: DataFrame, number: int) -> None:
        # A merge reads its batch twice; what a stateful step lets through is not worked out twice.
        kept = batch.persist() if identity else batch
        try:
            done.append(panel.merge(kept.select(*panel.schema.names), f"{name}-{number}", checks))
        finally:
            if identity:
                kept.unpersist()

    run = (rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(merge).start())
    run.awaitTermination()
    return done
