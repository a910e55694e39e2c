"""A panel in buckets of its keys: repairs of series and merges of batches start from its partitioning, without a shuffle.

Rows of a key lie in one bucket of the table, whose number of buckets the catalog knows. So a window over the key, or an
aggregation of it together with a batch, takes the table as it is; only the batch moves. What a merge gives has the same partitioning again and
is written as the next table, one file per bucket. Choose the number of buckets for the size the panel will have: a
bucket is one task's work.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from epitide.operators.merge import priority_merge, stack_sources
from epitide.sources.stage import work_folder


def write_buckets(df: DataFrame, keys: Sequence[str], date: str, buckets: int, name: str = "panel") -> str:
    """Name of a new table with the rows of `df` in `buckets` buckets of the keys, on shared storage.

    Rows that are already dealt so are written where they are; others are shuffled once. No row is lost to a null key.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys, date).option("path", work_folder(spark, name)).saveAsTable(table)
    return table


def merge_batch(store: DataFrame, batch: DataFrame, keys: Sequence[str], date: str, values: Sequence[str], buckets: int) -> DataFrame:
    """The stored rows with the values of the batch where it has any, and its new rows; `store` is a table of `buckets` buckets.

    The batch is dealt like the store, so that their union keeps the partitioning and each bucket is merged in place. Where
    the batch has several rows of one cell, the least value counts.
    """
    both = stack_sources(batch.select(*keys, date, *values).repartition(buckets, *keys), store.select(*keys, date, *values))
    return priority_merge(both, [*keys, date], values)
