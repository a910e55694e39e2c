"""Rendezvous hashing of stable keys over weighted shards, and gapless slots within each shard.

Every shard draws a number from (key, shard) and the shard's weight; the key goes to the highest draw. A key's shard
therefore depends on the key and the shards alone, and one more shard takes rows only into itself.

Defined cases: a null key is a key like any other; rows that repeat a key share its shard; a null text has size 8 and
the checksum of an empty text; an empty table gives an empty table; other columns are ignored by `slots` and passed on
by `assign`, whose result columns must not exist already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.llm.common import col, pick
from epitide.sources.stage import settle

PIECES = 1024  # pieces into which the numbering of one shard is cut


def draw(key: Column, shard: int, weight: float, seed: int = 0) -> Column:
    """The draw of one shard for a key: -weight / ln(u) with u from 52 hash bits, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 12)
    return F.lit(-float(weight)) / F.ln((bits.cast("double") + 0.5) / F.lit(float(1 << 52)))


def winner(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Number of the shard with the highest draw; ties go to the higher number."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    draws = [F.struct(draw(key, i, w, seed).alias("d"), F.lit(i).alias("i")) for i, w in enumerate(weights) if w > 0]
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["i"]


def assign(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard", seed: int = 0) -> DataFrame:
    """All rows and columns, and the shard of each; no shuffle."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    return df.withColumn(out, winner(col(key), weights, seed))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, seed: int = 0, out: str = "shard") -> None:
    """Parquet files under one folder per shard, written where the rows are: no shuffle, no task that holds a shard."""
    assign(df, key, weights, out, seed).write.partitionBy(out).parquet(path)


def slots(df: DataFrame, key: str, text: str, weights: Sequence[float], added: float = 1.0, seed: int = 0) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    Equal (key, size, checksum) rows are counted first, so that one key with a third of all rows sends one row per task.
    Slots run by (piece, key, checksum, size) within a shard; a piece is a hash of these, so no task numbers a whole shard.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    grown = [*weights, added]
    rows = pick(df, key=key, text=text).select(
        "key", (F.octet_length(body) + 8).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    alike = rows.groupBy("key", "size", "text_crc32").agg(F.count("*").alias("n")).withColumns({
        "shard": winner(F.col("key"), weights, seed), "grown_shard": winner(F.col("key"), grown, seed),
        "piece": F.pmod(F.xxhash64("key", "size", "text_crc32", F.lit(seed)), F.lit(PIECES)).cast("int")})
    alike = settle(alike, "alike")
    totals = alike.groupBy("shard", "piece").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "piece").orderBy("key", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = alike.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["shard", "piece"])
    return numbered.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy")).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("first") + F.col("copy")).alias("slot"), "grown_shard")
