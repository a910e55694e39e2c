"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact similarity of shingles.

A document is cut into all windows that are as long as an item, for every item length; a document that is a little
shorter than an item is one window. Windows and items of one length are joined on blocks of their 64-bit fingerprints:
RADIUS + 1 blocks, one of which is equal in any two fingerprints within RADIUS bits. At the similarity asked for, a
ninth of the shingles differ and 10 bits on average, 20 in hardly any pair, so that the radius is wide and the blocks
are short; the window's length, part of the key, does most of the selection. Pairs within the radius are verified by
the similarity of their five-word shingles, each weighted by how often it occurs: sum of the lesser over sum of the
greater weights, at least SIMILARITY.

Only windows that could pass are fingerprinted: a window of m shingles needs at least s/(1+s) (m+n) of them in common
with an item of n, so that many of its shingles must occur in the benchmark at all. This drops no pair that passes. The
benchmark's shingles reach the workers in chunks of at most CHUNK hashes (a broadcast of proven size); a larger
benchmark is worked off in several passes over the documents.

Defined cases: null, empty and wordless texts and items match nothing; items and documents of fewer than five words are
one shingle; a null id is kept as null; rows that repeat a document are judged alike; empty tables give empty tables;
`matches` ignores other columns and `keep_clean` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.llm.common import batches_of, col, pick
from epitide.llm.shingles import shingles, simhash, words
from epitide.sources.stage import settle

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
CHUNK = 4_000_000  # benchmark shingles that are broadcast at once: 32 MB


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64).view(np.int64)


def items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """(item, n_words, size, fp, shingles) of every item that has a word."""
    rows = pick(benchmark, item=id, text=text)
    kind = rows.schema["item"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            tokens = [words(t) for t in batch.column("text").to_pylist()]
            found = [shingles(t, WORDS_PER_SHINGLE) for t in tokens]
            fps = np.array([simhash(s[None, :])[0] if len(s) else 0 for s in found], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([len(t) for t in tokens], pa.int32()), pa.array([len(s) for s in found], pa.int32()),
                 pa.array(_signed(fps)), pa.array([_signed(s) for s in found], pa.list_(pa.int64()))], ["item", "n_words", "size", "fp", "shingles"])

    return rows.mapInArrow(made, f"item {kind}, n_words int, size int, fp bigint, shingles array<bigint>").filter("size > 0")


def _needed(m: int, n: int, similarity: float) -> int:
    return int(np.ceil(similarity / (1 + similarity) * (m + n) - 1e-9))


def _windows(batches: Iterator[pa.RecordBatch], shared, similarity: float) -> Iterator[pa.RecordBatch]:
    known, sizes = shared.value
    names = ["id", "h", "at", "size", "fp", "shingles"]
    for batch in batches_of(batches):
        for id_, h, text in zip(batch.column("id"), batch.column("h"), batch.column("text")):
            own = shingles(words(text.as_py()), WORDS_PER_SHINGLE)
            if not len(own):
                continue
            near = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hits = np.concatenate([[0], np.cumsum(known[near] == own)])
            if not hits[-1]:
                continue
            for size in sizes:
                m = min(size, len(own))
                need = _needed(m, size, similarity)
                if need > m or hits[-1] < need:
                    continue
                starts = np.flatnonzero(hits[m:] - hits[:-m] >= need)
                for k in range(0, len(starts), 4096):
                    part = starts[k:k + 4096]
                    rows = own[part[:, None] + np.arange(m)]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([id_.as_py()] * n, id_.type), pa.array([h.as_py()] * n, pa.int64()), pa.array(part.astype(np.int32)), pa.array([size] * n, pa.int32()),
                         pa.array(_signed(simhash(rows))), pa.array(list(rows.view(np.int64)), pa.list_(pa.int64()))], names)


def block_masks(radius: int = RADIUS) -> list[int]:
    """The 64 bits in radius + 1 blocks, each as a mask."""
    cuts = [i * 64 // (radius + 1) for i in range(radius + 2)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _blocks(df: DataFrame, radius: int, *keep: str) -> DataFrame:
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius)]
    return df.select(*keep, "size", "fp", F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in signed])).alias("block", "bits")).withColumn(
        "value", F.col("fp").bitwiseAND(F.col("bits"))).drop("bits")


def weighted_similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater counts of two lists of shingles."""
    both, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    left, right = np.bincount(at[:len(x)], minlength=len(both)), np.bincount(at[len(x):], minlength=len(both))
    return float(np.minimum(left, right).sum() / np.maximum(left, right).sum())


def _similarities(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_similarity(np.asarray(x), np.asarray(y)) for x, y in zip(a, b)], dtype=float)


def _pass(documents: DataFrame, bench: DataFrame, similarity: float, radius: int) -> DataFrame:
    """(id, h, item, at, n_words, similarity) of all windows that pass, for one chunk of the benchmark."""
    spark = documents.sparkSession
    kind = documents.schema["id"].dataType.simpleString()
    known = bench.select(F.explode("shingles").alias("s")).distinct().toArrow().column("s").to_numpy()
    if not len(known):
        item = bench.schema["item"].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, h bigint, item {item}, at int, n_words int, similarity double")
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect())
    shared = spark.sparkContext.broadcast((np.sort(known.view(np.uint64)), sizes))
    windows = settle(documents.mapInArrow(
        lambda b: _windows(b, shared, similarity), f"id {kind}, h bigint, at int, size int, fp bigint, shingles array<bigint>"), "windows")
    left = _blocks(windows, radius, "id", "h", "at", "shingles")
    right = _blocks(bench, radius, "item", "n_words", "shingles").withColumnsRenamed({"fp": "item_fp", "shingles": "item_shingles"})
    equal = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.array_min(F.filter(F.transform(F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in block_masks(radius)]), lambda m, i: F.when(
        equal.bitwiseAND(m) == 0, i)), lambda i: i.isNotNull()))
    # Of the blocks in which a pair is equal only the first brings it.
    pairs = left.join(right, ["size", "block", "value"]).filter((F.bit_count(equal) <= radius) & (first == F.col("block")))
    verified = F.pandas_udf(_similarities, "double")
    return pairs.withColumn("similarity", verified("shingles", "item_shingles")).filter(F.col("similarity") >= similarity).select(
        "id", "h", "item", "at", "n_words", "similarity")


def _found(documents: DataFrame, benchmark: DataFrame, id: str, text: str, item: str, item_text: str, similarity: float, radius: int) -> DataFrame:
    bench = settle(items(benchmark, item, item_text), "items")
    total = bench.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    chunks = max(1, -(-total // CHUNK))
    rows = pick(documents, id=id, h=F.xxhash64(col(text)), text=text)
    parts = [bench if chunks == 1 else bench.filter(F.pmod(F.xxhash64("item", "fp"), F.lit(chunks)) == i) for i in range(chunks)]
    best = reduce(DataFrame.union, [_pass(rows, p, similarity, radius) for p in parts])
    return best.groupBy("id", "h", "item").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "at", "n_words")).alias("b")).select(
        "id", "h", "item", F.col("b.at").alias("start"), F.col("b.n_words").alias("n_words"), (-F.col("b.s")).alias("similarity"))


def matches(documents: DataFrame, benchmark: DataFrame, id: str, text: str, item: str, item_text: str, similarity: float = SIMILARITY,
            radius: int = RADIUS) -> DataFrame:
    """(id, item, start, n_words, similarity): the best window of each document for each item in it; start counts words."""
    return _found(documents, benchmark, id, text, item, item_text, similarity, radius).drop("h")


def keep_clean(documents: DataFrame, benchmark: DataFrame, id: str, text: str, item: str, item_text: str, similarity: float = SIMILARITY,
               radius: int = RADIUS) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    hits = _found(documents, benchmark, id, text, item, item_text, similarity, radius).select(
        F.coalesce("id", "h").alias("_epitide_k"), F.col("h").alias("_epitide_h")).distinct()
    h: Column = F.xxhash64(col(text))
    rows = documents.withColumns({"_epitide_h": h, "_epitide_k": F.coalesce(col(id), h)})
    return rows.join(hits, ["_epitide_k", "_epitide_h"], "left_anti").select(*[col(c) for c in documents.columns])
