"""Near-duplicates by SimHash: fingerprints of whole texts, linked within a Hamming radius by deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. Two fingerprints within four bits have a segment that differs in at
most one bit, so that they agree on one of the segment's variants with one bit wiped out; where it differs in exactly
one, so does a second segment, or the first did not differ at all. Of the other bits, which share the rest of the
difference, one of a few pieces agrees too. Every signature is therefore a mask of bits that are kept, about thirty, and
`masks` lists them; equality of the masked values is joined, and the whole fingerprints are verified.

Links are not listed by pairs. Distinct fingerprints that share a signature are first linked to the least of them, where
verified; only signatures whose members are then in different components are compared pair by pair, and of these only
pairs across components. Dense groups so cost rows in proportion to their size, and no link between components is lost.
The members of a signature are distinct fingerprints, so that copies, however many, are one row there.

Defined cases: a null, empty or wordless text has fingerprint zero, which is linked like any other; fewer words than a
shingle has are one shingle; repeated shingles count as often as they occur; a null id is kept in its place and never
names a component with an id; rows that repeat an id share the smallest id of what any of them reaches by its own
text; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitide.llm.common import batches_of, col, pick
from epitide.llm.graph import components
from epitide.sources.stage import settle

RADIUS = 4
SEED = 42
SPAN = 1 << 15  # shingles whose bits are counted at once


# ---- fingerprints ---------------------------------------------------------------------------------

def fingerprint(text: bytes, words: int = 4) -> int:
    """Bits set in more than half of the XXH64 values of all shingles of `words` words, A-Z lower-cased."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    spans = zip(starts[:n].tolist(), (ends[words - 1:] if len(tokens) > words else ends[-1:]).tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SPAN):
        octets = hashes[at:at + SPAN].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        found = np.array([fingerprint(t or b"", words) for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), pa.array(found.view(np.int64))], ["id", "h", "fp"])


def fingerprints(df: DataFrame, id: str, text: str, words: int = 4) -> DataFrame:
    """(id, h, fp) of every row; fp is the fingerprint as a signed 64-bit integer, h a plain hash of the text."""
    rows = pick(df, id=id, h=F.xxhash64(col(text)), text=col(text).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _fingerprints(b, words), f"id {kind}, h bigint, fp bigint")


# ---- signatures -----------------------------------------------------------------------------------

def _run(start: int, size: int) -> int:
    return ((1 << size) - 1) << start


def _pieces(bits: list[int], n: int) -> list[int]:
    """The bits in n runs of nearly equal length, each as a mask."""
    cuts = [i * len(bits) // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def masks() -> list[int]:
    """Masks of which any two fingerprints within four bits agree on at least one.

    Three segments share four differences. Either one segment has none: it is kept whole, with one of five pieces of
    the other bits (five pieces, four differences). Or none is free of them: then two segments have exactly one each, so
    one of the first two has; its other bits are kept, with one of four pieces of the rest (three differences).
    """
    segments = [(0, 22), (22, 21), (43, 21)]
    found = []
    for i, (start, size) in enumerate(segments):
        own = _run(start, size)
        rest = [b for b in range(64) if not own >> b & 1]
        found += [own | p for p in _pieces(rest, 5)]
        if i < 2:
            found += [own & ~(1 << b) | p for b in range(start, start + size) for p in _pieces(rest, 4)]
    return found


def _linked(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links to hubs (a, b), their components (node, root), and the links across components (a, b, ra, rb)."""
    if radius > RADIUS:
        raise ValueError("the masks are made for four bits")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks()]
    variants = fps.select("fp", F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in signed])).alias("mask", "kept")).select(
        "fp", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("kept"))).alias("sign"))
    alike = Window.partitionBy("sign")
    shared = settle(variants.select("fp", "sign", F.min("fp").over(alike).alias("hub"), F.max("fp").over(alike).alias("far")).filter(
        "hub <> far").select("fp", "sign", "hub"), "signatures")

    def near(a, b):
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius

    hubs = settle(shared.filter((F.col("fp") != F.col("hub")) & near("fp", "hub")).select(
        F.col("fp").alias("a"), F.col("hub").alias("b")).distinct(), "hubs")
    joined = components(hubs, "a", "b")
    placed = shared.select("sign", "fp").join(joined, F.col("fp") == F.col("node"), "left").select(
        "sign", "fp", F.coalesce("root", "fp").alias("root"))
    mixed = placed.groupBy("sign").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("sign")
    rest = settle(placed.join(mixed, "sign", "left_semi"), "mixed")
    left, right = [rest.select("sign", F.col("fp").alias(n), F.col("root").alias("r" + n)) for n in "ab"]
    across = left.join(right, (left["sign"] == right["sign"]) & (F.col("ra") < F.col("rb")) & near("a", "b"))
    return hubs, joined, across.select("a", "b", "ra", "rb")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints of `fps` (distinct values in a column fp) that verified
    links within the radius connect."""
    hubs, _, across = _linked(fps, radius)
    return hubs.union(across.select("a", "b").distinct())


def rooted(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`distinct` (distinct values in a column fp) and the root, the least fingerprint that links reach.

    The components of the hubs are found once; only their roots meet again, over the links across.
    """
    _, joined, across = _linked(distinct.select("fp"), radius)
    merged = components(across, "ra", "rb").select(F.col("node").alias("near"), F.col("root").alias("far"))
    placed = distinct.join(joined, F.col("fp") == F.col("node"), "left").withColumn("near", F.coalesce("root", "fp")).drop("node", "root")
    return placed.join(merged, "near", "left").withColumn("root", F.coalesce("far", "near")).select(*distinct.columns, "root")


def groups(df: DataFrame, id: str, text: str, words: int = 4, radius: int = RADIUS) -> DataFrame:
    """(id, h, fp, root, component_id), one row per input row; component_id is the smallest id reached over links."""
    found = settle(fingerprints(df, id, text, words), "fingerprints")
    distinct = settle(found.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    placed = rooted(distinct, radius)
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return found.join(placed.join(firsts, "root").select("fp", "root", "component_id"), "fp").select("id", "h", "fp", "root", "component_id")


def keep_one(df: DataFrame, id: str, text: str, words: int = 4, radius: int = RADIUS) -> DataFrame:
    """One document of each group, with all its columns: the smallest id, ids before nulls; rows that repeat it go too."""
    best = groups(df, id, text, words, radius).groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("k"))
    kept = best.select(F.coalesce("k.id", "k.h").alias("_epitide_k"), F.col("k.h").alias("_epitide_h"))
    rows = df.withColumns({"_epitide_h": F.xxhash64(col(text)), "_epitide_k": F.coalesce(col(id), F.xxhash64(col(text)))})
    keys = ["_epitide_k", "_epitide_h"]
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).select(*[col(c) for c in df.columns])
