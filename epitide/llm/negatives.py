"""Hard negatives by rotated one-bit codes: popcount estimates, a certain interval for every score, integer scores at the end.

A vector of integers is coded in STAGES. Each stage turns what is left of the vector by its own fixed random rotation,
keeps one bit per dimension (the signs), and stores the alignment: the inner product of the remainder and the unit code
vector. What is not explained goes to the next stage, and the length of the last remainder is stored. An anchor is turned
by the same rotations and quantised to PLANES bit planes, so that its inner product with a code vector is a sum of
popcounts. The score is then estimate +- (length of the last remainder x length of the anchor, by Cauchy and Schwarz,
and the anchor's own quantisation error times the alignments): an interval that always holds the score.

Anchors and rows meet in blocks; no task holds more than one block of each. Within a pair of blocks the lower ends of the
intervals give a threshold that the best rows surely pass, rows whose interval cannot reach it (or cannot touch the band)
are dropped after the first stage or after the last, and the rest get their integer inner product. A block returns its best
rows only; the best of all blocks are taken by a window over them.

Positives are searched first, among rows of the anchor's label; then, for each positive, the best rows of other labels
whose score lies between LOW and HIGH per cent of the positive's.

Defined cases: a null label, a null vector or one with a null or non-finite component takes no part; vectors meet those of
their own length only, and empty ones score 0; a null id is never an anchor and comes last in ties; rows that repeat an
id are rows of their own, also as each other's positives; a zero or negative positive score follows the stated inequality;
vectors longer than 2^24 after scaling are an error, as their scores would leave exact integers; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from copy import copy
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.llm.common import pick
from epitide.sources.stage import settle

STAGES = 4
PLANES = 6
SCALE = 256
BEST = 5
LOW, HIGH = 80, 100     # per cent of the positive's score
ROWS, ANCHORS = 4096, 512  # rows and anchors of a block
SLACK = 1e-6            # for rounding, as a share of the product of lengths


# ---- codes ------------------------------------------------------------------------------------------

@lru_cache(maxsize=64)
def rotation(d: int, stage: int) -> np.ndarray:
    """A random orthogonal matrix that depends on the dimension and the stage alone."""
    if not d:
        return np.zeros((0, 0))
    q, r = np.linalg.qr(np.random.default_rng((d, stage)).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """0/1 rows as 64-bit words."""
    d = bits.shape[1]
    full = np.zeros((len(bits), -(-d // 64) * 64), np.uint8)
    full[:, :d] = bits
    return np.packbits(full, axis=1).view(np.uint64)


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes: rows x STAGES x words, alignments: rows x STAGES, length of the last remainder)."""
    rest, d = x.astype(np.float64), x.shape[1]
    codes, along = [], []
    for s in range(STAGES):
        turned = rest @ rotation(d, s)
        bits = turned > 0
        unit = np.where(bits, 1.0, -1.0) / math.sqrt(max(d, 1))
        a = (turned * unit).sum(1)
        rest = (turned - a[:, None] * unit) @ rotation(d, s).T
        codes.append(packed(bits))
        along.append(a)
    return np.stack(codes, 1), np.stack(along, 1), np.sqrt((rest * rest).sum(1))


class Asked:
    """A block of anchors, turned and quantised for one stage."""

    def __init__(self, x: np.ndarray, stage: int):
        d = x.shape[1]
        turned = x.astype(np.float64) @ rotation(d, stage)
        self.low = turned.min(1, initial=0.0)
        self.step = np.maximum(turned.max(1, initial=0.0) - self.low, 1e-12) / ((1 << PLANES) - 1)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None])
        self.error = np.sqrt(((self.low[:, None] + level * self.step[:, None] - turned) ** 2).sum(1))
        self.total = self.low * d + self.step * level.sum(1)
        self.planes = [packed((level.astype(np.int64) >> j & 1).astype(np.uint8)) for j in range(PLANES)]
        self.root = math.sqrt(max(d, 1))

    def along(self, codes: np.ndarray) -> np.ndarray:
        """Inner products of the quantised anchors with the unit code vectors: anchors x rows."""
        ones = np.bitwise_count(codes).sum(1).astype(np.float64)
        weighted = np.zeros((len(self.low), len(codes)), np.uint32)
        for j, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                weighted += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.uint32) << np.uint32(j)
        inside = self.low[:, None] * ones + self.step[:, None] * weighted
        return (2 * inside - self.total[:, None]) / self.root


def surviving(x: np.ndarray, codes: np.ndarray, along: np.ndarray, last: np.ndarray, norms: np.ndarray, keep: np.ndarray, reach) -> np.ndarray:
    """Which of `keep` (anchors x rows) have an interval that `reach(lo, hi)` lets pass, stage by stage.

    After stage s the remainder's length is known from the vector's length and the alignments so far, as each stage takes
    an orthogonal part away.
    """
    length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    left2 = norms ** 2
    est, err = np.zeros((len(x), len(codes))), np.zeros((len(x), len(codes)))
    for s in range(along.shape[1]):
        asked = Asked(x, s)
        rows = np.flatnonzero(keep.any(0))
        est[:, rows] += along[rows, s] * asked.along(codes[rows, s])
        err[:, rows] += np.abs(along[rows, s]) * asked.error[:, None]
        left2 = np.maximum(left2 - along[:, s] ** 2, 0)
        rest = np.sqrt(left2) if s + 1 < along.shape[1] else last
        wide = length[:, None] * rest + err + SLACK * (length[:, None] * norms + 1)
        lo, hi = np.where(keep, est - wide, -np.inf), np.where(keep, est + wide, -np.inf)
        keep = keep & reach(lo, hi)
    return keep


def best_surely(lo: np.ndarray, fit: np.ndarray, k: int) -> np.ndarray:
    """Per anchor, a number that k fitting rows are sure to reach (minus infinity if there are fewer)."""
    if lo.shape[1] < k:
        return np.full(len(lo), -np.inf)
    sure = np.where(fit, lo, -np.inf)
    return np.partition(sure, sure.shape[1] - k, axis=1)[:, -k]


def scored(x: np.ndarray, rows: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, integer score) where `chosen`."""
    a, r = np.nonzero(chosen)
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), 1 << 16):
        out[at:at + (1 << 16)] = (x[a[at:at + (1 << 16)]] * rows[r[at:at + (1 << 16)]]).sum(1)
    return a, r, out


def top(a: np.ndarray, r: np.ndarray, s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each anchor, by score downwards and id upwards."""
    order = np.lexsort((ids[r], -s, a))
    starts = np.flatnonzero(np.r_[True, a[order][1:] != a[order][:-1]]) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


# ---- pairs of blocks --------------------------------------------------------------------------------

FOUND = "anchor bigint, positive int, id bigint, uid bigint, score bigint"
NO_ID = (1 << 63) - 1  # stands for a null id, after all others


class Block:
    def __init__(self, pdf: pd.DataFrame):
        asked, rows = pdf[pdf["asked"]], pdf[~pdf["asked"]]
        self.ok = len(asked) > 0 and len(rows) > 0
        if not self.ok:
            return
        d = int(pdf["d"].iloc[0])
        self.x = np.frombuffer(b"".join(asked["ints"]), "<i8").reshape(len(asked), d)
        self.rows = np.frombuffer(b"".join(rows["ints"]), "<i8").reshape(len(rows), d)
        self.codes = np.frombuffer(b"".join(rows["codes"]), "<u8").reshape(len(rows), STAGES, -(-d // 64))
        side = np.frombuffer(b"".join(rows["sides"]), "<f8").reshape(len(rows), STAGES + 2)
        self.along, self.last, self.norms = side[:, :STAGES], side[:, STAGES], side[:, STAGES + 1]
        self.anchor, self.uid = asked["uid"].to_numpy(), rows["uid"].to_numpy()
        self.ids = rows["id"].to_numpy()
        self.same = asked["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]
        self.asked = asked

    def rows_of(self, a, r, s, positive) -> pd.DataFrame:
        return pd.DataFrame({"anchor": self.anchor[a], "positive": positive, "id": self.ids[r], "uid": self.uid[r], "score": s})

    def part(self, anchors: np.ndarray, rows: np.ndarray) -> Block:
        """The same for some of the anchors and rows."""
        out = copy(self)
        out.x, out.anchor, out.same = self.x[anchors], self.anchor[anchors], self.same[np.ix_(anchors, rows)]
        out.rows, out.codes, out.along, out.last, out.norms, out.uid, out.ids = (
            v[rows] for v in (self.rows, self.codes, self.along, self.last, self.norms, self.uid, self.ids))
        return out

    def search(self, fit: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Best fitting rows per anchor with low <= score <= high, for each column of the bounds (anchors x bands).

        Estimates do not depend on the bands, so all bands share them; a pair is scored if any band needs it.
        """
        def reach(lo, hi):
            out = np.zeros(lo.shape, bool)
            for k in range(low.shape[1]):
                a, b = low[:, k, None], high[:, k, None]
                sure = best_surely(lo, (lo >= a) & (hi <= b) & (hi > -np.inf), BEST)
                out |= (hi >= np.maximum(a, sure[:, None])) & (lo <= b)
            return out

        a, r, s = scored(self.x, self.rows, surviving(self.x, self.codes, self.along, self.last, self.norms, fit, reach))
        out = []
        for k in range(low.shape[1]):
            within = np.flatnonzero((s >= low[a, k]) & (s <= high[a, k]))
            within = within[top(a[within], r[within], s[within], self.ids, BEST)]
            out.append((a[within], r[within], s[within]))
        return out


def _empty() -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("anchor", "positive", "id", "uid", "score")})


def positives_of(pdf: pd.DataFrame) -> pd.DataFrame:
    b, out = Block(pdf), [_empty()]
    if b.ok:
        labels, rows = b.asked["label"].to_numpy(), pdf.loc[~pdf["asked"], "label"].to_numpy()
        for label in np.unique(labels):
            own = b.part(labels == label, rows == label)
            every = np.full((len(own.x), 1), np.inf)
            out += [own.rows_of(*found, 0) for found in own.search(own.anchor[:, None] != own.uid[None, :], -every, every)]
    return pd.concat(out)


def negatives_of(pdf: pd.DataFrame) -> pd.DataFrame:
    b, out = Block(pdf), [_empty()]
    if b.ok:
        goals = b.asked["goals"].to_list()
        goal = np.full((len(goals), max(map(len, goals))), -1)  # the band of a negative score is empty
        for i, g in enumerate(goals):
            goal[i, :len(g)] = g
        out += [b.rows_of(*found, k) for k, found in enumerate(b.search(~b.same, -(-LOW * goal // 100), HIGH * goal // 100))]
    return pd.concat(out)


# ---- the operator -----------------------------------------------------------------------------------

def _encode(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(batch.column("d"))
        for d in np.unique(lengths):
            part = batch.filter(pa.array(lengths == d))
            for at in range(0, part.num_rows, 1024):
                rows = part.slice(at, 1024)
                flat = np.asarray(rows.column("vector").flatten(), np.float64)
                x = np.floor(SCALE * flat.reshape(rows.num_rows, int(d)))
                norms = np.sqrt((x * x).sum(1))
                if norms.max() >= 2.0 ** 24:
                    raise ValueError("a vector is too long for exact scores")
                ints = x.astype("<i8")
                codes, along, last = coded(ints)
                sides = np.concatenate([along, last[:, None], norms[:, None]], 1).astype("<f8")
                yield pa.RecordBatch.from_arrays(
                    [rows.column("uid"), rows.column("id"), rows.column("label"), rows.column("anchor"), rows.column("d"),
                     *[pa.array([v.tobytes() for v in m], pa.binary()) for m in (ints, codes, sides)]],
                    ["uid", "id", "label", "anchor", "d", "ints", "codes", "sides"])


def _pairs(index: DataFrame, asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block of rows beside every block of anchors of the same length, as rows of one table."""
    place = F.pmod(F.xxhash64("uid"), F.col("row_blocks"))
    deal = F.pmod(F.xxhash64("uid"), F.col("anchor_blocks"))
    rows = index.join(blocks, "d").select(
        "d", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("anchor_blocks") - 1)).alias("ab"), place.alias("rb"), F.lit(False).alias("asked"),
        "uid", "id", "label", "ints", "codes", "sides", F.lit(None).cast("array<bigint>").alias("goals"))
    anchors = asked.join(blocks, "d").select(
        "d", deal.alias("ab"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("row_blocks") - 1)).alias("rb"), F.lit(True).alias("asked"),
        "uid", "id", "label", "ints", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("binary").alias("sides"), "goals")
    return rows.unionByName(anchors)


def hard_negatives(df: DataFrame, id: str, label: Column | str, vector: str, anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows `anchor` holds of."""
    plain = F.col("vector").cast("array<double>")
    ok = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = pick(df, id=id, label=label, vector=vector, anchor=F.coalesce(anchor, F.lit(False))).withColumn("vector", plain).filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(F.coalesce(ok, F.lit(False)))
    numbered = rows.withColumns({"id": F.coalesce(F.col("id").cast("bigint"), F.lit(NO_ID)), "uid": F.monotonically_increasing_id(), "label": F.xxhash64("label"), "d": F.size("vector")})
    index = settle(numbered.mapInArrow(
        _encode, "uid bigint, id bigint, label bigint, anchor boolean, d int, ints binary, codes binary, sides binary"), "index")
    blocks = index.groupBy("d").agg(
        F.ceil(F.count("*") / ROWS).alias("row_blocks"), F.greatest(F.lit(1), F.ceil(F.count_if("anchor") / ANCHORS)).alias("anchor_blocks"))
    asked = index.filter("anchor")
    best = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), F.col("id"), "uid")

    def first(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= BEST)

    none = F.array().cast("array<bigint>")
    key = ["d", "ab", "rb"]
    found = first(_pairs(index, asked.withColumn("goals", none), blocks).groupBy(*key).applyInPandas(positives_of, FOUND))
    found = settle(found.select("anchor", (F.col("rank") - 1).alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    goals = found.groupBy(F.col("anchor").alias("uid")).agg(F.array_sort(F.collect_list(F.struct("positive", "positive_score")))["positive_score"].alias("goals"))
    with_goals = asked.join(goals, "uid")
    hard = first(_pairs(index, with_goals, blocks).groupBy(*key).applyInPandas(negatives_of, FOUND))
    names = asked.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    real = F.when(F.col("id") != NO_ID, F.col("id"))
    return hard.select("anchor", "positive", "rank", real.alias("negative_id"), F.col("score").alias("negative_score")).join(
        found, ["anchor", "positive"]).join(names, "anchor").select(
        "anchor_id", F.when(F.col("positive_id") != NO_ID, F.col("positive_id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        "negative_id", "positive_score", "negative_score")
