"""Near-duplicate vectors by product quantisation: coarse inverted lists, residual codes, exact cosine at the end.

Fitted on a bounded sample (SAMPLE vectors at most, by hash, and SAMPLE_MB at most): coarse centres by k-means, and one
small codebook per subspace for the residuals. Every vector is then indexed: its nearest centre is its list, its residual
is coded, and the coding error is kept.

A vector probes its own list and every list whose boundary with its own lies nearer than PROBE standard deviations of
what a link can reach across it, but never beyond half of what a link spans: of two linked vectors one lies within that
of the boundary of their lists, so that no probe further out is needed. The deviation is measured on the sample, list by
list, as the share of the residuals along the normals to the nearest lists: where vectors fill few dimensions it is
large, and the exact half takes over (below 16 effective dimensions at the default PROBE). Linked vectors meet if either
probes the other's list; a pair that meets twice is counted once. Within a probed list, distances to the codes are read off tables; a pair is passed on if its distance,
less the coding error, still allows the cosine, so that coding loses no link. What is passed on is verified by the
exact cosine in double precision.

Lists and the queries that probe them are dealt in blocks of about BLOCK rows, so that no task holds a large list.
A block pair returns counts and a spanning set of its links, never the pairs. Equal vectors are one class with a
multiplicity throughout.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with nothing and is its own
component; vectors of different lengths never link, each length has an index of its own; a null id is kept, counts as a
linked vector and never names a component that has an id; repeated rows link with each other; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitide.llm.common import pick
from epitide.llm.graph import components
from epitide.sources.stage import settle

LIMIT = 0.9
SAMPLE = 20_000
SAMPLE_MB = 64
LISTS = 1024      # most coarse centres; 2 sqrt(n) below that
SUBSPACES = 16
CODES = 256
PROBE = 2.0
BLOCK = 2048
NEIGHBOURS = 8    # lists next to a list, along whose normals the spread of its residuals is measured
ROUNDS = 8        # of k-means


# ---- fitting ----------------------------------------------------------------------------------------

def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[np.sort(rng.permutation(len(x))[:k])].copy()
    for _ in range(ROUNDS):
        at = nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), 4096):
        out[at:at + 4096] = distances(x[at:at + 4096], centres).argmin(1)
    return out


class Quantiser:
    def __init__(self, sample: np.ndarray, n: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.centres = kmeans(sample, max(1, min(LISTS, len(sample), int(2 * math.sqrt(n)))), rng)
        own = nearest(sample, self.centres)
        residual = sample - self.centres[own]
        d = sample.shape[1]
        cuts = sorted({i * d // SUBSPACES for i in range(SUBSPACES + 1)})
        self.spans = list(zip(cuts, cuts[1:]))
        self.books = [kmeans(residual[:, a:b], min(CODES, len(sample)), rng) for a, b in self.spans]
        gaps = distances(self.centres, self.centres)
        self.gaps = np.sqrt(np.maximum(gaps, 1e-12))
        self.reach = self._reach(own, residual)

    def _reach(self, own: np.ndarray, residual: np.ndarray) -> np.ndarray:
        """How far across a boundary the vectors of each list probe."""
        k, d = self.centres.shape
        spans = math.sqrt(2 - 2 * LIMIT)
        beside = np.argsort(self.gaps + np.diag(np.full(k, np.inf)), axis=1)[:, :min(NEIGHBOURS, k - 1)]
        across, whole = np.zeros(k), np.zeros(k)
        for i in range(k if k > 1 else 0):
            mine = residual[own == i]
            normals = (self.centres[beside[i]] - self.centres[i]) / self.gaps[i, beside[i]][:, None]
            across[i], whole[i] = ((mine @ normals.T) ** 2).mean(1).sum(), (mine * mine).sum()
        # A list with few vectors in the sample leans on all lists; no spread is taken below that of d equal dimensions.
        share = np.sqrt(np.divide(across, whole, out=np.zeros(k), where=whole > 0))
        every = math.sqrt(across.sum() / whole.sum()) if whole.sum() > 0 else 0.0
        return np.minimum(spans / 2, PROBE * spans * np.maximum(np.maximum(share, every), 1 / math.sqrt(d))) + 1e-9

    def encode(self, x: np.ndarray):
        """(list, code, coding error, probed lists as a 0/1 matrix) of unit vectors."""
        d2 = distances(x, self.centres)
        own = d2.argmin(1)
        residual = x - self.centres[own]
        code = np.stack([nearest(residual[:, a:b], book) for (a, b), book in zip(self.spans, self.books)], 1)
        back = np.concatenate([book[code[:, i]] for i, book in enumerate(self.books)], 1)
        error = np.sqrt(((residual - back) ** 2).sum(1))
        # Distance to the plane half way between the own centre and another, against what a link spans in one direction.
        plane = (d2 - d2[np.arange(len(x)), own][:, None]) / (2 * self.gaps[own])
        return own, code.astype(np.uint8), error, plane <= self.reach[own][:, None]

    def tables(self, x: np.ndarray, centre: int) -> list[np.ndarray]:
        """Squared distance of each query's residual to each codeword, by subspace."""
        residual = x - self.centres[centre]
        return [distances(residual[:, a:b], book) for (a, b), book in zip(self.spans, self.books)]


def units(vectors: list) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1))[:, None]


# ---- block pairs ------------------------------------------------------------------------------------

def _matrix(cells: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1)


def linked(q: Quantiser, centre: int, queries: np.ndarray, members: np.ndarray, codes: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """0/1 matrix of verified links between queries and members of one list: tables first, exact cosine of what is left."""
    total = np.zeros((len(queries), len(members)))
    for i, table in enumerate(q.tables(queries, centre)):
        total += table[:, codes[:, i]]
    near = total <= (math.sqrt(2 - 2 * LIMIT) + errors + 1e-6) ** 2
    rows, cols = near.any(1), near.any(0)
    if rows.any():
        exact = queries[rows] @ members[cols].T >= LIMIT
        near[np.ix_(rows, cols)] &= exact
    return near


def spanning(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, least row of its component) and (column, least row of its component) with the components of `mask`."""
    n, m = mask.shape
    row = np.where(mask.any(1), np.arange(n), n)
    while True:
        col = np.where(mask, row[:, None], n).min(0, initial=n)
        new = np.minimum(row, np.where(mask, col[None, :], n).min(1, initial=n))
        if (new == row).all():
            return row, col
        row = new


FOUND = "a bigint, b bigint, n bigint"


def _search(q: Quantiser, pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts (a, null, n) and links (a, b, null) of one block of a list with one block of its queries."""
    centre, cross = int(pdf["list"].iloc[0]), bool(pdf["probing"].iloc[0])
    left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    same = not cross and right.empty
    right = left if same else right
    if left.empty or right.empty:
        return pd.DataFrame({"a": [], "b": [], "n": []}).astype("Int64")
    kind = pdf["kind"].iloc[0]
    members = units(_matrix(right["vector"], kind))
    codes, errors = _matrix(right["code"], "u1"), right["error"].to_numpy()
    ids, counts = right["cid"].to_numpy(), right["n"].to_numpy()
    back = np.unpackbits(_matrix(right["probes"], "u1"), axis=1).astype(bool) if cross else None
    out, got = [], np.zeros(len(ids), np.int64)
    for at in range(0, len(left), 256):
        part = left.iloc[at:at + 256]
        mask = linked(q, centre, units(_matrix(part["vector"], kind)), members, codes, errors)
        own = part["cid"].to_numpy()
        if cross:  # a member that probes the query's list, if that comes first, meets the query there
            home = part["home"].to_numpy()
            mask &= ~(back[:, home].T & (home > centre)[:, None])
        elif same:
            mask &= ids[None, :] > own[:, None]
        found = mask @ counts
        got += mask.T @ part["n"].to_numpy()
        row, col = spanning(mask)
        used, met = np.flatnonzero(found), np.flatnonzero(col < len(part))
        out.append(pd.DataFrame({"a": own[used], "b": pd.NA, "n": found[used]}))
        out.append(pd.DataFrame({"a": own[used], "b": own[row[used]], "n": pd.NA}))
        out.append(pd.DataFrame({"a": ids[met], "b": own[col[met]], "n": pd.NA}))
    out.append(pd.DataFrame({"a": ids[got > 0], "b": pd.NA, "n": got[got > 0]}))
    return pd.concat([x.astype("Int64") for x in out])


# ---- the operator -----------------------------------------------------------------------------------

def _valid(v):
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(ok, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _links(classes: DataFrame, dim: int, n: int) -> DataFrame:
    """(a, b, n) of all block pairs of the classes of one length."""
    spark = classes.sparkSession
    bound = max(1, min(SAMPLE, SAMPLE_MB * (1 << 20) // (8 * dim)))
    sample = classes.orderBy("h1", "h2").select("vector").limit(bound).toArrow().column("vector")
    q = Quantiser(units(sample.to_pylist()), n)
    shared, lists = spark.sparkContext.broadcast(q), len(q.centres)
    double = classes.schema["vector"].dataType.simpleString() == "array<double>"
    kind = "<f8" if double else "<f4"

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                raw = np.asarray(part.column("vector").to_pylist(), kind)
                own, code, error, probed = shared.value.encode(units(raw))
                packed = np.packbits(probed, axis=1)
                probed[np.arange(len(own)), own] = False
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"), part.column("n"), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error),
                     pa.array([v.tobytes() for v in raw], pa.binary()), pa.array([p.tobytes() for p in packed], pa.binary()),
                     pa.array([np.flatnonzero(p).astype(np.int32) for p in probed], pa.list_(pa.int32()))],
                    ["cid", "n", "home", "code", "error", "vector", "probes", "others"])

    index = settle(classes.select("cid", "n", "vector").mapInArrow(
        indexed, "cid bigint, n bigint, home int, code binary, error double, vector binary, probes binary, others array<int>"), "index")

    def blocks(counts: DataFrame):
        """Blocks of each list as a literal array: one number per list, at most LISTS of them."""
        sizes = {r[0]: r[1] for r in counts.collect()}
        return F.array(*[F.lit(max(1, -(-sizes.get(i, 0) // BLOCK))) for i in range(lists)])

    members = blocks(index.groupBy("home").count())
    asked = blocks(index.select(F.explode("others").alias("list")).groupBy("list").count())
    deal = F.xxhash64("cid")
    own = F.pmod(deal, F.get(members, F.col("home"))).cast("int")
    other = F.sequence(F.lit(0), F.get(members, F.col("home")) - 1)
    # Within a list: each pair of its blocks once, the lower block on the left.
    inner = index.withColumn("own", own).select("*", F.explode(other).alias("other")).select(
        F.col("home").alias("list"), F.lit(False).alias("probing"), F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "n", "home", "code", "error", "vector", "probes")
    # Across: each block of a list with each block of the vectors that probe it.
    theirs = index.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.get(asked, F.col("home")) - 1)).alias("hi")).select(
        F.col("home").alias("list"), F.lit(True).alias("probing"), F.col("own").alias("lo"), "hi", F.lit(1).alias("side"), "cid", "n", "home", "code", "error", "vector", "probes")
    probing = index.select("*", F.explode("others").alias("list")).withColumn("hi", F.pmod(deal, F.get(asked, F.col("list"))).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.get(members, F.col("list")) - 1)).alias("lo")).select(
        "list", F.lit(True).alias("probing"), "lo", "hi", F.lit(0).alias("side"), "cid", "n", "home", F.lit(None).cast("binary").alias("code"), "error", "vector",
        F.lit(None).cast("binary").alias("probes"))
    rows = inner.unionByName(theirs).unionByName(probing).withColumn("kind", F.lit(kind))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        return _search(shared.value, pdf)

    return rows.groupBy("list", "probing", "lo", "hi").applyInPandas(search, FOUND)


def near_duplicates(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row."""
    rows = pick(df, id=id, vector=vector)
    element = rows.schema["vector"].dataType.elementType.simpleString()
    plain = F.col("vector") if element in ("float", "double") else F.col("vector").cast("array<double>")
    rows = rows.select("id", plain.alias("vector")).withColumn("ok", _valid(F.col("vector"))).withColumns({
        "h1": F.when(F.col("ok"), F.xxhash64("vector")), "h2": F.when(F.col("ok"), F.xxhash64(F.lit(1), "vector"))})
    classes = rows.filter("ok").groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"), F.min("id").alias("first"), F.count("*").alias("n"))
    classes = settle(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lengths = {r[0]: r[1] for r in classes.groupBy(F.size("vector").alias("d")).count().collect()}
    parts = [_links(classes.filter(F.size("vector") == d), d, n) for d, n in sorted(lengths.items())]
    empty = df.sparkSession.createDataFrame([], FOUND)
    found = settle(reduce(DataFrame.union, parts) if parts else empty, "found")
    counts = found.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links"))
    roots = components(found.filter("n IS NULL"), "a", "b")
    placed = classes.drop("vector").join(counts, F.col("cid") == F.col("a"), "left").join(roots, F.col("cid") == F.col("node"), "left").select(
        "h1", "h2", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = placed.join(firsts, "root").select("h1", "h2", "n_links", "component_id")
    return rows.drop("vector").join(known, ["h1", "h2"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
