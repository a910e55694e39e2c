"""Katz backoff language model: Good-Turing discounted n-gram counts, exact backoff weights, log10 scores of whole texts.

    P(w | h) = d(c(hw)) c(hw) / c(h)       where the n-gram was seen in training
             = alpha(h) P(w | h')          otherwise, h' being h without its first word

d is Turing's estimate for counts up to TURING and, where that is no proper discount and beyond, the log-linear one, so
that every context keeps some mass: alpha(h) = (1 - sum of the discounted) / (1 - sum of P(w | h') over the words seen
after h) makes each context's probabilities sum to exactly one. At the bottom, unseen words share one class `unknown`,
which gets what the discounted unigrams leave. A text is w1 .. wn and an end token; its first word follows a begin mark,
and contexts at the start of a text are as long as they can be.

How it runs. Texts are read once and written as chunks of tokens: distinct word hashes and the tokens as
places among them. Then, level by level, every chunk asks for its distinct n-grams (one row per chunk and bucket, however
often an n-gram occurs); a bucket adds up the training counts of all chunks and answers with counts and global numbers;
its merged counts are the stored model, a table whose rows are the buckets of a level. An n-gram is keyed by the number of
its context and of its last word. A bucket belongs to contexts by hash; a context that holds more than a share of
its level's training tokens is dealt over several by its words, so that no bucket holds a hot one. What is seen after a context
is totalled per bucket and added up by a grouped sum; its backoff weight is joined to those chunks that need it. In the end
each chunk walks from the longest n-grams down and sums its texts.

Words are keyed by 64-bit hashes: at a hundred million different words two share one with a chance of 3 in 10,000.

Defined cases: a null text is empty and consists of the end token; a null id is kept, and is not held out; rows that
repeat an id or a text are texts of their own; a very long text is cut into pieces that keep their context; without any
training text every token has probability one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from epitide.llm.common import batches_of, pick, small_batches
from epitide.sources.stage import settle

ORDER = 2


class Limits(NamedTuple):
    """What one task holds at a time; results do not depend on these."""

    chunk: int = 1 << 20   # tokens of a chunk, unless one slice of a text has more
    slice: int = 8 << 20   # bytes of a text that are split at once
    bucket: int = 1 << 20  # training and other tokens per bucket
    share: int = 1 << 18   # training tokens of a context that one bucket takes


LIMITS = Limits()
KNOWN = 400_000       # words whose hash a worker remembers, of at most WORD_BYTES each
WORD_BYTES = 64
TURING = 5
SPECTRUM = 1000       # counts of counts that are gathered
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BEGIN, END = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"")  # no word is a space or empty


@contextmanager
def tidy(spark: SparkSession):
    """Drop the shuffle files of every query of this block when it has ended; what is needed later is written by then."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# ---- columns of numbers as bytes --------------------------------------------------------------------

def pack(*columns: np.ndarray, rising: int = 0) -> bytes:
    """Columns of numbers, the like bytes of all numbers of a column side by side, compressed.

    The first `rising` columns are ascending and kept as differences; numbers that repeat much and are no integers as
    places in a list of the different ones.
    """
    out = []
    for i, c in enumerate(columns):
        if c.dtype.kind == "f":
            few, place = np.unique(c, return_inverse=True)
            parts = [few, place.astype(np.uint32)]
        else:
            parts = [np.diff(c, prepend=c.dtype.type(0)) if i < rising else c]
        for x in parts:
            planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
            small = zstandard.compress(planes, 3)
            out.append(struct.pack("<cBQQ", x.dtype.char.encode(), i < rising, len(x), len(small)) + small)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    parts, at, head = [], 0, struct.calcsize("<cBQQ")
    while at < len(data):
        kind, rising, n, size = struct.unpack_from("<cBQQ", data, at)
        dtype = np.dtype(kind.decode())
        planes = zstandard.decompress(data[at + head:at + head + size], max_output_size=max(1, n * dtype.itemsize))
        x = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).ravel()
        parts.append(np.cumsum(x, dtype=dtype) if rising else x)
        at += head + size
    out, rest = [], iter(parts)
    for x in rest:
        out.append(x[next(rest)] if x.dtype.kind == "f" else x)
    return out


# ---- texts to chunks --------------------------------------------------------------------------------

class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= WORD_BYTES:
            if len(self) > KNOWN:
                self.clear()
            self[word] = found
        return found


_HASHES = _Hashes()


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """The text in slices of about `size` bytes that end at white space."""
    at = 0
    while len(text) - at > size:
        cut = SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def pieces(text: bytes | None, order: int, size: int = LIMITS.slice) -> Iterator[tuple[np.ndarray, int, bool]]:
    """(word hashes, number of leading ones that are context only, whether the text begins here): one piece, or several of a very long text.

    bytes.lower() and bytes.split() know ASCII alone: A-Z, and exactly the white space of a word's definition.
    """
    before, parts = np.array([BEGIN], np.uint64), list(slices(text or b"", size))
    for k, part in enumerate(parts):
        words = part.lower().split()
        own = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
        last = np.array([END] if k + 1 == len(parts) else [], np.uint64)
        whole = np.concatenate([before, own, last])
        yield whole, len(before), k == 0
        before = whole[max(0, len(whole) - (order - 1)):]  # a begin mark among these is not counted again


def _chunks(batches: Iterator[pa.RecordBatch], order: int, kind: pa.DataType, limits: Limits) -> Iterator[pa.RecordBatch]:
    first, number = TaskContext.get().partitionId() << 32, 0
    rows, hashes, leads, starts, helds, ids = [], [], [], [], [], []
    doc, size = first, 0

    def flush():
        nonlocal number, size
        words, tokens, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")  # frequent words get small places, which take less room
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        sizes = np.fromiter(map(len, hashes), np.uint32, len(hashes))
        blob = pack(words[order], place[tokens], sizes, np.array(leads, np.uint32), np.array(starts, np.uint8), np.array(helds, np.uint8))
        ends = pa.array([0, len(rows)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, v) for v in (pa.concat_arrays(ids).cast(kind), pa.array(rows, pa.int64()), pa.array(helds, pa.bool_()))]
        out = pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()), pa.array([size], pa.int64()), *lists, pa.array([blob], pa.binary())],
                                         ["chunk", "tokens", "ids", "docs", "helds", "blob"])
        number, size = number + 1, 0
        for part in (rows, hashes, leads, starts, helds, ids):
            part.clear()
        return out

    for batch in batches_of(batches):
        texts, held, own = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("held").to_pylist(), batch.column("id")
        for i, text in enumerate(texts):
            for whole, lead, start in pieces(text, order, limits.slice):
                for part, x in ((rows, doc), (hashes, whole), (leads, lead), (starts, start), (helds, held[i]), (ids, own.slice(i, 1))):
                    part.append(x)
                size += len(whole)
                if size >= limits.chunk:
                    yield flush()
            doc += 1
    if rows:
        yield flush()


# ---- Good-Turing ------------------------------------------------------------------------------------

class Discount:
    """d(r): the share of a count r that seen n-grams keep, below one for every r."""

    def __init__(self, spectrum: dict[int, int]):
        have = sorted(r for r, n in spectrum.items() if r > 0 and n > 0)
        slope = -2.0
        if len(have) > 2:  # counts of counts thin out, so each is spread over the gap between its neighbours
            wide = [(b - a) / 2 for a, b in zip([0, *have[:-1]], [*have[1:], 2 * have[-1] - have[-2]])]
            slope = float(np.polyfit(np.log(have), np.log([spectrum[r] / max(w, 0.5) for r, w in zip(have, wide)]), 1)[0])
        self.power = min(slope, -1.1) + 1
        self.low = np.array([self._low(spectrum, r) for r in range(1, TURING + 1)])

    def _low(self, spectrum: dict[int, int], r: int) -> float:
        own, more = spectrum.get(r, 0), spectrum.get(r + 1, 0)
        turing = (r + 1) * more / (r * own) if own else 0.0
        return turing if 0 < turing < 1 else (1 + 1 / r) ** self.power

    def of(self, r: np.ndarray) -> np.ndarray:
        r = np.maximum(r, 1)
        return np.where(r <= TURING, self.low[np.minimum(r, TURING) - 1], (1 + 1 / r) ** self.power)


class Level:
    """What the driver knows of a level: its discount, and of the first the totals."""

    def __init__(self, spectrum: dict[int, int], tokens: int, types: int):
        self.discount, self.tokens, self.types, self.unknown = Discount(spectrum), tokens, types, 1.0

    def unigram(self, r: np.ndarray) -> np.ndarray:
        return np.where(r > 0, self.discount.of(r) * r / max(self.tokens, 1), self.unknown)


# ---- one chunk --------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Grams:
    """The distinct n-grams of one level in one chunk."""

    def __init__(self, at, context, word, suffix, n, ctx, key, q, buckets, spread):
        self.at, self.context, self.word, self.suffix, self.n = at, context, word, suffix, n  # `at`: n-gram ending at each token, or -1
        self.ctx, self.key, self.q = ctx, key, q
        with np.errstate(over="ignore"):
            self.bucket = (_mixed(ctx * np.uint64(31) + _mixed(key) % spread) % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((key, ctx, self.bucket))

    def take(self, answers: pd.DataFrame) -> None:
        """Counts and global numbers out of the answers of all buckets."""
        parts = [unpack(b)[::-1] for b in answers.sort_values("bucket")["blob"]]
        self.r, self.number = np.empty(len(self.n), np.int64), np.zeros(len(self.n), np.uint64)
        self.r[self.order] = np.concatenate([p[0] for p in parts])
        if len(parts[0]) > 1:  # the highest level needs no numbers
            self.number[self.order] = np.concatenate([p[1] for p in parts])


class Chunk:
    def __init__(self, blob: bytes, buckets: int, share: int = LIMITS.share):
        self.words, tok, self.sizes, lead, begins, held = unpack(blob)
        self.tok, self.buckets, self.share = tok.astype(np.int64), buckets, share
        starts = np.cumsum(self.sizes) - self.sizes
        self.pos = np.arange(len(tok)) - np.repeat(starts, self.sizes).astype(np.int64)
        self.event = self.pos >= np.repeat(lead, self.sizes)
        self.learned = ~np.repeat(held.astype(bool), self.sizes)
        self.begun = int((begins.astype(bool) & ~held.astype(bool)).sum())

    def first(self) -> Grams:
        n = np.bincount(self.tok[self.event & self.learned], minlength=len(self.words))
        n[self.words == BEGIN] = self.begun  # how often it is a context; it is never a word
        none = np.zeros(len(self.words), np.uint64)
        return Grams(self.tok, None, None, None, n, none, self.words, none, self.buckets, np.uint64(1 << 62))

    def next(self, n: int, one: Grams, last: Grams, probability: np.ndarray) -> Grams:
        t = np.flatnonzero(self.pos >= n - 1)
        distinct, place = np.unique(last.at[t - 1] * len(self.words) + self.tok[t], return_inverse=True)
        at = np.full(len(self.tok), -1)
        at[t] = place
        context, word = distinct // len(self.words), distinct % len(self.words)
        suffix = np.empty(len(distinct), np.int64)
        suffix[place] = last.at[t]
        count = np.bincount(place[(self.event & self.learned)[t]], minlength=len(distinct))
        spread = (1 + last.r[context] // self.share).astype(np.uint64)
        return Grams(at, context, word, suffix, count, last.number[context], one.number[word], one.r[word] if n == 2 else probability[suffix], self.buckets, spread)


def walked(chunk: Chunk, answers: pd.DataFrame, levels: list[Level]) -> tuple[list[Grams], list[np.ndarray]]:
    """The n-grams of all answered levels and their probabilities, each from the one a level below."""
    grams, found = [], []
    for n, level in enumerate(levels, 1):
        own = answers[answers["level"] == n]
        g = chunk.first() if n == 1 else chunk.next(n, grams[0], grams[-1], found[-1])
        g.take(own[own["bucket"] >= 0])
        keep = level.discount.of(g.r) * g.r
        if n == 1:
            p = level.unigram(g.r)
        else:
            back = own[own["bucket"] < 0]
            ctx, alpha = back["ctx"].to_numpy(np.int64).astype(np.uint64), back["alpha"].to_numpy(np.float64)
            order = np.argsort(ctx)
            ctx, alpha = np.append(ctx[order], np.uint64(1 << 63)), np.append(alpha[order], 1.0)
            place = np.searchsorted(ctx, g.ctx)
            weight = np.where(ctx[place] == g.ctx, alpha[place], 1.0)
            p = np.where(g.r > 0, keep / np.maximum(grams[-1].r[g.context], 1), weight * found[-1][g.suffix])
        grams.append(g)
        found.append(p)
    return grams, found


def asks(chunk: Chunk, answers: pd.DataFrame, levels: list[Level]) -> pd.DataFrame:
    """(bucket, blob): the distinct n-grams of the level above those answered."""
    grams, found = walked(chunk, answers, levels)
    g = chunk.first() if not levels else chunk.next(len(levels) + 1, grams[0], grams[-1], found[-1])
    bucket = g.bucket[g.order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    out = []
    for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)].astype(int)):
        o = g.order[a:b]
        out.append((int(bucket[a]), pack(g.ctx[o], g.key[o], g.n[o].astype(np.uint32), g.q[o], rising=1 if levels else 2)))
    return pd.DataFrame(out, columns=["bucket", "blob"])


def sums(chunk: Chunk, answers: pd.DataFrame, levels: list[Level]) -> pd.DataFrame:
    """(piece, n_tokens, n_known, base_score, score) of the pieces of a chunk."""
    grams, found = walked(chunk, answers, levels)
    p = found[0][grams[0].at]
    for g, f in zip(grams[1:], found[1:]):
        p = np.where(g.at >= 0, f[g.at], p)
    c = grams[0].r[chunk.tok]
    base = np.log10((c + 1) / (levels[0].tokens + levels[0].types + 1))
    piece, event = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes), chunk.event

    def total(x):
        return np.bincount(piece[event], x[event], len(chunk.sizes))

    return pd.DataFrame({"piece": np.arange(len(chunk.sizes), dtype=np.int32), "n_tokens": total(np.ones(len(c))).astype(np.int64),
                         "n_known": total(c > 0).astype(np.int64), "base_score": total(base), "score": total(np.log10(p))})


# ---- one bucket -------------------------------------------------------------------------------------

TOLD = "kind int, chunk bigint, bucket bigint, blob binary, need array<bigint>, spectrum array<bigint>, tokens bigint, types bigint"


def tell(pdf: pd.DataFrame, first: bool, last: bool) -> pd.DataFrame:
    """Answers to the chunks that asked a bucket (kind 0), and the bucket's part of the model (kind 1)."""
    parts = [unpack(b) for b in pdf["blob"]]
    ctx, key, n, q = (np.concatenate([p[k] for p in parts]) for k in range(4))
    order = np.lexsort((key, ctx))
    new = np.r_[True, (ctx[order][1:] != ctx[order][:-1]) | (key[order][1:] != key[order][:-1])]
    starts, place = np.flatnonzero(new), np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    r = np.add.reduceat(n[order].astype(np.int64), starts)
    bucket = int(pdf["bucket"].iloc[0])
    number = np.uint64(bucket << 32) + np.arange(len(r), dtype=np.uint64)
    ctx, key, q = ctx[order][starts], key[order][starts], q[order][starts]
    out, at = [], 0
    for chunk, part in zip(pdf["chunk"], parts):
        own = place[at:at + len(part[0])]
        at += len(part[0])
        need = [] if first else np.unique(ctx[own][r[own] == 0]).astype(np.int64)
        out.append((0, chunk, bucket, pack(r[own]) if last else pack(number[own], r[own], rising=1), need, None, 0, 0))
    seen = (r > 0) & ((key != BEGIN) | (not first))
    spectrum = np.bincount(r[seen & (r <= SPECTRUM)], minlength=SPECTRUM + 1)
    out.append((1, None, bucket, pack(ctx[seen], number[seen], key[seen], r[seen], q[seen], rising=3 if first else 2), None, spectrum, int(r[seen].sum()), int(seen.sum())))
    frame = pd.DataFrame(out, columns=["kind", "chunk", "bucket", "blob", "need", "spectrum", "tokens", "types"])
    return frame.astype({"chunk": "Int64"})


def _contexts(pdfs: Iterator[pd.DataFrame], discount: Discount, unigram) -> Iterator[pd.DataFrame]:
    """(ctx, total, mass, lower) per context and bucket: training count, discounted count, lower-level mass of the words seen.

    What the level below says of a word is its count there on the second level, and a probability above.
    """
    for pdf in pdfs:
        for blob in pdf["blob"]:
            ctx, _, _, r, q = unpack(blob)
            if len(ctx):
                starts = np.flatnonzero(np.r_[True, ctx[1:] != ctx[:-1]])
                yield pd.DataFrame({"ctx": ctx[starts].astype(np.int64), "total": np.add.reduceat(r, starts),
                                    "mass": np.add.reduceat(discount.of(r) * r, starts), "lower": np.add.reduceat(q if q.dtype.kind == "f" else unigram(q.astype(np.int64)), starts)})


def _teller(first: bool, last: bool):
    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        return tell(pdf, first, last)

    return answer


# ---- the operator -----------------------------------------------------------------------------------

# Replies of buckets to chunks; with bucket -1 the weight alpha of a context.
ANSWERS = "chunk bigint, level int, bucket bigint, blob binary, ctx bigint, alpha double"


def _cogrouped(chunks: DataFrame, answers: DataFrame, work, schema: str, buckets: int, share: int, levels: list[Level]) -> DataFrame:
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = work(Chunk(left["blob"].iloc[0], buckets, share), right, levels)
        out.insert(0, "chunk", key[0])
        return out

    return chunks.select("chunk", "blob").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, f"chunk bigint, {schema}")


def _learn(told: DataFrame, n: int, levels: list[Level]) -> tuple[Level, DataFrame]:
    """What the driver keeps of a level (at most SPECTRUM numbers), and the backoff weights (ctx, alpha)."""
    model = told.filter("kind = 1")
    spectrum = {x["pos"]: x["n"] for x in model.select(F.posexplode("spectrum").alias("pos", "n")).groupBy("pos").agg(F.sum("n").alias("n")).filter("n > 0").collect()}
    total = model.agg(F.sum("tokens"), F.sum("types")).first()
    level = Level(spectrum, total[0] or 0, total[1] or 0)
    discount, unigram = level.discount, (levels or [level])[0].unigram
    sums_ = model.select("blob").mapInPandas(lambda pdfs: _contexts(pdfs, discount, unigram), "ctx bigint, total bigint, mass double, lower double").groupBy("ctx").agg(
        F.sum("total").alias("total"), F.sum("mass").alias("mass"), F.sum("lower").alias("lower"))
    if n == 1:
        whole = sums_.first()
        level.unknown = 1 - whole["mass"] / whole["total"] if whole else 1.0
        return level, None
    least = F.lit(1e-300)
    alpha = F.greatest(1 - F.col("mass") / F.col("total"), least) / F.greatest(1 - F.col("lower"), least)
    return level, settle(sums_.select("ctx", alpha.alias("alpha")), "weights")


def scores(df: DataFrame, id: str, text: str, held: Column, order: int = ORDER, limits: Limits = LIMITS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Rows that `held` is true of are scored only; all others train the model too.
    """
    spark = df.sparkSession
    rows = pick(df, id=id, text=text, held=F.coalesce(held, F.lit(False)))
    id_type = rows.schema["id"].dataType
    kind, name = to_arrow_type(id_type), id_type.simpleString()
    with tidy(spark):
        with small_batches(spark):
            chunks = settle(rows.mapInArrow(
                lambda batches: _chunks(batches, order, kind, limits), f"chunk bigint, tokens bigint, ids array<{name}>, docs array<bigint>, helds array<boolean>, blob binary"), "chunks")
        tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
        buckets = max(1, -(-tokens // limits.bucket))
        answers, levels = spark.createDataFrame([], ANSWERS), []
        for n in range(1, order + 1):
            asked = _cogrouped(chunks, answers, asks, "bucket bigint, blob binary", buckets, limits.share, list(levels))
            answer = _teller(n == 1, n == order)
            told = settle(asked.groupBy("bucket").applyInPandas(answer, TOLD), f"level{n}")
            level, weights = _learn(told, n, levels)
            levels.append(level)
            replies = told.filter("kind = 0").select("chunk", F.lit(n).alias("level"), "bucket", "blob", F.lit(-1).cast("bigint").alias("ctx"), F.lit(1.0).alias("alpha"))
            answers = answers.unionByName(replies)
            if weights is not None:
                needs = told.filter("kind = 0").select("chunk", F.explode("need").alias("ctx")).distinct()
                given = settle(needs.join(weights, "ctx").select(
                    "chunk", F.lit(n).alias("level"), F.lit(-1).cast("bigint").alias("bucket"), F.lit(b"").alias("blob"), "ctx", "alpha"), "given")
                answers = answers.unionByName(given)
        parts = _cogrouped(chunks, answers, sums, "piece int, n_tokens bigint, n_known bigint, base_score double, score double", buckets, limits.share, levels)
        parts = settle(parts, "scored")
    zipped = F.posexplode(F.arrays_zip("ids", "docs", "helds")).alias("piece", "doc")
    docs = chunks.select("chunk", zipped).select("chunk", "piece", "doc.*")
    return docs.join(parts, ["chunk", "piece"]).groupBy("docs").agg(
        F.first("ids").alias("id"), F.first("helds").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score")).select(
        "id", "held_out", "n_tokens", "n_known", F.lit(levels[0].tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
