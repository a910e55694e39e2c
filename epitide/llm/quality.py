"""Quality classification by hierarchical empirical Bayes.

Two flaws are judged, low quality and toxicity, each by two kinds of evidence:

* the document: a logistic model over its whole text (which words and word starts occur, and binned measures of its
  shape) gives the log likelihood ratio of the flaw. It is trained on a bounded sample of labelled documents, TRAIN_DOCS,
  chosen by a hash of the id; vocabulary selection and training use that sample alone, everything else all documents;
* the site: every document's probability under the global prior (the label itself where there is one) is summed by host
  and by path below the host. The host's rate is shrunk to the rate of all documents, the path's rate to its host's, each
  by a strength estimated from the spread between sites (method of moments), so that sparse sites stay near their prior.

The posterior of a document is its path's rate times its own evidence. It is rejected where either posterior reaches LIMIT.

Defined cases: a null or empty text has the evidence of an empty text; a null host or path is a site like any other; null
labels count as missing; a document that is labelled twice is flawed if any label says so; without labels of both kinds
the document evidence of a flaw is zero and nothing is rejected for it; repeated rows are judged alike; an empty table
gives an empty table; `classify` ignores other columns and `keep_good` passes them on.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitide.llm.common import batches_of, col, pick
from epitide.sources.stage import settle

TRAIN_DOCS = 12_000   # bound of the labelled sample that the document model is fitted on
BITS = 20             # hashed features
MIN_DOCS = 6          # flawed training documents that a word feature needs
G_TEST = 24.0         # and the least G statistic of its excess there
LIMIT = 0.5
FLAWS = ("low", "toxic")
WORDS = re.compile(r"\w+")

# ---- features of a text -----------------------------------------------------------------------------

# Upper bounds of the bins of each measure; a text falls into one bin per measure.
BINS = {
    "upper": (0.02, 0.05, 0.1, 0.2, 0.35, 0.6),
    "marks": (0.01, 0.03, 0.06, 0.1, 0.15, 0.25),
    "digits": (0.01, 0.03, 0.08, 0.2, 0.4),
    "bars": (0.001, 0.005, 0.01, 0.03),
    "length": (2.5, 3.5, 4.5, 5.5, 7.0, 9.0, 14.0),
    "variety": (0.1, 0.2, 0.3, 0.45, 0.6, 0.8),
    "repeats": (0.01, 0.05, 0.15, 0.4, 0.7),
    "lines": (0.2, 0.5, 0.8, 0.95),
    "size": (5, 20, 60, 200, 1000, 5000),
}
_OFFSETS = dict(zip(BINS, np.cumsum([0, *[len(b) + 1 for b in BINS.values()]]).tolist()))
SHAPES = sum(len(b) + 1 for b in BINS.values())
_LETTERS = str.maketrans("", "", "0123456789")
_UPPER, _LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
RUN = 400  # words of the runs that variety is measured in


def variety(words: list[str]) -> float:
    """Mean share of distinct words over the consecutive runs of RUN words; the last run ends with the text."""
    if len(words) <= RUN:
        return len(set(words)) / max(len(words), 1)
    ends = [*range(RUN, len(words), RUN), len(words)]
    return sum(len(set(words[e - RUN:e])) for e in ends) / (RUN * len(ends))


def cases(text: str) -> tuple[int, int]:
    """How many upper-case and lower-case letters a text has."""
    if text.isascii():
        raw = text.encode()
        return len(raw) - len(raw.translate(None, _UPPER)), len(raw) - len(raw.translate(None, _LOWER))
    return sum(map(str.isupper, text)), sum(map(str.islower, text))


def shape(text: str, words: list[str]) -> list[int]:
    """The bin of each measure, as feature numbers 0..SHAPES-1."""
    n = max(len(text), 1)
    spaces = n - len("".join(text.split())) if text else 0
    letters = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    capitals, smalls = cases(text)
    measures = {
        "upper": capitals / max(capitals + smalls, 1),
        "marks": max(n - spaces - letters, 0) / n if text else 0.0,
        "digits": 1 - len(text.translate(_LETTERS)) / n if text else 0.0,
        "bars": text.count("|") / n,
        "length": letters / max(len(words), 1),
        "variety": variety(words),
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / max(len(words) - 1, 1),
        "lines": len(set(lines)) / max(len(lines), 1),
        "size": len(words),
    }
    return [_OFFSETS[k] + int(np.searchsorted(BINS[k], v, side="right")) for k, v in measures.items()]


STARTS = (3, 4, 5)  # lengths of the word starts that are features beside the whole word
FEATURES = SHAPES + (1 << BITS) * (1 + len(STARTS))


def numbers_of(word: str) -> tuple[int, ...]:
    """Hashed feature numbers of a word and of its starts."""
    pieces = (word, *[word[:k] for k in STARTS if len(word) >= k])
    return tuple(SHAPES + (i << BITS) + (xxhash.xxh32_intdigest(p) >> 32 - BITS) for i, p in enumerate(pieces))


def features(text: str) -> np.ndarray:
    """Distinct feature numbers of a text, sorted."""
    words = WORDS.findall(text.lower())
    found = set(shape(text, words))
    for word in set(words):
        found.update(numbers_of(word))
    return np.sort(np.fromiter(found, np.int32, len(found)))


# ---- the document model -----------------------------------------------------------------------------

class Model:
    """Weights of the selected features for each flaw, intercepts, and the log odds of the training sample."""

    def __init__(self, numbers: np.ndarray, weights: np.ndarray, intercepts: np.ndarray, odds: np.ndarray):
        self.weights = dict(zip(numbers.tolist(), map(tuple, weights.tolist())))
        self.base = (intercepts - odds).tolist()
        self.known: dict[str, tuple[int, ...]] = {}  # selected features of the words that this worker has met

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def ratios(self, text: str) -> list[float]:
        """Log likelihood ratio of each flaw."""
        words = WORDS.findall(text.lower())
        known, weights = self.known, self.weights
        if len(known) > 400_000:
            known.clear()
        found = set(shape(text, words))
        for word in set(words):
            hits = known.get(word)
            if hits is None:
                hits = known[word] = tuple(k for k in numbers_of(word) if k in weights)
            if hits:
                found.update(hits)
        used = sorted(found.intersection(weights))
        return [base + sum(weights[k][i] for k in used) for i, base in enumerate(self.base)]


def _select(rows: list[np.ndarray], y: np.ndarray, least: int) -> np.ndarray:
    """All shape features that occur, and the words that flawed documents have more often than chance allows (G test)."""
    everything, inside = np.zeros(FEATURES, np.int32), np.zeros(FEATURES, np.int32)
    for r, flawed in zip(rows, y):
        everything[r] += 1
        if flawed:
            inside[r] += 1
    some = np.flatnonzero(inside >= least)
    some = some[some >= SHAPES]
    n, k, share = everything[some].astype(float), inside[some].astype(float), y.sum() / len(y)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (k * np.log(k / (n * share)) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - share))), 0))
    return np.concatenate([np.flatnonzero(everything[:SHAPES]), some[(k > n * share) & (gain > G_TEST)]])


def _fit(rows: list[np.ndarray], y: np.ndarray, l2: float = 0.05, steps: int = 600):
    """Logistic regression with an L2 penalty by accelerated gradient steps; numpy on the bounded sample only."""
    numbers = _select(rows, y, MIN_DOCS)
    place = np.full(FEATURES, -1, np.int32)
    place[numbers] = np.arange(len(numbers))
    used = [p[p >= 0] for p in (place[r] for r in rows)]  # of each document's features only the selected ones
    doc, feature = np.repeat(np.arange(len(rows)), [len(u) for u in used]), np.concatenate(used)
    n, d = len(y), len(numbers)
    w, b = np.zeros(d), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    odds = b
    per_doc = np.bincount(doc, minlength=n).max()
    rate = 1.0 / (0.25 * n * (per_doc + 1) / 8 + l2)
    vw, vb = w.copy(), b
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, vw[feature], n) + vb, -30, 30)))
        gw = np.bincount(feature, (p - y)[doc], d) + l2 * vw
        gb = float((p - y).sum())
        nw, nb = vw - rate * gw, vb - rate * gb
        m = t / (t + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return numbers, w, b, odds


def train(documents: DataFrame, labels: DataFrame, id: str, text: str, sample: int = TRAIN_DOCS) -> Model:
    """`labels` has (id, low, toxic). The sample is the `sample` labelled ids of smallest hash; only it reaches the driver."""
    chosen = labels.filter("low IS NOT NULL AND toxic IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(sample)
    # At most `sample` rows of three small columns: a proven bound for the broadcast.
    rows = pick(documents, id=id, text=text).join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("low", "toxic", "text")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            found = [features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("low"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["low", "toxic", "found"])

    got = rows.mapInArrow(extracted, "low int, toxic int, found array<int>").toArrow()
    # In an order that the cluster cannot change, so that the same sample always gives the same model.
    found = [v.values.to_numpy() for v in got.column("found")]
    ys = {f: np.asarray(got.column(f).to_pylist(), float) for f in FLAWS}
    order = sorted(range(len(found)), key=lambda i: (found[i].tobytes(), ys["low"][i], ys["toxic"][i]))
    # Near copies have the same least words: one of them speaks for all, or their every word would look telling.
    order = list({found[i][np.searchsorted(found[i], SHAPES):][:4].tobytes(): i for i in reversed(order)}.values())
    found = [found[i] for i in order]
    parts = []
    for flaw in FLAWS:
        y = ys[flaw][order] if order else np.zeros(0)
        parts.append(_fit(found, y) if 0 < y.sum() < len(y) else (np.zeros(0, np.int64), np.zeros(0), 0.0, 0.0))
    numbers = np.unique(np.concatenate([p[0] for p in parts]))
    weights = np.zeros((len(numbers), len(FLAWS)))
    for i, p in enumerate(parts):
        weights[np.searchsorted(numbers, p[0]), i] = p[1]
    return Model(numbers, weights, np.array([p[2] for p in parts]), np.array([p[3] for p in parts]))


def with_evidence(df: DataFrame, model: Model, text: str, low: str = "llr_low", toxic: str = "llr_toxic") -> DataFrame:
    """All columns of `df` and the document's evidence for each flaw. The model is bounded by its training sample."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, T.StructField(low, T.DoubleType()), T.StructField(toxic, T.DoubleType())])
    at = df.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, by=text):
            ratios = [shared.value.ratios(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in ratios], pa.float64()), pa.array([r[1] for r in ratios], pa.float64())],
                [*batch.schema.names, low, toxic])

    return df.mapInArrow(scored, schema)


# ---- sites ------------------------------------------------------------------------------------------

def _logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def _bounded(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(sites: DataFrame, flaw: str, base: float) -> float:
    """Documents that the prior is worth: p(1-p)/v - 1, with v the spread between sites beyond what chance gives.

    One aggregate over the sites; between 10 and 10,000 documents.
    """
    mean = F.col(flaw) / F.col("n")
    row = sites.filter("n > 1").agg(F.sum(F.col("n") * (mean - base) ** 2), F.sum("n"), F.count("*")).first()
    if not row[1] or not 0 < base < 1:
        return 100.0
    spread = row[0] / row[1] - base * (1 - base) * row[2] / row[1]
    return float(min(10_000.0, max(10.0, base * (1 - base) / spread - 1))) if spread > 0 else 10_000.0


def site_rates(scored: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """(host, path, rate_low, rate_toxic) from (id, host, path, llr_low, llr_toxic), and the rates of all documents."""
    known = labels.select(F.col("id").alias("_l"), F.col("low").alias("is_low"), F.col("toxic").alias("is_toxic"))
    counts = labels.agg(F.count("*"), F.sum("low"), F.sum("toxic")).first()
    prior = {f: min(max((counts[i + 1] or 0) / counts[0], 1e-4), 1 - 1e-4) if counts[0] else 1e-4 for i, f in enumerate(FLAWS)}
    marked = scored.join(known, F.col("id") == F.col("_l"), "left")
    own = [F.coalesce(F.col(f"is_{f}").cast("double"), _sigmoid(F.lit(float(np.log(prior[f] / (1 - prior[f])))) + F.col(f"llr_{f}"))).alias(f) for f in FLAWS]
    paths = settle(marked.select("host", "path", *own).groupBy("host", "path").agg(F.count("*").alias("n"), *[
        F.sum(F.round(f, 9).cast("decimal(20,9)")).cast("double").alias(f) for f in FLAWS]), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", *FLAWS)])
    total = paths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(f), F.lit(0.0)).alias(f) for f in FLAWS]).first()
    base = {f: total[f] / total["n"] if total["n"] else prior[f] for f in FLAWS}
    rate = {}
    joined = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host")))
    for f in FLAWS:
        ks = _strength(hosts, f, base[f]), _strength(paths, f, base[f])
        host = (F.col(f"h.{f}") + ks[0] * base[f]) / (F.col("h.n") + ks[0])
        rate[f] = _bounded((F.col(f"p.{f}") + ks[1] * host) / (F.col("p.n") + ks[1])).alias(f"rate_{f}")
    return joined.select(F.col("p.host").alias("_host"), F.col("p.path").alias("_path"), *rate.values()), base


def one_label(labels: DataFrame, id: str, quality: str, toxic: str) -> DataFrame:
    """(id, low, toxic), one row per labelled id."""
    rows = pick(labels, id=id, q=quality, t=toxic).filter("id IS NOT NULL AND q IS NOT NULL AND t IS NOT NULL")
    return rows.groupBy("id").agg(F.max((F.col("q") == 0).cast("int")).alias("low"), F.max((F.col("t") == 1).cast("int")).alias("toxic"))


def _posteriors(df: DataFrame, rates: DataFrame, host: Column, path: Column, low: str, toxic: str) -> DataFrame:
    """`rates` has one row per site and is joined null-safe: broadcast while small, hot sites split otherwise."""
    joined = df.join(rates, host.eqNullSafe(F.col("_host")) & path.eqNullSafe(F.col("_path")))
    return joined.withColumns({"_p_low": _sigmoid(_logit(F.col("rate_low")) + F.col(low)), "_p_toxic": _sigmoid(_logit(F.col("rate_toxic")) + F.col(toxic))})


def _scored(documents: DataFrame, labels: DataFrame, id: str, text: str, host: str, path: str):
    model = train(documents, labels, id, text)
    rows = pick(documents, id=id, host=host, path=path, text=text)
    scored = settle(with_evidence(rows, model, "text").drop("text"), "scored")
    return model, scored, site_rates(scored, labels)[0]


def classify(documents: DataFrame, labels: DataFrame, id: str, text: str, host: str, path: str, limit: float = LIMIT) -> DataFrame:
    """(id, host, path, llr_*, rate_*, p_low, p_toxic, keep), one row per document; `labels` as from `one_label`."""
    _, scored, rates = _scored(documents, labels, id, text, host, path)
    found = _posteriors(scored, rates, F.col("host"), F.col("path"), "llr_low", "llr_toxic")
    return found.select("id", "host", "path", "llr_low", "llr_toxic", "rate_low", "rate_toxic", F.col("_p_low").alias("p_low"), F.col("_p_toxic").alias("p_toxic"),
                        ((F.col("_p_low") < limit) & (F.col("_p_toxic") < limit)).alias("keep"))


def keep_good(documents: DataFrame, labels: DataFrame, id: str, text: str, host: str, path: str, limit: float = LIMIT) -> DataFrame:
    """The documents that are not rejected, with all their columns. Texts are scored where they are read, not shuffled."""
    model, _, rates = _scored(documents, labels, id, text, host, path)
    names = documents.columns
    packed = documents.select(F.struct("*").alias("_doc"), col(host).alias("_h"), col(path).alias("_p"), col(text).alias("_text"))
    found = _posteriors(with_evidence(packed, model, "_text", "_low", "_toxic").drop("_text"), rates, F.col("_h"), F.col("_p"), "_low", "_toxic")
    return found.filter((F.col("_p_low") < limit) & (F.col("_p_toxic") < limit)).select(*[F.col("_doc").getField(c).alias(c) for c in names])
