"""The language model, hard negatives and the manifest against plain versions, on odd rows and on nothing."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from brute import lowered, words
from odd_rows import DATA, ODD, none, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from epitide.llm import katz, merkle, negatives
from epitide.llm.queries import FIELDS, LOWER, QUERIES, SQL, UPPER

TINY = katz.Limits(chunk=700, slice=300, bucket=900, share=40)


# ---- 11 -----------------------------------------------------------------------------------------------

class Plain:
    """Katz backoff by dictionaries; a text is <s> w1 .. wn </s>, and n-grams with other ends are not counted."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [collections.Counter() for _ in range(order + 1)]
        for w in texts:
            x = ["<s>", *w, "</s>"]
            for t in range(1, len(x)):
                for n in range(1, order + 1):
                    if t >= n - 1:
                        self.counts[n][tuple(x[t - n + 1:t + 1])] += 1
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        self.discount = [None, *[katz.Discount(collections.Counter(r for r in c.values() if r <= katz.SPECTRUM)) for c in self.counts[1:]]]
        self.after, self.context = collections.defaultdict(list), collections.Counter()
        for n in range(2, order + 1):
            for g, c in self.counts[n].items():
                self.after[g[:-1]].append(g[-1])
                self.context[g[:-1]] += c
        self.unknown = 1 - sum(self.d(1, c) for c in self.counts[1].values()) / self.n if self.n else 1.0

    def d(self, n, c):
        return float(self.discount[n].of(np.array([c]))[0]) * c

    def p(self, h, w):
        if not h:
            c = self.counts[1][w,]
            return self.d(1, c) / self.n if c else self.unknown
        c = self.counts[len(h) + 1][*h, w]
        if c:
            return self.d(len(h) + 1, c) / self.context[h]
        return self.alpha(h) * self.p(h[1:], w)

    def alpha(self, h):
        if h not in self.context:
            return 1.0
        kept = sum(self.d(len(h) + 1, self.counts[len(h) + 1][*h, w]) for w in self.after[h]) / self.context[h]
        return (1 - kept) / (1 - sum(self.p(h[1:], w) for w in self.after[h]))

    def score(self, w):
        x = ["<s>", *w, "</s>"]
        return sum(math.log10(self.p(tuple(x[max(0, t - self.order + 1):t]), x[t])) for t in range(1, len(x)))

    def base(self, w):
        return sum(math.log10((self.counts[1][t,] + 1) / (self.n + self.v + 1)) for t in [*w, "</s>"])


def held_column():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def same_rows(got, want):
    def sort(rows):
        return sorted(rows, key=lambda r: (str(r[0]), r[1], r[2], round(r[6], 4)))
    assert len(got) == len(want)
    for a, b in zip(sort(got), sort(want)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, odd, none, order):
    for df in (odd, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)):
        rows = [(r.doc_id, words(lowered(r.text))) for r in df.select("doc_id", "text").collect()]
        model = Plain([w for i, w in rows if not is_held(i)], order)
        want = [(i, is_held(i), len(w) + 1, sum(model.counts[1][t,] > 0 for t in [*w, "</s>"]), model.n, model.base(w), model.score(w)) for i, w in rows]
        for limits in (katz.LIMITS, TINY) if order == 2 else (TINY,):
            same_rows([tuple(r) for r in katz.scores(df, "doc_id", "text", held_column(), order, limits).collect()], want)
    assert katz.scores(none, "doc_id", "text", held_column(), order).count() == 0


def test_every_context_sums_to_one():
    texts = [words(prose(k, 300, 40)) for k in range(5)]
    model = Plain(texts, 3)
    vocabulary = [w for w, in model.counts[1]]
    for h in [(), ("w1",), ("<s>",), ("w1", "w2"), (*texts[0][:2],), ("never", "w3")]:
        unseen = model.unknown if not h else model.p(h, "never seen")
        assert sum(model.p(h, w) for w in vocabulary) + unseen == pytest.approx(1, abs=1e-9)


def test_discounts_leave_mass():
    for spectrum in ({}, {1: 5}, {3: 2}, {1: 100, 2: 40, 3: 20, 4: 11, 5: 8, 6: 5, 50: 1}, {1: 1, 2: 9}):
        d = katz.Discount(spectrum).of(np.arange(1, 2000))
        assert ((0 < d) & (d < 1)).all()


def test_all_held_out(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.scores(df, "doc_id", "text", F.lit(True)).collect()
    assert sorted((r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_scores_query_beats_the_base(spark):
    got = QUERIES["op11_katz_scores"](spark, DATA).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    assert {r.held_out for r in got if r.n_known < r.n_tokens} == {True}


# ---- 12 -----------------------------------------------------------------------------------------------

def mined(rows, anchor):
    """Brute force over integer vectors; rows are (id, label, vector)."""
    out = collections.Counter()
    known = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    def key(c):
        return (-c[0], c[1] is None, c[1] or 0)
    for k, (i, l, v) in enumerate(known):
        if not anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for n, (j, m, w) in enumerate(known) if n != k and len(w) == len(v)]
        for p, j, _ in sorted([c for c in scored if c[2] == l], key=key)[:5]:
            fit = sorted([c for c in scored if c[2] != l and 80 * p <= 100 * c[0] <= 100 * p], key=key)[:5]
            out.update((i, j, r + 1, c[1], p, c[0]) for r, c in enumerate(fit))
    return out


def embedded(seed, n, d, rank):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, d)) if rank < d else rng.normal(size=(n, d))
    return x / np.sqrt((x * x).sum(1))[:, None]


@pytest.mark.parametrize("d,rank", [(64, 64), (24, 3), (100, 100)])
def test_hard_negatives(spark, monkeypatch, d, rank):
    x = embedded(d, 420, d, rank)
    rows = [(i, int(i * 7919 % 4), v.tolist()) for i, v in enumerate(x)] + [(1000 + i, 1, x[3].tolist()) for i in range(9)]
    rows += [(400, 2, x[5].tolist()), (None, 1, x[7].tolist()), (None, 2, x[100].tolist()), (2000, None, x[1].tolist()), (2100, 1, None), (2200, 1, [math.nan] * d),
             (2300, 1, [None] * d), (2400, 1, []), (2500, 2, []), (2600, 1, [0.5, -2.0]), (2700, 1, [0.5, 1.0]), (2701, 3, [0.5, 1.0]), (2800, 0, [0.0] * d), (2900, 3, (-x[5]).tolist())]
    df = spark.createDataFrame([(*r, "q", 1.5) for r in rows], "vec_id long, label int, embedding array<double>, uid string, d double").repartition(3)
    anchor = F.col("vec_id") % 100 == 0
    for size in (4096, 60):
        monkeypatch.setattr(negatives, "ROWS", size)
        monkeypatch.setattr(negatives, "ANCHORS", max(2, size // 20))
        got = negatives.hard_negatives(df, "vec_id", "label", "embedding", anchor).collect()
        assert collections.Counter(map(tuple, got)) == mined(rows, lambda i: i is not None and i % 100 == 0)
    assert negatives.hard_negatives(df.limit(0), "vec_id", "label", "embedding", anchor).count() == 0


def test_intervals_hold_every_score():
    x = np.floor(256 * embedded(3, 300, 64, 64)).astype(np.int64)
    codes, along, last = negatives.coded(x)
    exact, seen = x[:40] @ x.T, []

    def reach(lo, hi):
        assert (lo <= exact).all() and (exact <= hi).all()
        seen.append(np.mean(hi - lo))
        return np.ones(lo.shape, bool)

    negatives.surviving(x[:40], codes, along, last, np.sqrt((x * x).sum(1)), np.ones(exact.shape, bool), reach)
    assert len(seen) == negatives.STAGES and seen == sorted(seen, reverse=True) and seen[-1] < 0.2 * 65536 * 2


def test_too_long_vectors_are_refused(spark):
    df = spark.createDataFrame([(0, 1, [1e9, 0.0])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="too long"):
        negatives.hard_negatives(df, "vec_id", "label", "embedding", F.lit(True)).collect()


# ---- 13 -----------------------------------------------------------------------------------------------

def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def runs(nodes):
    return [nodes[a:a + 8] for a in range(0, len(nodes), 8)]


def grown(nodes):
    """(root, siblings to the left and right of every leaf's path)."""
    paths, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, under = [], []
        for r, run in enumerate(runs(nodes)):
            for s in range(len(run)):
                for leaf in at[8 * r + s]:
                    paths[leaf].append((run[:s], run[s + 1:]))
            up.append(h(*run))
            under.append([leaf for s in range(len(run)) for leaf in at[8 * r + s]])
        nodes, at = up, under
    return nodes[0], paths


def manifested(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        built[g] = grown([leaf_of(r) for r in groups[g]])
    root, above = grown([built[g][0] for g in names])
    out = collections.Counter()
    for k, g in enumerate(names):
        for row, path in zip(groups[g], built[g][1]):
            whole = [*path, *above[k]]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            text = row[4] if row[4] is None else row[4].translate(str.maketrans(UPPER, LOWER))
            node = leaf_of((*row[:4], text)) if changed else leaf_of(row)
            for left, right in whole:
                node = h(*left, node, *right)
            out[row[0], leaf_of(row), built[g][0], root, h(*[x for a, b in whole for x in (*a, *b)]), node, node == root] += 1
    return out


def listed(df):
    own = {f: F.col(f) for f in FIELDS}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.manifest(df, "doc_id", "lang", own, {"text": F.translate("text", UPPER, LOWER)}, changed)
    return collections.Counter(map(tuple, got.collect()))


def test_manifest(spark, odd, none):
    schema = "doc_id long, source string, lang string, n_chars long, text string, i int, node string, grp string"
    many = [(k % 590, "s", ("en", "", None, "日本", "EN")[min(k // 150, 4)], None, f"Text {k % 590}", k, "x", "y") for k in range(612)] + [(None, None, "en", None, None, 1, "x", "y")] * 9
    lone = [(5, "s", "en", 3, "abc", 1, "x", "y")]
    many += [(k, "s", f"l{k}", 1, "T", 1, "x", "y") for k in range(70)]
    for df in (odd, spark.createDataFrame(many, schema).repartition(5), spark.createDataFrame(lone, schema)):
        rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.select(*FIELDS).collect()]
        assert listed(df) == manifested(rows)
    assert not listed(none)


def test_manifest_notices_what_changed(spark):
    got = QUERIES["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in got.join(texts, "doc_id").collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None and lowered(r.text) != r.text
        assert r.verified == (not changed)
    assert {"op12_hard_negatives", "op13_merkle_manifest"} <= set(SQL)
