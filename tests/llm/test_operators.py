"""Every operator against a plain version, on odd rows, on empty tables and on a small data folder."""

import collections
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from brute import leaks, lowered, near, roots, shingles, similarity, simhash, tokens, words
from odd_rows import DATA, ODD, PASSAGE, none, odd, prose  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from epitide.llm import decontaminate, mixing, passages, quality, sharding, tokencount, tokenids, urlfilter, vectors
from epitide.llm import shingles as hashing
from epitide.llm import simhash as sim
from epitide.llm.graph import components
from epitide.llm.queries import QUERIES, SQL, tokenizer_path
from epitide.sources import stage

RANKS = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# ---- shared -------------------------------------------------------------------------------------------

def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links * 2, "x long, y long"), "x", "y").collect()}
    want = roots({n for l in links for n in l}, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def rounds(monkeypatch):
    """Names of what `components` writes: one at its start and one a round."""
    from epitide.llm import graph
    seen, real = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, name: (seen.append(name), real(df, name))[1])
    return seen


def test_stars_need_no_round(spark, monkeypatch):
    seen = rounds(monkeypatch)
    stars = [(1, i) for i in range(2, 40)] + [(100, i) for i in range(101, 120)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(stars, "x long, y long"), "x", "y").collect()}
    assert got == {(b, a) for a, b in stars} | {(1, 1), (100, 100)} and len(seen) == 1


def test_components_of_hubs_are_found_once(spark, monkeypatch):
    """Fingerprints that are all linked to one hub, and one that only a link across reaches."""
    seen = rounds(monkeypatch)
    fps = [0, *[1 << i for i in range(0, 60, 7)], (1 << 40) - 1 << 20]
    frame = spark.createDataFrame([(v,) for v in fps], "fp long")
    got = {r.fp: r.root for r in sim.rooted(frame).collect()}
    want = roots(set(fps), [(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 4])
    assert got == want and len(seen) == 2


# ---- 1: token counts ----------------------------------------------------------------------------------

def library(vocabulary):
    tokenizer = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=vocabulary.unknown, byte_fallback=vocabulary.byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace()
    return lambda t: len(tokenizer.encode(t or "").ids)


def test_token_counts(spark, odd, none):
    count = library(tokencount.from_ranks(RANKS))
    for df in (odd, documents(spark)):
        got = sorted((str(r.id), r.n_tokens) for r in tokencount.token_counts(df, "doc_id", "text", RANKS).collect())
        assert got == sorted((str(r.doc_id), count(r.text)) for r in df.select("doc_id", "text").collect())
    assert tokencount.token_counts(none, "doc_id", "text", RANKS).count() == 0


@pytest.mark.parametrize("fallback", [True, False])
def test_ties_and_unknown_characters(fallback):
    pieces = (("<unk>", -9.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aa", -2.0), ("ba", -2.0), ("▁", -1.0), ("▁a", -2.0), ("bab", -3.0))
    pieces += tuple((f"<0x{b:02X}>", -30.0) for b in range(256)) if fallback else ()
    v = tokencount.Vocabulary(pieces, 0, fallback)
    own, count = tokencount.Counter(v), library(v)
    for text in ("ababab baab", "aaaa a  b", "axyb zz", "ßß日a", "", " ", "bababab" * 9):
        assert own.of(text) == count(text), text


# ---- 2: mixing ----------------------------------------------------------------------------------------

def test_mix(spark, odd, none):
    for df in (odd, documents(spark)):
        got = mixing.mixed_sizes(df).collect()
        again = {(r.id, r.source, r.size): r.copies for r in mixing.mixed_sizes(df.repartition(7)).collect()}
        rows = df.select("doc_id", "source", "text").collect()
        assert sorted((str(r.id), str(r.source), r.size) for r in got) == sorted((str(r.doc_id), str(r.source), len(words(r.text))) for r in rows)
        total, sizes, goals, taken = sum(r.size for r in got), collections.Counter(), {}, collections.Counter()
        for r in got:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            goals[r.source] = r.target
            assert r.taken <= 3 * r.size and r.copies in (int(r.target // max(r.source_size, 1)), int(r.target // max(r.source_size, 1)) + 1, 0, 3)
            assert again[r.id, r.source, r.size] == r.copies
        assert all(goals[s] <= 3 * sizes[s] + 1e-6 for s in sizes) and sum(goals.values()) == pytest.approx(min(total, 3 * total))
        order = sorted(sizes, key=lambda s: (s is None, s))
        weight = {s: i % 3 + 1 for i, s in enumerate(order)}
        free = [s for s in sizes if goals[s] < 3 * sizes[s] - 1e-6]
        assert len({round(goals[s] / weight[s], 6) for s in free}) <= 1
        kept = mixing.mix(df, "doc_id", "source", "text", mixing.targets(mixing.cycled_weights(mixing.source_sizes(df, "source", mixing.word_count("text")))))
        assert kept.columns == df.columns and kept.count() == sum(r.copies for r in got)
    assert mixing.mixed_sizes(none).count() == 0


def test_mix_comes_near_its_targets(spark):
    """Sources of few documents, one of them a third of its source, and one source with most documents."""
    rng = np.random.default_rng(9)
    sizes = [(s, int(n)) for s in range(12) for n in [700, *rng.integers(1, 60, 50)]] + [(12, int(n)) for n in rng.integers(1, 400, 6000)]
    rows = [(i, None if s == 3 else f"s{s:02d}", "w " * n) for i, (s, n) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    near, taken, whole = 0, collections.Counter(), collections.Counter()
    for seed in range(6):
        got, goals = collections.Counter(), {}
        for r in mixing.mixed_sizes(df, seed=seed).collect():
            assert r.copies in (int(r.target // r.source_size), min(3, int(r.target // r.source_size) + 1))
            got[r.source] += r.taken
            goals[r.source] = r.target
            if r.size == 700 and r.target < 3 * r.source_size:
                taken[seed] += r.copies
                whole[seed] += r.target / r.source_size
        assert got["s12"] == pytest.approx(goals["s12"], rel=0.01)
        assert all(got[s] == pytest.approx(goals[s], rel=0.15) for s in goals)
        near += sum(abs(got[s] / goals[s] - 1) < 0.05 for s in goals)
    assert near >= 0.9 * 6 * 13
    # The large document is taken as often as its rate says, over the seeds.
    assert abs(sum(taken.values()) - sum(whole.values())) < 4 * (0.25 * 6 * 12) ** 0.5


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10, 100.0), ("b", 1000, 1.0), ("c", 500, 1.0), ("d", 0, 1.0), ("e", 50, None)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got == {"a": 30.0, "b": 765.0, "c": 765.0, "d": 0.0, "e": 0.0}


# ---- 3: URLs ------------------------------------------------------------------------------------------

def test_rules_and_parts(spark):
    rules = (("net/", "block"), ("example.net/en/", "allow"))
    urls = ["http://A.Example.NET/en/1", "http://example.net/EN/1", "https://net/?q", "https://net?x=/", None, "no scheme/net/", "http://xnet/", "http://a.net#/", "x://a.net/p?://b"]
    pages = spark.createDataFrame([(i, u, None, "h") for i, u in enumerate(urls)], "id long, url string, bad int, host string").drop("host")
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()}
    assert got == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.net", "/EN/1", "net/", "block"), 2: ("net", "/", "net/", "block"), 3: ("net", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("xnet", "/", None, "allow"), 7: ("a.net", "", None, "allow"), 8: ("a.net", "/p", "net/", "block")}
    assert urlfilter.judge(pages.limit(0), rules).count() == 0


def test_tree_keeps_branches_that_differ(spark):
    rows = [(f"http://h.org/{d}/{n}", int(d == "ads" or n % 10 == 0)) for d in ("ads", "news", "blog") for n in range(200)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "id long, url string, bad int")
    got = urlfilter.judge(pages, ()).collect()
    assert {r.template for r in got} == {"/ads/*", "/blog+/*"}
    assert {(r.path.split("/")[1], r.verdict) for r in got} == {("ads", "block"), ("news", "allow"), ("blog", "allow")}


def test_tree_goes_by_support_not_by_share_or_depth(spark):
    def pages(groups):
        rows = [(url, bad) for url, bad, n in groups for _ in range(n)]
        return spark.createDataFrame([(i, f"http://h.org{u}/p{i}", b) for i, (u, b) in enumerate(rows)], "id long, url string, bad int")

    def verdicts(groups, **tree):
        return {(r.path.rsplit("/", 1)[0], r.template, r.verdict) for r in urlfilter.judge(pages(groups), (), **tree).collect()}

    # A small bad section of a large host, and the same one of a small host.
    for clean in (19620, 1900):
        assert verdicts([("/spam", 1, 100), ("/news", 0, clean)]) == {("/spam", "/spam/*", "block"), ("/news", "/news/*", "allow")}
    # A difference on the fourth level.
    assert verdicts([("/a/b/c/bad", 1, 300), ("/a/b/c/ok", 0, 300)]) == {
        ("/a/b/c/bad", "/*/*/*/bad/*", "block"), ("/a/b/c/ok", "/*/*/*/ok/*", "allow")}
    # Many small steps from clean to bad: neighbours are alike, the ends are not.
    got = verdicts([(f"/s{k:02d}", b, n) for k in range(26) for b, n in ((1, 2 * k), (0, 50 - 2 * k)) if n])
    kinds = {p: (t, v) for p, t, v in got}
    assert kinds["/s00"][1] == "allow" and kinds["/s25"][1] == "block" and kinds["/s00"][0] != kinds["/s25"][0]
    # Segments that look like wildcards or classes.
    odd = verdicts([("/*", 1, 60), ("/x+", 0, 60), ("/x", 0, 60), ("/%2A", 0, 60)])
    assert {(p, t) for p, t, _ in odd} == {("/*", "/%2A/*"), ("/x+", "/%252A+/*"), ("/x", "/%252A+/*"), ("/%2A", "/%252A+/*")}
    assert {p for p, _, v in odd if v == "block"} == {"/*"}


def test_url_odd_rows(spark):
    long = "http://h.org/" + "/".join(["deep"] * 3000)
    rows = [(1, long, 1), (1, long, 1), (2, None, 1), (3, "", None), (None, "http://h.org//a//", 0), (4, "http://h.org/" + "x" * 100_000, 0)]
    pages = spark.createDataFrame([(*r, "h", "t") for r in rows], "id long, url string, bad int, host string, template string")
    got = urlfilter.judge(pages, ()).collect()
    assert len(got) == len(rows) and len({(r.verdict, r.template) for r in got if r.id == 1}) == 1
    assert {r.template for r in got} == {"/**", "", "/*"}
    assert urlfilter.judge(pages.limit(0), ()).count() == 0


# ---- 4: vectors ---------------------------------------------------------------------------------------

def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 24))
    x = [b + s * rng.normal(size=24) for b in base for s in (0, 0.05, 0.2, 0.3, 0.4, 0.45, 0.5)] + list(rng.normal(size=(300, 24)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, x[0].tolist()), (900, x[0].tolist()), (901, (3 * x[3]).tolist())]
    odd = [(950, None), (951, []), (952, [0.0] * 24), (953, [float("nan")] * 24), (954, [1.0, None] * 12), (955, [float("inf")] * 24), (956, [1.0, 2.0]), (957, [2.0, 4.0]), (None, x[0].tolist())]
    df = spark.createDataFrame([(i, v, 1, "q") for i, v in rows + odd], "vec_id long, v array<double>, cid int, n string")
    got = vectors.near_duplicates(df, "vec_id", "v").collect()
    ids = [i for i, _ in rows] + [None]
    m = np.array([v for _, v in rows] + [x[0].tolist()])
    m /= np.sqrt((m * m).sum(1))[:, None]
    near_ = (m @ m.T >= 0.9) & ~np.eye(len(m), dtype=bool)
    lab = roots(range(len(m)), zip(*[a.tolist() for a in np.nonzero(near_)]))
    first = collections.defaultdict(list)
    for k, i in enumerate(ids):
        first[lab[k]].append(10**9 if i is None else i)
    want = collections.Counter((i, int(near_[k].sum()), min(first[lab[k]])) for k, i in enumerate(ids))
    want.update([(i, 0, i) for i in range(950, 956)] + [(956, 1, 956), (957, 1, 956)])
    assert collections.Counter((r.vec_id if "vec_id" in r else r.id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.id is not None and r.id == r.component_id) for r in got)
    assert vectors.near_duplicates(df.limit(0), "vec_id", "v").count() == 0


def test_blocks_and_probes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(8)
    hot = rng.normal(size=16)
    x = np.array([hot + 0.1 * rng.normal(size=16) for _ in range(250)] + list(rng.normal(size=(600, 16))))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "i long, v array<float>")
    got = {r.id: r.n_links for r in vectors.near_duplicates(df, "i", "v").collect()}
    m = x.astype(np.float32).astype(float)
    m /= np.sqrt((m * m).sum(1))[:, None]
    want = (m @ m.T >= 0.9).sum(1) - 1
    assert sum(got.values()) >= 0.99 * want.sum() and all(got[i] <= want[i] for i in got)


def test_vectors_of_few_dimensions(spark):
    """Vectors that fill 4 and 8 of 48 dimensions, and clusters that each fill a few of their own: no link is lost."""
    rng = np.random.default_rng(11)

    def flat(n, low):
        return rng.normal(size=(n, low)) @ rng.normal(size=(low, 48)) + 0.01 * rng.normal(size=(n, 48))

    clusters = np.concatenate([2 * rng.normal(size=48) + flat(150, 3) / 2 for _ in range(8)])
    for x in (flat(1500, 4), flat(1500, 8), clusters):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>")
        got = {r.id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, "vec_id", "v").collect()}
        m = x / np.sqrt((x * x).sum(1))[:, None]
        near_ = (m @ m.T >= 0.9) & ~np.eye(len(m), dtype=bool)
        assert near_.sum() > 100
        found = sum(n for n, _ in got.values())
        assert found <= near_.sum() and found >= 0.999 * near_.sum()


# ---- 5: passages --------------------------------------------------------------------------------------

def test_compact_windows():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 40, 300).astype(np.uint64) << np.uint64(40) | passages._TOP
    v[[0, 120, 299]] = 0
    at, left, right = passages.compact_windows(v, 10)
    want = set()
    for i in range(291):
        run = v[i:i + 10]
        if (run != 0).all():
            want.add(i + int(run.argmin()))
    assert at.tolist() == sorted(want)
    for c, l, r in zip(at, left, right):
        lo = next(k for k in range(c - 1, -1, -1) if v[k] <= v[c])
        hi = next(k for k in range(c + 1, 300) if v[k] < v[c])
        assert (l, r) == (min(c - lo - 1, passages.REACH), min(hi - c - 1, passages.REACH))


def test_spans():
    a = np.arange(200)
    b = a.copy()
    b[60:64] = -1
    assert [(s, e) for s, e, *_ in passages.spans(a, b, 46, 0.8)] == [(0, 200)]
    b[50:110] = -1
    assert [(s, e) for s, e, *_ in passages.spans(a, b, 46, 0.8)] == [(0, 50), (110, 200)] or sorted((s, e) for s, e, *_ in passages.spans(a, b, 46, 0.8)) == [(0, 50), (110, 200)]
    assert passages.spans(a[:40], a[:40], 46, 0.8) == []


def test_near_copies_of_minimum_length_share_a_window():
    """Passages of 50 words with 5 of 51 shingles in one copy only (similarity 0.8): under 2 % have no common value."""
    rng, missed = np.random.default_rng(4), 0
    seeds = passages.mixed(np.arange(1, passages.HASHES + 1, dtype=np.uint64))
    for _ in range(4000):
        own, other = rng.integers(0, 2**63, (2, 46)).astype(np.uint64)
        other[5:] = own[5:]  # 41 of 51 distinct shingles are common
        missed += all(passages.mixed(own ^ s).argmin() != passages.mixed(other ^ s).argmin() or passages.mixed(own ^ s).argmin() < 5 for s in seeds)
    assert missed < 0.02 * 4000


def check_passages(df, got):
    texts = collections.defaultdict(set)
    for r in df.select("doc_id", "text").collect():
        texts[r.doc_id].add(r.text)
    by = {d: [tokens(t) for t in ts] for d, ts in texts.items()}
    links = set()
    for r in got:
        assert r.end - r.start >= 50
        assert any(abs(similarity(shingles(x[r.start:r.end]), shingles(y[r.rep_start:r.rep_end])) - r.similarity) < 1e-9 and r.similarity >= 0.8
                   for x in by[r.id] for y in by[r.rep_id])
        links.add((str(r.id), str(r.rep_id)))
    joined = roots({str(d) for d in by}, links)
    grams = collections.defaultdict(set)
    for d, ws in by.items():
        for w in ws:
            for i in range(len(w) - 49):
                grams[tuple(w[i:i + 50])].add(str(d))
    assert all(len({joined[d] for d in ds}) == 1 for ds in grams.values() if len(ds) > 1)
    return {d for l in links for d in l}, {d for ds in grams.values() if len(ds) > 1 for d in ds}


def test_passages(spark, odd, none):
    found, exact = check_passages(odd, passages.passages(odd, "doc_id", "text").collect())
    assert exact <= found and {"9", "10", "14", "1", "2", "3", "15", "16"} <= found and not found & {"11", "12", "13", "None", "7"}
    found, exact = check_passages(documents(spark), passages.passages(documents(spark), "doc_id", "text").collect())
    assert exact <= found and len(found) < 1.3 * len(exact)
    assert passages.passages(none, "doc_id", "text").count() == 0


def test_passages_that_the_smallest_document_does_not_hold(spark):
    """Documents 1..9 share one line; pairs of the others share a passage around that line that the smallest has not."""
    line = prose("line", 8)
    rows = [(i, prose(f"l{i}", 60) + " " + line + " " + prose(f"r{i}", 60)) for i in range(1, 10)]
    rows += [(20 + i, prose(f"x{i}", 30) + " " + prose(f"p{i // 2}", 25) + " " + line + " " + prose(f"q{i // 2}", 25) + " " + prose(f"y{i}", 30)) for i in range(12)]
    got = passages.passages(spark.createDataFrame(rows, "d long, t string"), "d", "t").collect()
    assert {(r.rep_id, r.id) for r in got} == {(20 + i, 21 + i) for i in range(0, 12, 2)}


def around(line, i, left, right, size=60):
    """A text around `line` with `left` words before and `right` words after it from a shared passage, the rest its own."""
    n, m = left[1] if left else 0, right[1] if right else 0
    own = [prose(f"own left {i}", size - n), prose(f"own right {i}", size - m)]
    return " ".join([own[0], *([prose(left[0], n)] if left else []), line, *([prose(right[0], m)] if right else []), own[1]])


def test_passages_around_a_line_at_their_start_or_end(spark):
    """A passage begins or ends with a line that a smaller document and many others hold."""
    line = prose("line", 8)
    rows = [(i, around(line, i, None, None)) for i in range(1, 30)]
    rows += [(100 + i, around(line, 100 + i, (f"p{i // 2}", 4), (f"q{i // 2}", 45))) for i in range(10)]
    rows += [(200 + i, around(line, 200 + i, (f"r{i // 2}", 45), (f"s{i // 2}", 4))) for i in range(10)]
    # 301 and 302 agree with 300 on one side of the line only, with each other on both.
    rows += [(300, around(line, 300, ("t", 30), None)), (301, around(line, 301, ("t", 30), ("u", 30))), (302, around(line, 302, ("t", 30), ("u", 30)))]
    for hashes in (1, 2):
        got = passages.passages(spark.createDataFrame(rows, "d long, t string"), "d", "t", hashes=hashes).collect()
        assert {(r.rep_id, r.id) for r in got} == {(k + i, k + i + 1) for k in (100, 200) for i in range(0, 10, 2)} | {(301, 302)}


def least_line():
    """A line with a shingle that is least in any passage under the first hash function."""
    seed = passages.mixed(np.arange(1, 2, dtype=np.uint64))
    return min((prose(f"line {k}", 8) for k in range(3000)), key=lambda x: passages.mixed(passages.shingles(x.split()) ^ seed).min())


def test_passages_of_a_document_that_repeats_a_line(spark):
    """The smallest document holds a line in other contexts before and after the passage that others share with it."""
    line = least_line()
    shared = prose("left", 25) + " " + line + " " + prose("right", 25)
    first = " ".join([prose("a", 60), line, prose("b", 60), shared, prose("c", 60), line, prose("d", 60)])
    row = " ".join([prose("e", 9), line, prose("f", 9), shared, prose("g", 9), line, prose("h", 9)])  # the middle one of three in a row
    for text in (first, row):
        rows = [(1, text)] + [(i, " ".join([prose(f"y{i}", 50), shared, prose(f"z{i}", 50)])) for i in range(2, 6)]
        got = passages.passages(spark.createDataFrame(rows, "d long, t string"), "d", "t", hashes=1).collect()
        assert {r.id for r in got if r.rep_id == 1} == {2, 3, 4, 5}


def test_extents_reach_the_shortest_passage(spark):
    long = prose("long", 160)
    rows = [(i, " ".join([prose(f"l{i}", 40), *([prose(f"own{i // 3}", 80)] * 2), long, prose(f"r{i}", 40)])) for i in range(6)]
    got = passages.passages(spark.createDataFrame(rows, "d long, t string"), "d", "t", min_words=150, hashes=1).collect()
    assert {r.id for r in got} == {1, 2, 3, 4, 5}
    v = np.sort(np.random.default_rng(6).permutation(2000))[::-1].astype(np.uint64) << np.uint64(40) | passages._TOP
    v[[0, -1]] = 0
    at, left, right = passages.compact_windows(v, 150)
    assert at.tolist()[-1] == 1998 and left.max() == 149


def test_near_copies_around_a_line_of_many_documents(spark):
    """Pairs of documents hold the same text around a line that smaller documents hold; one word differs on each side, near the line."""
    line = least_line()
    rows = [(i, around(line, i, None, None)) for i in range(1, 30)]
    for i in range(24):
        left, right = prose(f"p{i // 2}", 43).split(), prose(f"q{i // 2}", 43).split()
        if i % 2:
            left[-9 - i % 5], right[8 + i % 5] = "other", "another"
        rows.append((100 + i, " ".join([prose(f"own left {100 + i}", 60), *left, line, *right, prose(f"own right {100 + i}", 60)])))
    got = passages.passages(spark.createDataFrame(rows, "d long, t string"), "d", "t", hashes=1).collect()
    assert {(r.rep_id, r.id) for r in got} == {(100 + i, 101 + i) for i in range(0, 24, 2)}


def test_run_hashes():
    own = np.random.default_rng(8).integers(0, 2**63, 40).astype(np.uint64)
    own[20:30] = own[5:15]
    first, second, other, none = passages.run_hashes(own, np.array([5, 20, 6, 9]), np.array([15, 30, 16, 9]))
    assert first == second != other and passages.run_hashes(own[5:15], np.array([0]), np.array([10]))[0] == first and none == passages.mixed(np.zeros(1, np.uint64))[0]


def test_spans_of_equal_windows_need_no_shingles(spark):
    """Equal windows without a gap are a span as they are; others, and windows with a gap between them, are verified."""
    names = "dk long, id long, lo int, rid long, rdk long, rlo int, diag long, a long, z long, same boolean"
    rows = [(1, 1, 0, 0, 0, 0, 0, 0, 50, True), (1, 1, 0, 0, 0, 0, 0, 51, 99, True), (2, 2, 0, 0, 0, 0, 0, 0, 50, True), (2, 2, 0, 0, 0, 0, 0, 60, 110, True),
            (3, 3, 0, 0, 0, 0, 0, 0, 50, False), (0, 0, 0, 0, 0, 0, 9, 9, 60, True)]
    own = list(range(120))
    texts = {0: own, 2: own[:55] + [-1] + own[56:], 3: own[:49] + [-1] * 71}  # 1 has no segment: nothing asks for its shingles
    segments = spark.createDataFrame([(k, k, 0, v) for k, v in texts.items()], "dk long, id long, lo int, shingles array<int>")
    found, held = passages._spans(spark.createDataFrame(rows, names), segments, 46, 0.8)
    assert {(r.dk, r.s, r.e, r.rs, r.re, r.similarity) for r in found.filter("similarity = 1").collect()} == {(1, 0, 100, 0, 100, 1.0), (3, 0, 49, 0, 49, 1.0)}
    assert {(r.dk, r.s, r.e) for r in found.filter("similarity < 1").collect()} == {(2, 0, 111)} and {(r.dk, r.s, r.e) for r in held.collect()} == {(2, 0, 55), (2, 56, 111), (3, 0, 49)}


def test_equal_windows_ask_once(spark):
    """Equal windows of many documents ask for bands once; all are linked, at each of their places."""
    line = least_line()
    rows = [(i, around(line, i, None, None)) for i in range(1, 20)]
    shared = " ".join([prose("left", 43), line, prose("right", 43)])
    words = shared.split()
    words[25], words[-25] = "other", "another"
    rows.append((90, " ".join([prose("k", 60), *words, prose("l", 60)])))
    rows += [(100 + i, " ".join([prose(f"x{i}", 60), shared, prose(f"y{i}", 70), *([shared, prose(f"z{i}", 60)] if i == 0 else [])])) for i in range(30)]
    docs = spark.createDataFrame(rows, "d long, t string")
    got = passages.passages(docs, "d", "t", hashes=1).collect()
    assert {r.rep_id for r in got if r.id == 100} == {90} and {r.start > 200 for r in got if r.id == 100} == {True, False}
    assert {r.id for r in got} == {100 + i for i in range(30)} and {r.rep_id for r in got} <= {90, *range(100, 130)}


def test_words_of_many_texts_are_hashed_at_once():
    rng = np.random.default_rng(5)
    texts = [None, "", "a", " x_1 ", "ΟΔΥΣΣΕΥΣ ΑΣ Σ", "Straße İstanbul naïve", "日本語 テキスト 12³", "x" * 31 + " " + "y" * 32 + " " + "é" * 40, "𝒳𝒴 a𐐀b", "a\nb\n\n c", "no", "\x00b"]
    texts += ["".join(rng.choice(list("abc éß_-Σ日𝒳9\n"), 200)) for _ in range(20)]
    want = [hashing.hashed(hashing.words(x)) for x in texts]
    found, counts = hashing.word_hashes(texts)
    assert (found == np.concatenate(want)).all() and counts.tolist() == [len(x) for x in want]
    assert [len(x) for x in hashing.word_hashes([])] == [0, 0] and hashing.word_hashes([None, ""])[1].tolist() == [0, 0]
    long = np.concatenate(want)[:30]
    assert (hashing.runs_of(long) == [hashing.runs_of(long[i:i + 5])[0] for i in range(26)]).all()
    assert (hashing.runs_of(hashing.hashed(["a", "b", "c", "d", "e", "f"])) == hashing.shingles(["a", "b", "c", "d", "e", "f"])).all()


def test_spans_of_many_rows_at_once():
    """The same spans and equal runs as row by row, in a fraction of the calls of `counterpart`."""
    rng, a, b, want = np.random.default_rng(9), [], [], set()
    for i in range(600):
        x = rng.integers(-2**31, 2**31, rng.integers(30, 160)).astype(np.int32)
        y = x.copy()
        if i % 6 == 1:
            y = np.concatenate([y[:20], y[24:], y[:9]])  # shifted
        elif i % 6 == 2:
            y[rng.integers(0, len(y), 4)] = 7
        elif i % 6 == 3:
            y = rng.permutation(np.concatenate([y, y[:40]]))
        elif i % 6 == 4:
            y[:rng.integers(0, len(y))] = rng.integers(-2**31, 2**31)
        elif i % 6 == 5:
            x, y = np.tile(x[:25], 4), np.concatenate([y[:5], np.tile(x[:25], 5)])
        a.append(x)
        b.append(y)
        m = min(len(x), len(y))
        if m >= 46:
            want |= {(i, *s, False) for s in passages.spans(x, y, 46, 0.8)}
            edges = np.flatnonzero(np.diff(np.concatenate([[0], (x[:m] == y[:m]).view(np.int8), [0]])))
            want |= {(i, s, e, s, e, 1.0, True) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()) if e - s >= 46}
    sizes = [np.array([len(x) for x in part]) for part in (a, b)]
    got = passages.checked_spans(np.concatenate(a), sizes[0], np.concatenate(b), sizes[1], 46, 0.8)
    assert set(zip(*[x.tolist() for x in got])) == want and len(want) == len(got[0]) > 500
    empty = np.zeros(0, np.int32)
    assert [len(x) for x in passages.checked_spans(empty, np.zeros(1, np.int64), empty, np.zeros(1, np.int64), 46, 0.8)] == [0] * 7


def test_passages_leave_only_what_their_result_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stage, "work_folder", lambda _, name: f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}")
    shared = prose("shared", 80)
    docs = spark.createDataFrame([(i, f"{prose(f'l{i}', 30)} {shared} {prose(f'r{i}', 30)}") for i in range(6)], "d long, t string")
    out = passages.passages(docs, "d", "t")
    assert {x.name.split("-")[0] for x in tmp_path.iterdir()} == {"requests", "spans"}
    assert {r.id for r in out.collect()} == {1, 2, 3, 4, 5}


# ---- 6: quality ---------------------------------------------------------------------------------------

def quality_inputs(spark, folder=DATA):
    return spark.read.parquet(f"{folder}/documents.parquet"), quality.one_label(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "quality", "toxic")


def test_quality_on_held_out_documents(spark):
    docs, labels = quality_inputs(spark, "/root/testdata/sf0.1")
    held = labels.filter("id % 3 = 0")
    got = {r.id: r.keep for r in quality.classify(docs, labels.filter("id % 3 <> 0"), "doc_id", "text", "source", "lang").collect()}
    assert len(got) == docs.count()
    rows = held.collect()
    good, bad = [got[r.id] for r in rows if not r.low and not r.toxic], [got[r.id] for r in rows if r.low]
    insult = re.compile(r"\b(?:loser|idiot|pathetic|scum|worthless|moron|disgusting|clown|trash|stupid)\b")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    toxic = [got[r.id] for r in rows if r.toxic and len(insult.findall(texts[r.id].lower())) > 1]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05 and np.mean(toxic) < 0.05


def test_quality_edges(spark, odd, none):
    labels = quality_inputs(spark)[1]
    for some in (labels, labels.limit(0), labels.filter("low = 0 AND toxic = 0")):
        got = quality.classify(odd, some, "doc_id", "text", "source", "lang")
        assert got.count() == len(ODD) and got.filter("keep IS NULL").count() == 0
        kept = quality.keep_good(odd, some, "doc_id", "text", "source", "lang")
        assert kept.columns == odd.columns and kept.count() == got.filter("keep").count()
    assert quality.classify(none, labels, "doc_id", "text", "source", "lang").count() == 0
    assert quality.keep_good(none, labels, "doc_id", "text", "source", "lang").count() == 0


def test_labels(spark):
    rows = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (3, 1, 1), (None, 0, 0), (3, 1, 0)], "d long, q int, t int")
    assert sorted(tuple(r) for r in quality.one_label(rows, "d", "q", "t").collect()) == [(1, 1, 0), (3, 0, 1)]


def test_measures_see_the_whole_text():
    def bins(text):
        got = quality.shape(text, quality.WORDS.findall(text.lower()))
        return {k: v - quality._OFFSETS[k] for k, v in zip(quality.BINS, got)}

    own = [f"w{i}" for i in range(2000)]
    assert {bins(" ".join(own[:n]))["variety"] for n in (1, 399, 400, 401, 799, 800, 2000)} == {len(quality.BINS["variety"])}
    assert quality.variety(own[:400] + ["again"] * 4000 + own[400:800]) == pytest.approx((2 + 10 / 400) / 12)
    assert bins("BCDFG HJKLM PQUVW")["upper"] == bins("ÄÖÜ БВГ")["upper"] == len(quality.BINS["upper"]) and bins("bcdfg äöü")["upper"] == 0
    assert quality.cases("aBc D9") == (2, 2) and quality.cases("aBc Ä9ß") == (2, 3)


# ---- 7: SimHash ---------------------------------------------------------------------------------------

def test_masks_meet_at_four_bits():
    rng, masks = np.random.default_rng(1), np.array(sim.masks(), np.uint64)
    assert len(set(masks.tolist())) == len(masks)
    for _ in range(20000):
        bits = rng.choice(64, rng.integers(0, 5), replace=False)
        diff = np.uint64(sum(1 << int(b) for b in bits))
        assert ((masks & diff) == 0).any()


def check_groups(df):
    got = sim.groups(df, "doc_id", "text").collect()
    rows = df.select("doc_id", "text").collect()
    of = {r.text: simhash(r.text) for r in rows}
    values = sorted(set(of.values()))
    root = roots(values, near(values, 4))
    least = collections.defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            least[root[of[r.text]]].append(r.doc_id)
    want = collections.Counter((r.doc_id, of[r.text], min(least[root[of[r.text]]], default=None)) for r in rows)
    assert collections.Counter((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want
    return {r.text: root[of[r.text]] for r in rows}


def test_groups(spark, odd, none):
    for df in (odd, documents(spark)):
        group = check_groups(df)
        kept = sim.keep_one(df, "doc_id", "text")
        assert kept.columns == df.columns
        texts = [r.text for r in kept.select("text").collect()]
        assert sorted(group[t] for t in texts) == sorted(set(group.values()))
    assert sim.groups(none, "doc_id", "text").count() == 0 and sim.keep_one(none, "doc_id", "text").count() == 0


def test_links_over_chains_and_dense_groups(spark):
    rng = np.random.default_rng(4)
    values = {0}
    chain = 0
    for step in range(12):  # a chain of four bits each, around which many values lie
        chain ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        values |= {chain} | {chain ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (60, 2))}
    values |= {int(x) for x in rng.integers(0, 2**63, 200)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = sim.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    got = roots(signed, [(r.a, r.b) for r in found.collect()])
    want = roots(sorted(values), near(sorted(values), 4))
    assert len(set(got.values())) == len(set(want.values()))
    assert all((r.a ^ r.b).bit_count() <= 4 if (r.a ^ r.b) >= 0 else ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in found.collect())


# ---- 8: token ids -------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(spark, odd, name):
    path = public_tokenizers.path(name)
    own, tokenizer = tokenids.Encoder(path), Tokenizer.from_file(path)
    texts = [t or "" for _, t in ODD] + ["a  b", " a", "a ", "x\n y", "<|endoftext|> a <|endoftext|>b", "it's we'll 12½ ²", "\x1c a \x85 b", "a\u00a0 b", "é x", "\n\n", "a \t b"]
    texts += [r.text for r in documents(spark).select("text").limit(200).collect()]
    want = [struct.pack(f"<{len(i)}I", *i) for i in (tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]
    assert own.encode(texts) == want and own.encode(texts[::-1]) == want[::-1]


def test_token_files(spark, odd, none, tmp_path):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for k, df in enumerate((odd, documents(spark))):
        path = f"{tmp_path}/tokens{k}"
        got = tokenids.encoded(df, "doc_id", "text", tokenizer_path(), 2, path).orderBy("start").collect()
        ids = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            ids[r.doc_id].append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2])
        assert [r.key for r in got] == sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is not None, i))
        at = 0
        for r in got:
            assert r.start == at and r.indexed == (r.key is not None)
            match = [i for i in ids[r.key] if (len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))) == (r.n_tokens, r.ids_crc32)]
            ids[r.key].remove(match[0])
            at += r.n_tokens
        asked = spark.createDataFrame([(i,) for i in (1, 10, 11, 10, 10**9, None)], "key long")
        fetched = {r.key: bytes(r.ids) for r in tokenids.fetch(spark, path, asked).collect()}
        assert set(fetched) == {1, 10, 11}
        for r in df.filter("doc_id IN (1, 10, 11)").collect():
            i = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
            assert fetched[r.doc_id] == struct.pack(f"<{len(i)}I", *i)
    assert tokenids.encoded(none, "doc_id", "text", tokenizer_path(), 2).count() == 0


def test_blocks_hold_whole_documents(spark, monkeypatch, tmp_path):
    df = spark.range(300).select("id", F.concat(F.lit("word "), F.repeat(F.lit("again "), F.col("id").cast("int"))).alias("t"))
    from epitide.llm.tokenids import _blocks  # in this process, with small blocks

    monkeypatch.setattr(tokenids, "BLOCK_IDS", 500)
    monkeypatch.setattr(tokenids.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})()))
    import pyarrow as pa

    rows = df.collect()
    batch = pa.RecordBatch.from_pydict({"key": [r.id for r in rows], "text": [r.t for r in rows]})
    blocks = [b.to_pylist()[0] for b in _blocks(iter([batch]), tokenizer_path(), 2)]
    assert len(blocks) > 50 and [k for b in blocks for k in b["keys"]] == list(range(300))
    assert all(sum(b["lengths"]) == b["n_ids"] == len(b["payload"]) // 4 for b in blocks)
    assert [b["first"] for b in blocks] == np.cumsum([0, *[b["n_ids"] for b in blocks[:-1]]]).tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 30000])
def test_perfect_hash(n):
    h = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    pilots, slots = tokenids.build_pilots(h)
    assert sorted(slots.tolist()) == list(range(n))
    if n:
        assert (tokenids.find_slots(h, pilots, n) == slots).all()


# ---- 9: sharding --------------------------------------------------------------------------------------

def expected_shard(key, weights, seed=0):
    def one(i, w):
        h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42) if key is not None else 42
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), h)
        return -w / np.log(((h >> 12) + 0.5) / 2**52), i

    return max(one(i, w) for i, w in enumerate(weights) if w > 0)[1]


def test_slots(spark, odd, none):
    for df in (odd, documents(spark)):
        got = sharding.slots(df, "doc_id", "text", [1.0] * 24).collect()
        rows = df.select("doc_id", "text").collect()
        raw = [(r.doc_id, (r.text or "").encode()) for r in rows]
        assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len(t) + 8, zlib.crc32(t)) for i, t in raw)
        by = collections.defaultdict(list)
        for r in got:
            assert r.law == "key" and r.shard == expected_shard(r.doc_id, [1.0] * 24) and r.grown_shard in (r.shard, 24)
            assert r.grown_shard == expected_shard(r.doc_id, [1.0] * 25)
            by[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.slots(none, "doc_id", "text", [1.0] * 24).count() == 0


def test_weights_and_files(spark, odd, tmp_path):
    ids = spark.range(20000)
    got = {r.shard: r["count"] for r in sharding.assign(ids, "id", [1.0, 2.0, 0.0, 5.0]).groupBy("shard").count().collect()}
    assert set(got) == {0, 1, 3} and got[0] == pytest.approx(2500, rel=0.1) and got[1] == pytest.approx(5000, rel=0.1)
    path = f"{tmp_path}/shards"
    sharding.write_shards(odd.drop("shard"), "doc_id", [1.0] * 4, path)
    back = spark.read.parquet(path)
    assert back.count() == len(ODD) and all(r.shard == expected_shard(r.doc_id, [1.0] * 4) for r in back.select("doc_id", "shard").collect())
    with pytest.raises(ValueError):
        sharding.assign(odd, "doc_id", [1.0])


# ---- 10: decontamination ------------------------------------------------------------------------------

def test_block_masks():
    assert sum(decontaminate.block_masks()) == (1 << 64) - 1 and len(decontaminate.block_masks()) == decontaminate.RADIUS + 1


@pytest.mark.parametrize("chunk", [decontaminate.CHUNK, 300])
def test_decontamination(spark, odd, none, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK", chunk)
    w = PASSAGE.split()
    odd_items = [(1, PASSAGE), (2, " ".join(w[:40])), (3, " ".join(w[:30] + ["else"] + w[31:60])), (4, None), (5, ""), (6, "word"), (7, "two, words!"), (None, " ".join(w[5:30])), (1, PASSAGE),
                 (8, prose(2, 60) + " and a few more")]
    items = spark.createDataFrame([(i, t, "s", 1) for i, t in odd_items], "item_id long, text string, size string, fp int")
    got = decontaminate.matches(odd, items, "doc_id", "text", "item_id", "text").collect()
    docs = [(str(i) if i is not None else None, t) for i, t in ODD]
    want = leaks(list(enumerate(t for _, t in docs)), [(k, t) for k, (_, t) in enumerate(odd_items)])
    expected = {}
    for (d, i), s in want.items():
        k = docs[d][0], odd_items[i][0]
        expected[k] = max(s, expected.get(k, 0))
    assert {(str(r.id) if r.id is not None else None, r.item): r.similarity for r in got} == pytest.approx(expected)
    clean = decontaminate.keep_clean(odd, items, "doc_id", "text", "item_id", "text")
    hit = {d for d, _ in want}
    assert clean.columns == odd.columns and clean.count() == len(ODD) - len(hit)
    assert decontaminate.matches(none, items, "doc_id", "text", "item_id", "text").count() == 0
    assert decontaminate.keep_clean(odd, items.limit(0), "doc_id", "text", "item_id", "text").count() == len(ODD)


def test_decontamination_of_the_corpus(spark):
    docs, items = documents(spark), spark.read.parquet(f"{DATA}/benchmark.parquet")
    got = {(r.id, r.item): r.similarity for r in decontaminate.matches(docs, items, "doc_id", "text", "item_id", "text").collect()}
    assert got == pytest.approx(leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))


# ---- queries ------------------------------------------------------------------------------------------

def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(SQL) <= set(QUERIES)
    assert lowered("ÄAz") == "Äaz"
