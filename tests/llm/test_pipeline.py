"""Each stage of the pipeline on what the one before kept."""

import collections
import struct
import zlib

from brute import leaks, near, roots, simhash, words
from odd_rows import DATA, none, odd  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from epitide.llm.queries import tokenizer_path
from epitide.sources.stage import settle


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_ids"]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, DATA), name)
        rows = docs.collect()
        if name != "token_ids":
            assert docs.columns == columns and {tuple(r) for r in rows} <= {tuple(r) for r in before}
        if name == "quality":
            ids = {r.doc_id for r in rows}
            assert sum(i in ids for i, l in labels.items() if l == (1, 0)) >= 0.98 * sum(l == (1, 0) for l in labels.values())
            assert sum(i in ids for i, l in labels.items() if l[0] == 0) <= 0.1 * sum(l[0] == 0 for l in labels.values())
        elif name == "near_duplicates":
            of = {r.doc_id: simhash(r.text) for r in before}
            values = sorted(set(of.values()))
            root = roots(values, near(values, 4))
            least = {}
            for i in sorted(of, reverse=True):
                least[root[of[i]]] = i
            assert sorted(r.doc_id for r in rows) == sorted(least.values())
        elif name == "decontamination":
            hit = {d for d, _ in leaks([(r.doc_id, r.text) for r in before], items)}
            assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in before if r.doc_id not in hit)
        elif name == "mixing":
            copies, size = collections.Counter(r.doc_id for r in rows), collections.Counter()
            assert max(copies.values()) <= 3
            for r in rows:
                size[r.source] += len(words(r.text))
            assert abs(sum(size.values()) / sum(len(words(r.text)) for r in before) - 1) < 0.2
        else:
            tokenizer, at = Tokenizer.from_file(tokenizer_path()), 0
            rows.sort(key=lambda r: r.start)
            texts = {r.doc_id: r.text for r in before}
            assert [r.doc_id for r in rows] == sorted(r.doc_id for r in before)
            for r in rows:
                ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
                assert (r.start, r.n_tokens, r.ids_crc32, r.indexed) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), True)
                at += len(ids)
        before = rows


def test_stages_on_odd_rows_and_on_nothing(spark, odd, none):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(columns), none.select(columns)):
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, DATA), name)
            assert name == "token_ids" or docs.columns == columns
        rows = docs.collect()
        assert sorted(r.start for r in rows) == [sum(x.n_tokens for x in rows if x.start < r.start) for r in sorted(rows, key=lambda r: r.start)]
