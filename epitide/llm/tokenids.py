"""Token ids in binary shards with a minimal perfect hash index over the document keys.

A written folder holds two tables:

* `payload`: one row per block of whole documents in key order: shard, block, first (ids of the shard before the block),
  n_ids, n_docs, keys, lengths (ids per document, the end id included) and payload, the raw ids as little-endian
  unsigned 32-bit integers one after the other. A block closes at BLOCK_IDS ids or BLOCK_DOCS documents.
* `index`: one row per part of the distinct keys, dealt by a hash: n, pilots, and per slot a 32-bit fingerprint of the key,
  shard, block and position of its first document, and the number of documents that share it. A key's hash gives its
  part and bucket, the bucket's pilot its slot; a key that was never written fails the fingerprint (but for 2^-32).

Both are Parquet tables written by Spark's committer, so a lost or repeated task leaves no half-written shard and any
store that Spark reaches will do. Documents are dealt by ranges of (key, text hash, row position), so that neither one
key nor one text can make a shard large.

Defined cases: a null or empty text has only its end id; null keys come first, are written and are not indexed;
documents that repeat a key stand next to each other; an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epitide.llm.common import batches_of, pick, small_batches
from epitide.sources.stage import work_folder

BLOCK_IDS = 1 << 18
BLOCK_DOCS = 1 << 14
PART_KEYS = 1 << 16   # keys of one part of the index, about
KNOWN = 250_000       # chunks whose ids a worker remembers, per generation
SPACE = "\u0120"        # how byte-level vocabularies write a space

PAYLOAD = ("shard int, block int, first bigint, n_ids bigint, n_docs int, keys array<bigint>, lengths array<int>, payload binary")
INDEX = ("part int, n int, pilots binary, fingerprints binary, shards array<int>, blocks array<int>, positions array<int>, "
         "copies array<bigint>")


# ---- ids of texts ---------------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts as bytes, by the tokenizers library.

    With a byte-level pre-tokenizer a text falls apart before every single space between two words, and ids do not depend
    on what stands around such a chunk, so that only chunks not met lately are encoded. Where white space meets white
    space chunks are not independent: these texts are encoded whole, as are texts with a special token's name and all
    texts for tokenizers of another kind. Chunks are remembered in two generations, of which the older is dropped whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        before, special = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        self.by_chunk = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                         and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))
        self.special = tuple(t["content"] for t in special)
        self.known, self.old = {}, {}
        names = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(names.values()) + 1, bool)  # ids of tokens that begin with a space
        self.spaced[[i for name, i in names.items() if name.startswith(SPACE)]] = True

    def _pack(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(i)}I", *i) for i in (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))]

    def _pack_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each after a space: encoded as one text, which comes apart where a token begins with a space."""
        out = []
        for at in range(0, len(chunks), 512):
            part = chunks[at:at + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            if len(cuts) == len(part):
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
            else:
                out += self._pack([" " + c for c in part])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_chunk:
            return self._pack(texts)
        if len(self.known) > KNOWN:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        whole, split, found, gaps, new = [], [], [], [], {}
        for i, text in enumerate(texts):
            chunks = text.split(" ")
            ids = list(map(known.get, chunks))
            ids[0] = None  # the first chunk has no space before it
            if not all(chunks) or any(s in text for s in self.special):
                whole.append(i)
                split.append(None)
                found.append(None)
                continue
            at, open_ = 0, []
            try:
                while True:
                    at = ids.index(None, at + 1)
                    chunk = chunks[at]
                    ids[at] = got = old.get(chunk)
                    if got is None:
                        new[chunk] = None
                        open_.append(at)
                    else:
                        known[chunk] = got
            except ValueError:
                pass
            split.append(chunks)
            found.append(ids)
            gaps.append((i, open_))
        if new:
            # A chunk that begins or ends in white space cannot stand alone.
            alone = [c for c in new if not (c[0].isspace() or c[-1].isspace())]
            new.update(zip(alone, self._pack_chunks(alone)))
            known.update((c, ids) for c, ids in new.items() if ids is not None)
        out = [b""] * len(texts)
        first = self._pack([split[i][0] for i, _ in gaps])
        for (i, open_), ids in zip(gaps, first):
            chunks, parts = split[i], found[i]
            parts[0] = ids
            for at in open_:
                parts[at] = new[chunks[at]]
            if chunks[0][0].isspace() or chunks[0][-1].isspace() or None in parts:
                whole.append(i)
            else:
                out[i] = b"".join(parts)
        for i, ids in zip(whole, self._pack([texts[i] for i in whole])):
            out[i] = ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept over tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- writing --------------------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(tokenizer).encode, struct.pack("<I", end_id)
    shard, block, first = TaskContext.get().partitionId(), 0, 0
    keys, lengths, pieces, held = [], [], [], 0
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int32()),
                        ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("payload", pa.binary())])

    def closed():
        row = [[shard], [block], [first], [held], [len(keys)], [keys], [lengths], [b"".join(pieces)]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

    for batch in batches_of(batches):
        for key, ids in zip(batch.column("key").to_pylist(), encode([t or "" for t in batch.column("text").to_pylist()])):
            n = len(ids) // 4 + 1
            if keys and (held + n > BLOCK_IDS or len(keys) >= BLOCK_DOCS):
                yield closed()
                block, first = block + 1, first + held
                keys, lengths, pieces, held = [], [], [], 0
            keys.append(key)
            lengths.append(n)
            pieces += (ids, end)
            held += n
    if keys:
        yield closed()


def write(df: DataFrame, key: str, text: str, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every text and write the folder described above."""
    spark = df.sparkSession
    rows = pick(df, key=key, text=text).select(
        F.col("key").cast("bigint").alias("key"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("at"))
    dealt = rows.repartitionByRange("key", "h", "at").sortWithinPartitions("key", "h", "at").select("key", "text")
    with small_batches(spark):
        dealt.mapInArrow(lambda b: _blocks(b, tokenizer, end_id), PAYLOAD).write.option("compression", "zstd").parquet(f"{path}/payload")
    payload = read_payload(spark, path)
    docs = payload.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    firsts = payload.select("shard", "block", F.posexplode("keys").alias("position", "key")).filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("shard", "block", "position")).alias("at"), F.count("*").alias("copies"))
    parts = max(1, -(-docs // PART_KEYS))
    dealt = firsts.select(part_of(parts), "key", key_hash(), fingerprint(), "at.*", "copies")
    dealt.groupBy("part").applyInPandas(_index, INDEX).withColumn("parts", F.lit(parts)).write.parquet(f"{path}/index")


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).parquet(f"{path}/payload")


# ---- the index ------------------------------------------------------------------------------------

def part_of(parts: int):
    return F.pmod(F.xxhash64("key", F.lit(1)), F.lit(parts)).cast("int").alias("part")


def key_hash():
    return F.xxhash64("key").alias("hash")


def fingerprint():
    return F.shiftrightunsigned(F.xxhash64("key", F.lit(2)), 32).alias("fp")


def _mixed(h: np.ndarray, pilot) -> np.ndarray:
    """A 64-bit finaliser over hash and pilot."""
    with np.errstate(over="ignore"):
        x = h + np.asarray(pilot).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_pilots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pilots, slots): a pilot per bucket of about four keys, and the slot 0..n-1 of each key, none taken twice.

    Large buckets search first, all of one size together: with each pilot those settle whose slots are free and not wanted
    by an earlier bucket. A bucket of one key needs no search: its pilot names a free slot, as -1 - slot.
    """
    n = len(h)
    if len(np.unique(h)) < n:
        raise ValueError("two keys of one hash")
    m = max(1, -(-n // 4))
    bucket = (_mixed(h, 0) % np.uint64(m)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=m)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    pilots, slots, taken = np.zeros(m, np.int32), np.zeros(n, np.int64), np.zeros(n, bool)
    for size in sorted(set(sizes[sizes > 1].tolist()), reverse=True):
        open_, pilot = np.flatnonzero(sizes == size), 0
        members = order[starts[open_][:, None] + np.arange(size)]
        while len(open_):
            pilot += 1
            places = (_mixed(h[members], pilot) % np.uint64(n)).astype(np.int64)
            fits = np.flatnonzero(~taken[places].any(axis=1))
            first = np.unique(places[fits], return_index=True)[1]
            owned = np.zeros(len(fits) * size, bool)
            owned[first] = True  # of several that want a slot, the first
            fits = fits[owned.reshape(-1, size).all(axis=1)]
            pilots[open_[fits]] = pilot
            slots[members[fits]] = places[fits]
            taken[places[fits]] = True
            stay = np.ones(len(open_), bool)
            stay[fits] = False
            open_, members = open_[stay], members[stay]
    free = iter(np.flatnonzero(~taken).tolist())
    for b in np.flatnonzero(sizes == 1):
        slot = next(free)
        pilots[b], slots[order[starts[b]]] = -1 - slot, slot
    return pilots, slots


def find_slots(h: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    pilot = pilots[(_mixed(h, 0) % np.uint64(len(pilots))).astype(np.int64)].astype(np.int64)
    return np.where(pilot < 0, -1 - pilot, (_mixed(h, np.maximum(pilot, 0)) % np.uint64(n)).astype(np.int64))


def _index(pdf: pd.DataFrame) -> pd.DataFrame:
    pilots, slots = build_pilots(pdf["hash"].to_numpy().view(np.uint64))
    by_slot = pdf.iloc[np.argsort(slots)]
    return pd.DataFrame({
        "part": [int(pdf["part"].iloc[0])], "n": [len(pdf)], "pilots": [pilots.astype("<i4").tobytes()],
        "fingerprints": [by_slot["fp"].to_numpy().astype("<u4").tobytes()], "shards": [by_slot["shard"].to_numpy()],
        "blocks": [by_slot["block"].to_numpy()], "positions": [by_slot["position"].to_numpy()], "copies": [by_slot["copies"].to_numpy()]})


def _found(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    columns = ["key", "slot", "shard", "block", "position", "copies"]
    if keys.empty or index.empty:
        return pd.DataFrame(columns=columns)
    row = index.iloc[0]
    pilots, prints = np.frombuffer(row["pilots"], "<i4"), np.frombuffer(row["fingerprints"], "<u4")
    slot = find_slots(keys["hash"].to_numpy().view(np.uint64), pilots, int(row["n"]))
    hit = prints[slot] == keys["fp"].to_numpy().astype(np.uint32)
    slot = slot[hit]
    got = [np.asarray(row[c])[slot] for c in ("shards", "blocks", "positions", "copies")]
    return pd.DataFrame(dict(zip(columns, [keys["key"].to_numpy()[hit], slot, *got])))


def locate(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(key, slot, shard, block, position, copies) of the distinct keys that the index knows; `keys` has a column key."""
    index = spark.read.schema(INDEX + ", parts int").parquet(f"{path}/index")
    parts = index.agg(F.max("parts")).first()[0] or 1
    asked = keys.filter("key IS NOT NULL").select("key").distinct().select(part_of(parts), "key", key_hash(), fingerprint())
    return asked.groupBy("part").cogroup(index.drop("parts").groupBy("part")).applyInPandas(
        _found, "key bigint, slot int, shard int, block int, position int, copies bigint")


def fetch(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(key, ids) of the first document of each known key: the index names block and position, the block is cut there."""
    at = locate(spark, path, keys)
    blocks = read_payload(spark, path).select(F.col("shard").alias("s"), F.col("block").alias("b"), "lengths", "payload")
    start = F.aggregate(F.slice("lengths", 1, F.col("position")), F.lit(0), lambda a, n: a + n)
    bytes_ = F.call_function("substring", F.col("payload"), start * 4 + 1, F.get("lengths", F.col("position")) * 4)
    return at.join(blocks, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b"))).select("key", bytes_.alias("ids"))


# ---- reading --------------------------------------------------------------------------------------

READ = "key bigint, shard int, block int, position int, first bigint, n_tokens bigint, ids_crc32 bigint"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["key", "shard", "block", "position", "first", "n_tokens", "ids_crc32"]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            lengths = np.asarray(row["lengths"].as_py(), np.int64)
            ends = np.cumsum(lengths)
            data = memoryview(row["payload"].as_buffer())
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            n = len(lengths)
            values = [row["keys"].values, np.full(n, row["shard"].as_py()), np.full(n, row["block"].as_py()), np.arange(n),
                      row["first"].as_py() + ends - lengths, lengths, np.asarray(sums, np.int64)]
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types)], names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(key, shard, block, position, start, n_tokens, ids_crc32) of every document, from the payload's own bytes."""
    payload = read_payload(spark, path)
    docs = payload.select("shard", "block", "first", "keys", "lengths", "payload").mapInArrow(_read, READ)
    shards = payload.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return docs.join(bases, "shard").withColumn("start", F.col("base") + F.col("first")).drop("base", "first")


def encoded(df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the folder, read it back: (key, start, n_tokens, ids_crc32, indexed), one row per document.

    indexed: the index leads from the key to this document or the first of those that share its key.
    """
    spark = df.sparkSession
    path = path or work_folder(spark, "tokens")
    write(df, key, text, path, tokenizer, end_id)
    docs = read_documents(spark, path)
    keys = read_payload(spark, path).select(F.explode("keys").alias("key"))
    known = locate(spark, path, keys).select(F.col("key").alias("k"), F.struct("shard", "block", "position").alias("at"))
    own = F.struct("shard", "block", "position")
    return docs.join(known, F.col("key") == F.col("k"), "left").select(
        "key", "start", "n_tokens", "ids_crc32", F.coalesce(F.col("at") <= own, F.lit(False)).alias("indexed"))
