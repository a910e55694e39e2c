"""One registered query per operator of this subpackage, with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitide.llm import decontaminate, katz, merkle, mixing, negatives, passages, quality, sharding, simhash, tokencount, tokenids, urlfilter, vectors

QUERIES: dict = {}
SQL: dict[str, str] = {}

# The rules of the URL query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def query(sql: str | None = None):
    def wrap(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build
    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- 1: token counts ------------------------------------------------------------------------------

@query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokencount.token_counts(table(spark, folder, "documents"), "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


# ---- 2: mixing ------------------------------------------------------------------------------------

def mix_step(i: int) -> str:
    """One class of pieces drawn, and what the source has missed so far."""
    return f"""size{i} AS (SELECT *, CAST(COALESCE(MAX(CASE WHEN level = {i} THEN whole_level END) OVER (PARTITION BY source), 0) AS DOUBLE) AS level_size,
  middle + CAST('0x' || SUBSTR(MD5('{mixing.SEED}:' || COALESCE(source, 'null') || ':{i}'), 1, 13) AS BIGINT) / 4503599627370496.0 AS turned FROM step{i}),
share{i} AS (SELECT * REPLACE (CASE WHEN level = {i} THEN CAST(turned - floor(turned)
  < greatest(0::DOUBLE, least(1::DOUBLE, CASE WHEN level_size > 0 THEN part - missed / level_size ELSE part END)) AS BIGINT) ELSE taken END AS taken) FROM size{i}),
step{i + 1} AS (SELECT * EXCLUDE (level_size, turned) REPLACE (
  missed + (CAST(SUM(CASE WHEN level = {i} THEN words * taken ELSE 0 END) OVER (PARTITION BY source) AS DOUBLE) - part * level_size) AS missed) FROM share{i})"""


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
recipe AS (SELECT *, CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM sums),
met AS (SELECT *, 3 * source_size / weight AS meets FROM recipe),
steps AS (
  SELECT *, ROW_NUMBER() OVER o AS place,
    CAST(COALESCE(SUM(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent,
    SUM(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    CAST(SUM(source_size) OVER () AS BIGINT) AS total
  FROM met WINDOW o AS (ORDER BY meets, source NULLS LAST)),
leveled AS (SELECT *, CAST(total - spent AS DOUBLE) / open AS level FROM steps),
first_open AS (SELECT place, level FROM leveled WHERE level <= meets ORDER BY place LIMIT 1),
goals AS (
  SELECT l.source, l.source_size,
    CASE WHEN f.place IS NULL OR l.place < f.place THEN CAST(3 * l.source_size AS DOUBLE) ELSE l.weight * f.level END AS target
  FROM leveled l LEFT JOIN first_open f ON TRUE),
placed AS (
  SELECT doc_id, source, size,
    CAST(floor(CAST('0x' || SUBSTR(MD5('{mixing.SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || size), 1, 13) AS BIGINT)
      / 4503599627370496.0 * {mixing.PIECES}) AS BIGINT) AS piece FROM sized),
pieces AS (SELECT source, piece, CAST(SUM(size) AS BIGINT) AS words FROM placed GROUP BY ALL),
rated AS (
  SELECT p.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN least(g.target / g.source_size, {mixing.CAP}::DOUBLE) ELSE 0::DOUBLE END AS rate,
    CASE {" ".join(f"WHEN words * {n} >= g.source_size THEN {i}" for i, n in enumerate(mixing.CLASSES))} ELSE {len(mixing.CLASSES)} END AS level
  FROM pieces p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source),
laid AS (
  SELECT *, rate - floor(rate) AS part, CAST(SUM(words) OVER (PARTITION BY source, level) AS BIGINT) AS whole_level,
    CAST(SUM(words) OVER (PARTITION BY source, level ORDER BY piece) AS BIGINT) AS upto FROM rated),
step0 AS (SELECT *, CASE WHEN whole_level > 0 THEN CAST(2 * upto - words AS DOUBLE) / CAST(2 * whole_level AS DOUBLE) ELSE 0::DOUBLE END AS middle,
  0::DOUBLE AS missed, CAST(0 AS BIGINT) AS taken FROM laid),
{", ".join(mix_step(i) for i in range(len(mixing.CLASSES) + 1))}
SELECT d.doc_id, d.size, s.source_size, s.target, CAST(d.size * (floor(s.rate) + s.taken) AS BIGINT) AS taken
FROM placed d JOIN step{len(mixing.CLASSES) + 1} s ON d.piece = s.piece AND d.source IS NOT DISTINCT FROM s.source"""


@query(MIX_SQL)
def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


# ---- 3: URL filters -------------------------------------------------------------------------------

def url_sql(depth: int = 6) -> str:
    """`depth` bounds the levels of the tree that the text can follow."""
    u = urlfilter
    fits = []
    for text, what in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        name, slash, start = text.partition("/")
        fits.append((f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{start}')", text, what))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{w}'" for c, _, w in fits) + " END"
    band = " + ".join(f"CASE WHEN (bad + 0.5::DOUBLE) / (lab + 1::DOUBLE) >= {cut}::DOUBLE THEN 1 ELSE 0 END" for cut in u.BANDS)
    ctes, last = [], "l0"
    for i in range(depth):
        ctes.append(f"""c{i} AS (SELECT host, template, steps[{i + 1}] AS seg, COUNT(*) AS n, COUNT(bad) AS lab, COALESCE(SUM(bad), 0) AS bad
  FROM {last} WHERE NOT ended AND len(steps) > {i} GROUP BY ALL),
p{i} AS (SELECT host, template, SUM(lab) AS all_lab, SUM(bad) AS all_bad FROM c{i} GROUP BY ALL HAVING SUM(bad) > 0 AND SUM(bad) < SUM(lab)),
r{i} AS (SELECT host, template, c.seg, CAST(c.lab AS DOUBLE) AS lab, CAST(c.bad AS DOUBLE) AS bad, CAST(all_lab AS DOUBLE) AS all_lab, CAST(all_bad AS DOUBLE) AS all_bad
  FROM c{i} c JOIN p{i} USING (host, template)
  WHERE c.n >= {u.SUPPORT} AND c.lab > 0 AND NOT regexp_matches(c.seg, '^[0-9]+([.][A-Za-z0-9]+)?$')),
b{i} AS (SELECT host, template, seg, {band} AS band FROM (SELECT *, all_bad / all_lab AS pool FROM r{i} WHERE all_lab > lab)
  WHERE abs(bad / lab - (all_bad - bad) / (all_lab - lab)) > {u.Z}::DOUBLE * sqrt(pool * (1 - pool) * (1 / lab + 1 / (all_lab - lab)))),
k{i} AS (SELECT host, template, seg, replace(replace(replace(MIN(seg) OVER w, '%', '%25'), '*', '%2A'), '+', '%2B') || CASE WHEN COUNT(*) OVER w > 1 THEN '+' ELSE '' END AS name
  FROM b{i} WINDOW w AS (PARTITION BY host, template, band)),
o{i} AS (SELECT DISTINCT host, template, TRUE AS going FROM r{i}),
l{i + 1} AS (SELECT l.* REPLACE (
    CASE WHEN ended THEN l.template WHEN going AND len(steps) > {i} THEN l.template || '/' || COALESCE(k.name, '*')
      ELSE l.template || CASE WHEN len(steps) > {i + 1} THEN '/**' WHEN len(steps) = {i + 1} THEN '/*' ELSE '' END END AS template,
    (ended OR going IS NULL OR len(steps) <= {i}) AS ended)
  FROM {last} l LEFT JOIN o{i} o ON l.host = o.host AND l.template = o.template LEFT JOIN k{i} k ON l.host = k.host AND l.template = k.template AND k.seg = l.steps[{i + 1}])""")
        last = f"l{i + 1}"
    return f"""
WITH raw AS (SELECT page_id, regexp_extract(COALESCE(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
cut AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), '{u.UPPER}', '{u.LOWER}') AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM raw),
known AS (SELECT doc_id, MAX(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
l0 AS (SELECT c.*, k.bad, list_filter(string_split(path, '/'), lambda s: s <> '') AS steps, '' AS template, FALSE AS ended
  FROM cut c LEFT JOIN known k ON k.doc_id = TRY_CAST(NULLIF(regexp_extract(path, '/([0-9]+)(?:[/.][^/]*)?$', 1), '') AS BIGINT)),
{", ".join(ctes)},
found AS (SELECT page_id, host, path, bad, template FROM {last}),
cells AS (SELECT host, template, COUNT(bad) AS lab, CAST(COALESCE(SUM(bad), 0) AS BIGINT) AS bad FROM found GROUP BY ALL),
hosts AS (SELECT host, SUM(lab) AS lab, SUM(bad) AS bad FROM cells GROUP BY host),
base AS (SELECT CASE WHEN SUM(lab) > 0 THEN CAST(SUM(bad) AS DOUBLE) / CAST(SUM(lab) AS DOUBLE) ELSE 0 END AS base FROM cells),
pure AS (SELECT c.host, c.template, (c.bad + {u.STRENGTH}::DOUBLE * ((h.bad + {u.STRENGTH}::DOUBLE * base) / (h.lab + {u.STRENGTH}::DOUBLE))) / (c.lab + {u.STRENGTH}::DOUBLE) AS bad_share
  FROM cells c JOIN hosts h USING (host), base),
judged AS (SELECT *, {rule} AS rule, {verdict} AS given FROM found JOIN pure USING (host, template))
SELECT page_id, host, path, rule, COALESCE(given, CASE WHEN bad_share >= {u.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, template, round(bad_share, 9) AS bad_share
FROM judged"""


@query(url_sql())
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A page is bad where the document that its path names last is labelled low or toxic."""
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    number = F.regexp_extract(urlfilter.parts(F.col("url"))[1], r"/([0-9]+)(?:[/.][^/]*)?$", 1).try_cast("bigint")
    rows = pages.select(F.col("page_id").alias("id"), "url", number.alias("doc_id")).join(known, "doc_id", "left")
    return urlfilter.judge(rows, RULES).select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "template", F.round("bad_share", 9).alias("bad_share"))


# ---- 9: sharding ----------------------------------------------------------------------------------

@query()
def op9_rendezvous_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.slots(table(spark, folder, "documents"), "doc_id", "text", [1.0] * 24)


# ---- 4: vectors -----------------------------------------------------------------------------------

@query()
def op4_vector_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding").withColumnRenamed("id", "vec_id")


# ---- 5: passages ----------------------------------------------------------------------------------

@query()
def op5_passage_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return passages.passages(table(spark, folder, "documents"), "doc_id", "text").withColumnsRenamed(
        {"id": "doc_id", "rep_id": "rep_doc_id"})


# ---- 6: quality -----------------------------------------------------------------------------------

@query()
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The site of a document is its source (host) and its language below it (path)."""
    labels = quality.one_label(table(spark, folder, "labels"), "doc_id", "quality", "toxic")
    return quality.classify(table(spark, folder, "documents"), labels, "doc_id", "text", "source", "lang").withColumnRenamed("id", "doc_id")


# ---- 7: SimHash -----------------------------------------------------------------------------------

@query()
def op7_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(table(spark, folder, "documents"), "doc_id", "text").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# ---- 8: token ids ---------------------------------------------------------------------------------

END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op8_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenids.encoded(table(spark, folder, "documents"), "doc_id", "text", tokenizer_path(), END_ID).withColumnRenamed("key", "doc_id")


# ---- 10: decontamination --------------------------------------------------------------------------

@query()
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), "doc_id", "text", "item_id", "text").select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "n_words", "similarity")


# ---- 11: language model ---------------------------------------------------------------------------

@query()
def op11_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.scores(table(spark, folder, "documents"), "doc_id", "text", held).withColumnRenamed("id", "doc_id")


# ---- 12: hard negatives ---------------------------------------------------------------------------

HARD_SQL = """
WITH ints AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM ints a JOIN ints b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
hard AS (SELECT p.*, n.id AS negative_id, n.score AS negative_score FROM positives p
  JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(row_number() OVER o AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM hard WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) QUALIFY row_number() OVER o <= 5"""


@query(HARD_SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), "vec_id", label, "embedding", F.col("vec_id") % 100 == 0)


# ---- 13: manifest ---------------------------------------------------------------------------------

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The letters that tampering changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def manifest_sql(levels: int = 10, groups: int = 4) -> str:
    """`levels` and `groups` bound the heights of a language's tree and of the upper tree that the text can follow (8^levels rows)."""
    def leaf(text: str) -> str:
        cells = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
        return "sha256(" + " || ".join(f"COALESCE(strlen({c}) || ':' || {c}, '-')" for c in cells) + ")"

    def climb(base: str, part: str, height: int) -> list[str]:
        out = []
        for k in range(height):
            out.append(f"""{base}{k}k AS (SELECT g, i // 8 AS run, list(node ORDER BY i) AS kids, COUNT(*) AS many, ANY_VALUE(n) AS n FROM {base}{k} GROUP BY g, i // 8)""")
            out.append(f"""{base}{k + 1} AS (SELECT g, run AS i, sha256(array_to_string(kids, '')) AS node, (n + 7) // 8 AS n FROM {base}{k}k WHERE n > 1)""")
        return out

    def sides(base: str, k: int) -> tuple[str, str]:
        kids, slot = f"{base}{k}k.kids", f"(({{i}} // {8 ** k}) % 8)"
        return (f"array_to_string(list_slice({kids}, 1, CAST({slot} AS BIGINT)), '')", f"array_to_string(list_slice({kids}, CAST({slot} AS BIGINT) + 2, 8), '')")

    def steps(base: str, height: int, rows: str, start: str, keep: str) -> tuple[list[str], str]:
        out, last = [], rows
        for k in range(height):
            left, right = (s.format(i="p.i") for s in sides(base, k))
            out.append(f"""{rows}{k}s AS (SELECT p.* REPLACE (
    CASE WHEN {base}{k}k.n > 1 THEN sha256({left} || p.folded || {right}) ELSE p.folded END AS folded,
    CASE WHEN {base}{k}k.n > 1 THEN p.beside || {left} || {right} ELSE p.beside END AS beside)
  FROM {last} p LEFT JOIN {base}{k}k ON {base}{k}k.g = p.g AND {base}{k}k.run = p.i // {8 ** (k + 1)})""")
            last = f"{rows}{k}s"
        return out, last

    low = f"translate(text, '{UPPER}', '{LOWER}')"
    first, after = steps("t", levels, "p", "folded", "beside")
    second, done = steps("u", groups, "q", "folded", "beside")
    return f"""
WITH crc(t) AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))),
hashed AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {leaf('text')} AS leaf, {leaf(low)} AS shown,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda k: CAST(ascii(substr(CAST(doc_id AS VARCHAR), k, 1)) AS BIGINT))),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
  FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, COUNT(*) OVER (PARTITION BY g) AS n FROM hashed),
t0 AS (SELECT g, i, leaf AS node, n FROM leaves),
{", ".join(climb("t", "g", levels))},
subs AS ({" UNION ALL ".join(f"SELECT g, node FROM t{k} WHERE n = 1" for k in range(levels + 1))}),
named AS (SELECT g AS name, node, row_number() OVER (ORDER BY g) - 1 AS i, COUNT(*) OVER () AS n FROM subs),
u0 AS (SELECT '' AS g, i, node, n FROM named),
{", ".join(climb("u", "g", groups))},
top AS ({" UNION ALL ".join(f"SELECT node AS root FROM u{k} WHERE n = 1" for k in range(groups + 1))}),
p AS (SELECT *, CASE WHEN crc % 3 = 0 THEN shown ELSE leaf END AS folded, '' AS beside FROM leaves),
{", ".join(first)},
q AS (SELECT p.doc_id, p.leaf, named.node AS subroot, '' AS g, named.i AS i, p.folded, p.beside FROM {after} p JOIN named ON named.name = p.g),
{", ".join(second)}
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM {done}, top"""


@query(manifest_sql())
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    own = {f: F.col(f) for f in FIELDS}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(table(spark, folder, "documents"), "doc_id", "lang", own, {"text": F.translate("text", UPPER, LOWER)}, changed)
