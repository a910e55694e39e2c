"""Joining dirty names to a dimension: exact, then fuzzy on the distinct unmatched names only.

Candidate pairs come from an equi-join on rare character grams rather than a product of the two name lists.
A score of at least the cutoff bounds the number of edits by some k, and an edit touches q grams of length
q at most. If both names put their grams in one order, the rarest first, then two names within k edits share
a gram among the first k q + 1 of each, at places not more than k apart: so only that prefix is joined, and
no pair that could reach the cutoff is lost. From LONG_PIECES on k is so small that the key can be cut into
k + 1 long pieces instead, one of which must occur in the name as it is, which needs no counting of grams;
below a cutoff of one half, where grams promise nothing, the pieces are short but still lose nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitide.functions.scalar import strip_prefixes, strip_suffixes
from epitide.sources.stage import settle

CUTOFF = 0.74
LONG_PIECES = CUTOFF
EPS = 1e-9


# ---- scores -----------------------------------------------------------------------------------

def edit_similarity(word: Column, candidate: Column) -> Column:
    """1 - Levenshtein distance / longer length; stays in the JVM."""
    longer = F.greatest(F.length(word), F.length(candidate))
    return 1 - F.try_divide(F.levenshtein(word, candidate).cast("double"), longer.cast("double"))


def _damage(la: Column, lb: Column, cutoff: float) -> Column:
    """Most edits that can separate two names of these lengths if they reach the cutoff."""
    return F.floor(F.greatest(la, lb) * (1 - cutoff) + EPS).cast("int")


def _most_damage(lb: Column, cutoff: float) -> Column:
    """The same over all names that could match a key of length lb."""
    return _damage(_length_limits(lb, cutoff)[1], lb, cutoff)


def _length_limits(n: Column, cutoff: float) -> tuple[Column, Column]:
    """Shortest and longest name that can still match one of length n."""
    return F.ceil(n * cutoff - EPS).cast("int"), F.floor(n / cutoff + EPS).cast("int")


# ---- candidates ---------------------------------------------------------------------------------

def _segment(length: Column, k: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of piece i when a text is cut into k + 1 nearly equal pieces.

    A text too short for that has the empty piece, which every name contains.
    """
    parts = k + 1
    base = F.floor(length / parts).cast("int")
    short = parts - length % parts
    start = i * base + F.greatest(F.lit(0), i - short)
    size = base + (i >= short).cast("int")
    whole = parts <= length
    return F.when(whole, start).otherwise(0), F.when(whole, size).otherwise(0)


def _gram_size(cutoff: float) -> int:
    """Longest grams of which the longer of two names keeps one: m + q - 1 grams less q floor((1 - cutoff) m) is at least one.

    0 where no size does.
    """
    return 3 if cutoff >= 2 / 3 else 2 if cutoff >= 1 / 2 else 0


def _grams(text: Column, size: int) -> Column:
    """All grams of a text that is padded on both sides, in order."""
    padded = F.concat(F.lit("\x02" * (size - 1)), text, F.lit("\x03" * (size - 1)))
    return F.transform(F.sequence(F.lit(1), F.length(text) + size - 1), lambda i: F.substring(padded, i, F.lit(size)))


def _prefixes(texts: DataFrame, text: str, often: DataFrame, cutoff: float, size: int) -> DataFrame:
    """(text, _len, _gram, _at): the rarest grams of each text by their number among the keys, as many as k edits cannot all touch.

    Grams equal to the last one taken are taken too, wherever they are, as ties have no order.
    """
    rows = texts.select(text, F.length(text).alias("_len"), F.posexplode(_grams(F.col(text), size)).alias("_at", "_gram"))
    ranked = rows.join(often, "_gram", "left").groupBy(text, "_len").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("_often", F.lit(0)).alias("o"), F.col("_gram").alias("g"), F.col("_at").alias("at")))).alias("_all"))
    many = F.least(F.size("_all"), size * _most_damage(F.col("_len"), cutoff) + 1)
    last = F.element_at("_all", many)
    taken = F.filter("_all", lambda x: F.struct(x["o"], x["g"]) <= F.struct(last["o"], last["g"]))
    return ranked.select(text, "_len", F.explode(taken).alias("_x")).select(text, "_len", F.col("_x.g").alias("_gram"), F.col("_x.at").alias("_at"))


def gram_pairs(names: DataFrame, name: str, dim: DataFrame, key: str, cutoff: float) -> DataFrame:
    """Distinct (_name, _key, _k) that share a rare gram not more than _k places apart, are near enough in length, and have
    as many grams in common as k edits must leave of the longer one.
    """
    size = _gram_size(cutoff)
    left = names.select(F.col(name).alias("_name")).filter(F.length("_name") > 0).distinct()
    right = dim.select(F.col(key).alias("_key")).filter(F.length("_key") > 0).distinct()
    often = right.select(F.explode(_grams(F.col("_key"), size)).alias("_gram")).groupBy("_gram").agg(F.count("*").alias("_often"))
    keys = _prefixes(right, "_key", often, cutoff, size).withColumnsRenamed({"_len": "_lb", "_at": "_bt"})
    limits = right.agg(F.struct(F.min(F.length("_key")).alias("lo"), F.max(F.length("_key")).alias("hi"))).scalar()
    low, high = _length_limits(F.length("_name"), cutoff)
    fitting = left.filter((high >= limits["lo"]) & (low <= limits["hi"]))  # texts that no key is near in length cost nothing
    found = _prefixes(fitting, "_name", often, cutoff, size).join(keys, "_gram")
    k = _damage(F.col("_len"), F.col("_lb"), cutoff)
    near = found.filter((F.abs(F.col("_len") - F.col("_lb")) <= k) & (F.abs(F.col("_at") - F.col("_bt")) <= k))
    pairs = near.select("_name", "_key", k.alias("_k"), F.greatest("_len", "_lb").alias("_most")).distinct()
    held = pairs.withColumns({"_gn": _grams(F.col("_name"), size), "_gk": _grams(F.col("_key"), size)})
    # Grams that occur twice count once in the intersection, so the name's own repeats are granted.
    common = F.size(F.array_intersect("_gn", "_gk")) + F.size("_gn") - F.size(F.array_distinct("_gn"))
    return held.filter(common >= F.col("_most") + (size - 1) - size * F.col("_k")).select("_name", "_key", "_k")


def candidate_pairs(names: DataFrame, name: str, dim: DataFrame, key: str, cutoff: float) -> DataFrame:
    """Distinct (name, key) pairs among which every pair at or above the cutoff is found."""
    by = gram_pairs if _gram_size(cutoff) and cutoff < LONG_PIECES else piece_pairs
    pairs = by(names, name, dim, key, cutoff)
    return pairs.filter(F.levenshtein("_name", "_key") <= F.col("_k")).select("_name", "_key")


def piece_pairs(names: DataFrame, name: str, dim: DataFrame, key: str, cutoff: float) -> DataFrame:
    """The same by pieces of the keys, for any cutoff."""
    left = names.select(F.col(name).alias("_name")).filter(F.length("_name") > 0).distinct().withColumn("_la", F.length("_name"))
    right = dim.select(F.col(key).alias("_key")).filter(F.length("_key") > 0).distinct().withColumn("_lb", F.length("_key"))
    k, i = F.col("_k"), F.col("_i")
    start, size = _segment(F.col("_lb"), k, i)

    # Keys: their pieces for every edit bound that a name of fitting length can give.
    widest = _most_damage(F.col("_lb"), cutoff)
    pieces = (
        right.withColumn("_k", F.explode(F.sequence(F.lit(0), widest)))
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.least(k, F.col("_lb")))))
        .select("_key", "_lb", "_k", "_i", F.substring("_key", start + 1, size).alias("_piece")))

    # Names: the substrings at which piece i of a key of length lb can still be found. Only lengths that
    # keys have matter, so a very long text that cannot match costs nothing.
    limits = right.agg(F.struct(F.min("_lb").alias("lo"), F.max("_lb").alias("hi"))).scalar()
    shortest, longest = limits["lo"], limits["hi"]
    low, high = _length_limits(F.col("_la"), cutoff)
    low, high = F.greatest(low, shortest), F.least(high, longest)
    shift = F.col("_la") - F.col("_lb")
    # Edits to the left and to the right of an intact piece share k, which limits how far it can move.
    # Without substitutions it moves left by lost and right by added characters at most; the same numbers.
    first = F.greatest(F.lit(0), start - F.floor((k - shift) / 2).cast("int"))
    last = F.least(F.col("_la") - size, start + F.floor((k + shift) / 2).cast("int"))
    probes = (
        left.withColumns({"_low": low, "_high": high}).filter(F.col("_low") <= F.col("_high"))
        .withColumn("_lb", F.explode(F.sequence("_low", "_high")))
        .withColumn("_k", _damage(F.col("_la"), F.col("_lb"), cutoff))
        .filter((k >= 0) & (F.abs(shift) <= k))
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.least(k, F.col("_lb")))))
        .withColumn("_at", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))))
        .select("_name", "_lb", "_k", "_i", F.substring("_name", F.col("_at") + 1, size).alias("_piece")))
    return probes.join(pieces, ["_lb", "_k", "_i", "_piece"]).select("_name", "_key", "_k").distinct()


def closest(names: DataFrame, name: str, dim: DataFrame, key: str, cutoff: float = CUTOFF) -> DataFrame:
    """(name, match): best dimension key per name at or above the cutoff; ties to the later key."""
    pairs = candidate_pairs(names, name, dim, key, cutoff)
    scored = pairs.withColumn("_score", edit_similarity(F.col("_name"), F.col("_key"))).filter(F.col("_score") >= cutoff - EPS)
    best = scored.groupBy("_name").agg(F.max(F.struct("_score", "_key")).alias("_best"))
    return best.select(F.col("_name").alias(name), F.col("_best._key").alias("match"), F.col("_best._score").alias("score"))


# ---- joins --------------------------------------------------------------------------------------

def resolve(a: DataFrame, dim: DataFrame, on: str, key: str, cutoff: float = CUTOFF,
            trim: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per distinct name of `a`: (on, match, how) with how = exact, fuzzy or null.

    The names are de-duplicated on the map side, so this is small next to the fact table.
    """
    names = a.select(on).filter(F.col(on).isNotNull()).distinct()
    dim = settle(dim.select(key).distinct(), "keys")
    keys = dim.select(F.col(key).alias("match"), F.col(key).alias(on))
    exact = settle(names.join(keys, on, "left"), "names")
    open_names = exact.filter(F.col("match").isNull()).select(on, (trim(F.col(on)) if trim else F.col(on)).alias("_trimmed"))
    guessed = closest(open_names, "_trimmed", dim, key, cutoff)
    fuzzy = open_names.join(guessed, "_trimmed", "left").select(
        on, "match", F.when(F.col("match").isNotNull(), F.lit("fuzzy")).alias("how"))
    return exact.filter(F.col("match").isNotNull()).select(on, "match", F.lit("exact").alias("how")).unionByName(fuzzy)


def fuzzy_join(a: DataFrame, dim: DataFrame, on: str, key: str, cutoff: float = CUTOFF,
               trim: Callable[[Column], Column] | None = None, replace_with: str | None = None,
               require_match: bool = False) -> DataFrame:
    """Left join on nearly equal names; an exact match always wins.

    Columns of `a` that the dimension also has are taken from the dimension. `replace_with` names a
    dimension column that replaces the name. `require_match` fails the job on an unmatched name.
    """
    names = resolve(a, dim, on, key, cutoff, trim)
    attributes = dim.withColumnRenamed(key, "match") if key != "match" else dim
    lookup = names.join(attributes, "match", "left").drop("how")
    overlap = [c for c in a.columns if c in dim.columns and c != on]
    out = a.drop(*overlap).join(lookup, on, "left")
    if require_match:
        ok = F.col(on).isNull() | F.col("match").isNotNull()
        out = out.filter(F.coalesce(F.assert_true(ok, F.concat(F.lit("unmatched name: "), F.col(on))).isNull(), F.lit(True)))
    if replace_with:
        out = out.drop(on).withColumnRenamed(replace_with, on) if replace_with != key else out.withColumn(on, F.col("match"))
    return out.drop("match")


def match_audit(a: DataFrame, dim: DataFrame, on: str, key: str, cutoff: float = CUTOFF,
                trim: Callable[[Column], Column] | None = None) -> DataFrame:
    """Names that had no exact match, what they were taken for (null if nothing) and how often they occur."""
    names = resolve(a, dim, on, key, cutoff, trim).filter(~F.col("how").eqNullSafe("exact"))
    counts = a.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("count"))
    return counts.join(names, on).select(on, F.col("match").alias("guess"), "count")


def alias_table(dim: DataFrame, name: str, aliases: str, extra: Sequence[str] = ()) -> DataFrame:
    """(alias, name, extra...): every alias and the name itself; an alias of two places goes to the first by name."""
    own = dim.select(F.explode(F.array_distinct(F.concat(F.array(F.col(name)), F.coalesce(F.col(aliases), F.array().cast("array<string>"))))).alias("alias"),
                     name, *extra)
    return own.filter(F.length("alias") > 0).groupBy("alias").agg(
        F.min_by(F.struct(name, *extra), F.col(name)).alias("_r")).select("alias", "_r.*")


def merge_aliases(*forms: DataFrame, alias: str = "alias") -> DataFrame:
    """Alias tables in order of preference, one row per alias, first non-null attribute kept."""
    from epitide.operators.merge import priority_merge, stack_sources
    attributes = []
    for f in forms:
        attributes += [c for c in f.columns if c != alias and c not in attributes]
    return priority_merge(stack_sources(*forms), [alias], attributes)


def trim_place(c: Column, prefixes: Sequence[str] = (), suffixes: Sequence[str] = ()) -> Column:
    """Drop titles before and after a place name, dots and outer spaces."""
    bare = F.regexp_replace(strip_prefixes(F.trim(c), *prefixes), r"^[ .]+|[ .]+$", "")
    return F.trim(strip_suffixes(bare, *suffixes))


def canonical_places(df: DataFrame, aliases: DataFrame, on: str, attach: Sequence[str] = (), cutoff: float = CUTOFF,
                     prefixes: Sequence[str] = (), suffixes: Sequence[str] = ()) -> DataFrame:
    """Replace a free-text place by its canonical name and attach dimension columns."""
    dim = aliases.select("alias", F.col("name").alias("_canonical"), *attach)
    return fuzzy_join(df, dim, on, "alias", cutoff,
                      trim=lambda c: trim_place(c, prefixes, suffixes), replace_with="_canonical")


def standardise(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str, out: str,
                default: str | None = "Unknown", cutoff: float = CUTOFF) -> DataFrame:
    """Map a category column through a dictionary; unmapped ones keep their text (default=None) or get `default`."""
    named = fuzzy_join(df, mapping.select(F.col(source), F.col(target).alias("_to")), column, source, cutoff)
    fallback = F.col(column) if default is None else F.lit(default)
    return named.withColumn(out, F.coalesce(F.col("_to"), fallback)).drop("_to")


def attach_parent(dim: DataFrame, code: str, name: str, out: str, divisor: int = 100) -> DataFrame:
    """Parent name where the parent's code is the leading digits of the child's code."""
    parents = dim.select(F.col(code).alias("_parent"), F.col(name).alias(out))
    return dim.withColumn("_parent", F.floor(F.col(code) / divisor).cast(dim.schema[code].dataType)).join(
        parents, "_parent", "left").drop("_parent")


def rebase_cumulative(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Continue cumulative totals that restarted: add each entity's closing value, then append.

    Rows of the new period without a closing value are kept as they are.
    """
    closing = old.groupBy(*keys).agg(*[
        F.max_by(t, F.when(F.col(t).isNotNull(), F.struct(*order))).alias(f"_{t}") for t in totals])
    raised = new.join(closing, list(keys), "left").withColumns(
        {t: F.coalesce(F.col(t) + F.col(f"_{t}"), F.col(t)) for t in totals}).select(*new.columns)
    return old.unionByName(raised, allowMissingColumns=True)
