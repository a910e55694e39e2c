"""Mixing sources to target weights: targets per source, then whole copies and one seeded chance per document.

A source with target t and size s has rate t / s, at most `cap`: each of its documents is emitted floor(rate) times, and
once more with a chance of the remaining fraction f. The chances of one source are drawn together, so that its words come
near the target: hashes deal its documents to PIECES pieces, the pieces lie in hash order on a circle, each as long as its
words, one seeded start per source turns the circle, and the pieces whose middle then falls into the first f of it are
taken whole. Only the pieces at the two ends of that arc can miss. Pieces that hold a large share of their source are
drawn first, on a circle of their own, and the smaller ones make up for what those miss (CLASSES). The start is uniform,
so that a document's chance is f, but where the smaller pieces are too few to make up (their fraction stays in 0..1).

No target exceeds `cap` times its source's size; what is cut off is shared by weight among the others.

Defined cases: a null source is a source like any other and sorts last; a null or wordless text has size 0 and costs
nothing; a null document id draws by its size; repeated rows decide alike; a null or non-positive weight gives target 0;
an empty table gives an empty table. Input columns pass through `mix`; the result columns must not exist already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitide.llm.common import col, pick, seeded_unit, word_count
from epitide.sources.stage import settle

CAP = 3
SEED = 20
PIECES = 4096      # pieces of one source, so that no row is ordered or shuffled to be drawn
CLASSES = (8, 64)  # pieces of an 8th of their source and more are drawn first, of a 64th second, the others last


def source_sizes(df: DataFrame, source: str, size: Column) -> DataFrame:
    """(source, source_size): one row per source, summed map-side first."""
    return df.select(col(source).alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))


def cycled_weights(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The weights in turn over the sources by code point, null last. One row per source, as in any mixing recipe."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))


def targets(recipe: DataFrame, cap: int = CAP, total: Column | None = None) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size, weight); the table has one row per source.

    Sources are ordered by the level at which they meet their cap, cap x size / weight. The first one whose level is not
    below what the rest could share sets the level of the rest; those before it stay at their cap.
    """
    usable = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)
    rows = recipe.select("source", "source_size", usable.alias("weight"))
    everything = Window.partitionBy(F.lit(1))
    order = everything.orderBy(F.col("meets").asc_nulls_last(), F.col("source").asc_nulls_last())
    full = F.lit(cap) * F.col("source_size")
    rows = rows.withColumn("meets", F.when(F.col("weight") > 0, full / F.col("weight")))
    rows = rows.withColumns({
        "place": F.row_number().over(order),
        "spent": F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("source_size").over(everything) if total is None else total})
    rows = rows.withColumn("level", F.when(F.col("weight") > 0, (F.col("all") - F.col("spent")).cast("double") / F.col("open")))
    rows = rows.withColumn("set", F.min(F.when(F.col("level") <= F.col("meets"), F.struct("place", "level"))).over(everything))
    target = F.when(F.col("weight") <= 0, 0.0).when(
        F.col("set").isNull() | (F.col("place") < F.col("set.place")), full.cast("double")).otherwise(F.col("weight") * F.col("set.level"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def piece_of(id: Column, size: Column, seed: int = SEED) -> Column:
    """The piece of its source that a document lies in."""
    return F.floor(seeded_unit(seed, id, size) * PIECES).cast("int")


def draw(sized: DataFrame, goals: DataFrame, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """(source, piece, source_size, target, copies) of the pieces of all sources, at most PIECES rows a source.

    `sized` has id, source and size and enters with one row per task and piece.
    """
    known = goals.select(F.col("source").alias("_s"), "source_size", "target")
    pieces = sized.groupBy("source", piece_of(F.col("id"), F.col("size"), seed).alias("piece")).agg(F.sum("size").alias("words"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0)
    level = F.lit(len(CLASSES))
    for i, share in reversed(list(enumerate(CLASSES))):
        level = F.when(F.col("words") * share >= F.col("source_size"), i).otherwise(level)
    rows = pieces.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("rate", rate).withColumns({
        "whole": F.floor("rate"), "part": F.col("rate") - F.floor("rate"), "level": level})
    of_level = Window.partitionBy("source", "level")
    before = of_level.orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("all", F.sum("words").over(of_level)).withColumn("at", F.when(
        F.col("all") > 0, (2 * F.sum("words").over(before) - F.col("words")) / (2 * F.col("all"))).otherwise(0.0))
    rows = rows.withColumns({"missed": F.lit(0.0), "taken": F.lit(0).cast("bigint")})
    of_source = Window.partitionBy("source")
    for i in range(len(CLASSES) + 1):
        here, size = F.col("level") == i, F.max(F.when(F.col("level") == i, F.col("all"))).over(of_source)
        rows = rows.withColumn("size", F.coalesce(size, F.lit(0)))
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(F.col("size") > 0, F.col("part") - F.col("missed") / F.col("size")).otherwise(F.col("part"))))
        turned = F.col("at") + seeded_unit(seed, F.col("source"), F.lit(i))
        rows = rows.withColumn("taken", F.when(here, (turned - F.floor(turned) < share).cast("bigint")).otherwise(F.col("taken")))
        got = F.sum(F.when(F.col("level") == i, F.col("words") * F.col("taken")).otherwise(0)).over(of_source)
        rows = rows.withColumn("missed", F.col("missed") + (got - F.col("part") * F.col("size")))
    return rows.select("source", "piece", "source_size", "target", (F.col("whole") + F.col("taken")).cast("bigint").alias("copies"))


def decide(sized: DataFrame, drawn: DataFrame, seed: int = SEED) -> DataFrame:
    """`sized` (with id, source, size) and the source's source_size, target and the number of copies of each row.

    `drawn` is the result of `draw`: adaptive execution broadcasts it while it is small; beyond, rows meet it by source and
    piece, so that a hot source comes in PIECES parts.
    """
    named = drawn.withColumnsRenamed({"source": "_s", "piece": "_p"})
    return sized.join(named, (piece_of(F.col("id"), F.col("size"), seed) == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_p")


def mix(df: DataFrame, id: str, source: str, text: str, goals: DataFrame, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The documents as often as the mix takes them, all columns kept. Texts are read twice, once for their sizes."""
    packed = df.select(F.struct("*").alias("doc"), col(id).alias("id"), col(source).alias("source"), word_count(text).alias("size"))
    drawn = settle(draw(packed.drop("doc"), goals, cap, seed), "drawn")
    taken = decide(packed, drawn, seed).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("doc.*")


def mixed_sizes(df: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = (1, 2, 3),
                cap: int = CAP, seed: int = SEED) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), one row per document; texts are read once."""
    sized = settle(pick(df, id=id, source=source, size=word_count(text)), "sized")
    goals = targets(cycled_weights(source_sizes(sized, "source", F.col("size")), weights), cap)
    drawn = settle(draw(sized, goals, cap, seed), "drawn")
    return decide(sized, drawn, seed).withColumn("taken", F.col("copies") * F.col("size"))
