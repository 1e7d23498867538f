"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every step is a DataFrame expression. The level of the water comes from running sums over the sources; documents are
taken by their place in a seeded order of hashes, found by cutting ordered sums (``common.cut_points``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_points, n_words, query, ranked, shield, table
from tidemark.session import stage

MAX_EPOCHS = 3.0
SEED = 17


def _source_key(source: str = "source"):
    """Sources as a group that joins on null too."""
    return F.concat(F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(F.col(source).cast("string"), F.lit("")))


def _sized(docs: DataFrame, rid, seed: int) -> DataFrame:
    """doc_id, source, its key ``g``, size in words, number ``rid`` and the seeded place ``u`` of every row."""
    return docs.select(
        F.col("doc_id"), F.col("source"), _source_key().alias("g"), n_words(F.col("text")).alias("size"), rid.alias("rid"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("u"),
    )


def water_level(sources: DataFrame, total: float) -> float:
    """The level at which sources of ``cap`` and positive ``weight``, each filled to ``least(cap, weight * level)``, hold ``total``.

    If the sources that are full first, by ``cap / weight``, are taken as full, what remains over the weights of the others is never
    above the level, and equals it for the right ones; so the level is the largest such quotient. Running sums are made by ranges of the
    order and inside them, so no task sees all sources.
    """
    ratio = F.col("cap") / F.col("weight")
    parts = sources.select("cap", "weight", ratio.alias("ratio"), F.xxhash64("g").alias("tie"))
    parts = stage(parts.repartitionByRange("ratio", "tie").withColumn("part", F.spark_partition_id()), "mix-levels")
    by_part, inside = Window.orderBy("part"), Window.partitionBy("part").orderBy("ratio", "tie")
    first, last = Window.unboundedPreceding, Window.unboundedFollowing
    sums = parts.groupBy("part").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight"))
    sums = sums.select("part", F.sum("cap").over(by_part.rowsBetween(first, -1)).alias("cap_before"), F.sum("weight").over(by_part.rowsBetween(1, last)).alias("weight_after"))
    none = F.lit(0.0)
    full = F.coalesce(F.sum("cap").over(inside.rowsBetween(first, -1)), none) + F.coalesce("cap_before", none)
    free = F.sum("weight").over(inside.rowsBetween(0, last)) + F.coalesce("weight_after", none)
    found = parts.join(sums, "part").select("cap", ((F.lit(float(total)) - full) / free).alias("level")).agg(F.max("level").alias("level"), F.sum("cap").alias("cap")).first()
    if found["level"] is None:
        return 0.0
    return float("inf") if total >= found["cap"] else max(0.0, found["level"])


def fill(sources: DataFrame, total: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (``g, source_size, weight``) with ``target``: shares of ``total`` by weight, at most ``max_epochs`` sizes.

    Sources above their cap are clamped, the rest is reshared by weight, until no source is above. A total beyond all caps
    leaves every source at its cap; weights that are null, negative or zero give 0.
    """
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = water_level(sources.select("g", cap.alias("cap"), weight.alias("weight")).where("weight > 0"), total)
    target = F.when(weight <= 0, F.lit(0.0)).otherwise(F.least(cap, cap if level == float("inf") else weight * F.lit(level)))
    return sources.withColumn("target", target)


def plan_mix(atoms: DataFrame, weigh, *, share: float = 1.0, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``g, source, source_size, target, whole, cut, split, split_cut, extra``.

    ``atoms`` is the written table of ``_sized``. ``weigh`` gets the sources (``g, source, source_size``) and adds ``weight``. ``share`` of all words is
    shared out. A document of the source is taken ``whole`` times, and once more if its place is at most ``cut``, if it is one of the equal
    rows at the place ``split`` whose hashed numbers are at most ``split_cut``, or if its number is ``extra``.
    """
    by_source = atoms.groupBy("g", "source").agg(F.sum("size").alias("source_size"))
    sources = stage(weigh(by_source), "mix-sources")
    counted = atoms.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    sources = stage(fill(sources, share * counted["size"], max_epochs), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(epochs + 1e-12)
    sources = sources.withColumn("whole", whole.cast("int")).withColumn("budget", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    cuts = cut_points(atoms.select("g", "u", "size"), sources.select("g", F.lit(0).alias("t"), "budget"), counted["n"]).select("g", "cut", "below")
    sources = stage(sources.join(cuts, "g", "left").withColumn("rest", F.col("budget") - F.coalesce("below", F.lit(0.0))), "mix-cuts")
    later = atoms.join(sources.select("g", "cut", "rest"), "g").where(F.col("cut").isNull() | (F.col("u") > F.col("cut")))
    # Rows equal in id and text share their place: of those at the next place, as many as the rest of the budget holds.
    following = later.groupBy("g", "rest").agg(F.min("u").alias("u"))
    split = atoms.join(following, ["g", "u"]).groupBy("g", "u", "rest").agg(F.count("*").alias("n"), F.min("size").alias("size"))
    split = split.where("n > 1 AND size > 0 AND rest >= size").select("g", F.col("u").alias("split"), F.floor(F.col("rest") / F.col("size")).alias("budget"), F.col("size").alias("split_size"))
    split = stage(split, "mix-split")
    if split.limit(1).count():
        equal = atoms.join(split, (atoms["g"] == split["g"]) & (atoms["u"] == split["split"])).select(atoms["g"], F.xxhash64("rid").alias("u"), F.lit(1).cast("long").alias("size"))
        halves = cut_points(equal, split.select("g", F.lit(0).alias("t"), "budget"), counted["n"]).select("g", F.col("cut").alias("split_cut"))
        split = split.join(halves, "g")
    else:  # no source is cut inside equal rows
        split = split.withColumn("split_cut", F.lit(None).cast("long"))
    split = split.select("g", "split", "split_cut", (F.col("budget") * F.col("split_size")).alias("split_size"))
    sources = sources.join(split, "g", "left").withColumn("rest", F.col("rest") - F.coalesce("split_size", F.lit(0)))
    sources = stage(sources, "mix-halves")
    # What the ordered documents leave of the budget goes to the one further document that comes nearest.
    beyond = atoms.join(sources.where("rest >= 0.5").select("g", "cut", "split", "split_cut", "rest"), "g").where(~_once_more())
    beyond = beyond.withColumn("gap", F.abs(F.col("size") - F.col("rest"))).where(F.col("gap") < F.col("rest"))
    extra = beyond.groupBy("g").agg(F.min(F.struct("gap", "u", "rid")).alias("nearest")).select("g", F.col("nearest.rid").alias("extra"))
    return stage(sources.join(extra, "g", "left").select("g", "source", "source_size", "target", "whole", "cut", "split", "split_cut", "extra"), "mix-plan")


def _once_more():
    """Whether a row lies within the part of its source that is taken once more."""
    half = (F.col("u") == F.col("split")) & (F.xxhash64("rid") <= F.col("split_cut"))
    return F.coalesce(F.col("u") <= F.col("cut"), F.lit(False)) | F.coalesce(half, F.lit(False))


def apply_mix(atoms: DataFrame, plan: DataFrame) -> DataFrame:
    """``atoms``, with further columns of their own, with ``source_size, target`` and ``repeats``, how often the mix takes the row."""
    more = _once_more() | F.coalesce(F.col("rid") == F.col("extra"), F.lit(False))
    joined = atoms.join(plan.drop("source"), "g", "left").withColumn("repeats", F.col("whole") + F.when(more, 1).otherwise(0))
    return joined.drop("whole", "cut", "split", "split_cut", "extra")


def cyclic_weights(weights: Sequence[float]):
    """Weights dealt to sources in code point order, null last, again and again."""

    def weigh(sources: DataFrame) -> DataFrame:
        order = (F.col("source").isNull().asc(), F.col("source").asc())
        steps = F.array(*(F.lit(float(w)) for w in weights))
        return ranked(sources, "_rank", *order).withColumn("weight", F.get(steps, (F.col("_rank") % len(weights)).cast("int"))).drop("_rank")

    return weigh


def mix_sources(docs: DataFrame, weigh, *, share: float = 1.0, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Per document ``doc_id, size, source_size, target, taken, repeats``: what a mix to target weights takes.

    ``docs`` needs ``doc_id, text, source``; other columns are ignored. Sizes are words. A null source is a source of its
    own; null and empty texts have size 0 and are repeated like the rest of their source. Rows equal in id and text share
    their place in the seeded order, of which a part may be taken. Without rows the result is empty. Words taken
    from a source differ from its target by less than half a document in practice, and by less than its largest
    document always.
    """
    atoms = stage(_sized(docs, F.monotonically_increasing_id(), seed), "mix-rows")
    return apply_mix(atoms, plan_mix(atoms, weigh, share=share, max_epochs=max_epochs)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).cast("long").alias("taken"), F.col("repeats").cast("int").alias("repeats"),
    )


def take_mix(docs: DataFrame, weigh, *, share: float = 1.0, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of the mix itself: every row of ``docs`` as often as it is taken, with its own columns.

    Nulls, empty texts, repeated rows and empty tables as in ``mix_sources``; of rows equal in id and text that are taken in part any may stay.
    """
    rows, restore = shield(docs, ("doc_id", "text", "source"))
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "mix-docs")
    plan = plan_mix(stage(_sized(rows, F.col("rid"), seed), "mix-rows"), weigh, share=share, max_epochs=max_epochs)
    placed = rows.withColumns({"g": _source_key(), "u": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))})
    mixed = apply_mix(placed, plan).where(F.col("repeats") > 0)
    return restore(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats")))))


@query("op1_mix_sources")
def op1(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"), cyclic_weights((5, 2, 1)))
