"""Shards of even size that keep linked documents together: balanced label propagation.

Documents that share a link group are neighbours. Each round joins the members of the groups with the groups' sizes by
shard, lets every document ask for the shard that holds most of its neighbours, and grants the wishes under capacity
quotas; of the rounds the driver sees only sums per pair of shards. Documents without links fill the shards, and a last
cut of all documents, in order of their shards, into equal sums of bytes makes the sizes even to within a document.
Every step is a DataFrame expression.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_points, equal_numbers, query, table
from tidemark.session import stage

SHARDS = 16
ROUNDS = 8
SEED = 29
MOST_SHARDS = 1_024  # sums per pair of shards reach the driver
SLOT_ROWS = 2_000  # rows numbered by one task at a time
GRAIN = 1_000_000
TOGETHER = 0.02  # of a shard's capacity: groups that are moved as one
SLACK = 0.1  # by which propagation may overfill a shard; the last cut moves borders for that
LITTLE = 0.5  # a shard that grants less of what it is asked for counts as full
SIZE_BITS = 24  # of sizes, in the order in which borders move


def _rows(docs: DataFrame, seed: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hub"), F.monotonically_increasing_id().alias("rid"),
    )
    rows = stage(rows.withColumn("place", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("hub"))), "shard-places")
    # Rows equal in id and text get places of their own, and start from the same shard, their ``home``.
    placed = rows.join(equal_numbers(rows, "place"), "rid", "left").withColumn("home", F.col("place"))
    return placed.withColumn("place", F.when(F.col("number") > 0, F.xxhash64("place", "number")).otherwise(F.col("place"))).drop("number")


def equal_texts(rows: DataFrame) -> DataFrame:
    """Memberships (rid, hub, size, place, home) in groups of equal texts of at least two rows."""
    hubs = rows.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").select("hub")
    return rows.select("rid", "hub", "size", "place", "home").join(stage(hubs, "shard-hubs"), "hub").select("rid", "hub", "size", "place", "home")


def granted(load: dict[int, int], flows: dict[tuple[int, int], int], capacity: float) -> dict[int, float]:
    """The share of wishes for each shard that fits: its free capacity and what leaves it, over what asks for it."""
    asked: dict[int, int] = {}
    for (_, to), size in flows.items():
        asked[to] = asked.get(to, 0) + size
    share = dict.fromkeys(asked, 1.0)
    for _ in range(100):
        leaves: dict[int, float] = {}
        for (start, to), size in flows.items():
            leaves[start] = leaves.get(start, 0.0) + size * share[to]
        share = {to: min(share[to], max(0.0, capacity - load.get(to, 0) + leaves.get(to, 0.0)) / size) for to, size in asked.items()}
    return share


def propagate(members: DataFrame, shards: int, capacity: float, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(rid, size, place, shard, hub) of all linked documents after ``rounds`` of label propagation under quotas.

    ``members`` is (rid, hub, size, place, home); a document may be in several hubs and starts in a shard by its ``home``. A document asks for the shard with the most bytes
    in its hubs, its own among them. Rounds end early when nobody asks. ``hub`` of the result is the least of a document's.
    """
    start = members.groupBy("rid").agg(F.min("size").alias("size"), F.min("home").alias("home"), F.min("place").alias("place"), F.min("hub").alias("hub"))
    placed = stage(start.withColumn("shard", F.pmod("home", F.lit(shards)).cast("int")).drop("home"), "shard-start")
    full: list[int] = []  # shards that granted little of what they were asked for
    for turn in range(rounds):
        at = members.select("rid", "hub").join(placed.select("rid", "size", "shard"), "rid")
        tally = at.groupBy("hub", "shard").agg(F.sum("size").alias("held"))
        spread = tally.groupBy("hub").agg(F.map_from_entries(F.collect_list(F.struct("shard", "held"))).alias("held")).where(F.size("held") > 1)
        spread = stage(spread, "shard-hubs")  # a map of at most all shards per hub; hubs that are whole ask for nothing
        asks = at.join(spread, "hub").select("rid", "hub", "shard", F.explode("held").alias("to", "held"))
        asks = asks.where((F.col("to") == F.col("shard")) | ~F.col("to").isin(full))
        asks = asks.groupBy("rid", "to").agg(F.sum("held").alias("held"), F.max(F.xxhash64("hub", "to")).alias("tie"))
        best = asks.groupBy("rid").agg(F.max(F.struct("held", "tie", "to")).alias("best")).select("rid", "best.to", "best.held")
        wishes = placed.join(best, "rid").where("to != shard").select("rid", "size", "place", "hub", "held", "shard", "to")
        wishes = stage(wishes, "shard-wishes")
        flows = {(r["shard"], r["to"]): r["size"] for r in wishes.groupBy("shard", "to").agg(F.sum("size").alias("size")).collect()}
        if not flows:
            break
        load = {r["shard"]: r["size"] for r in placed.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
        share = granted(load, flows, capacity)
        limit = F.lit(0)
        for to, part in share.items():
            limit = F.when(F.col("to") == to, int(part * GRAIN)).otherwise(limit)
        # Members of a small group are granted or refused together.
        by = F.when(F.col("held") <= capacity * TOGETHER, F.col("hub")).otherwise(F.col("place"))
        moves = wishes.where(F.pmod(F.xxhash64(F.lit(seed + turn), by), F.lit(GRAIN)) < limit).select("rid", "to")
        full = sorted({*full, *(to for to, part in share.items() if part < LITTLE)})
        placed = placed.join(moves, "rid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")
        placed = stage(placed, "shard-round")
    return placed


def _bits(hashed: Column, n: int) -> Column:
    """``n`` upper bits of a hash as a number from 0."""
    return F.shiftrightunsigned(hashed, 64 - n)


def _beyond(atoms: DataFrame, budgets: list[float], n: int, key: Column) -> Column:
    """How many of the ``budgets``, sums of sizes in order of ``u``, a key lies beyond."""
    if not budgets:
        return F.lit(0)
    budget = F.get(F.array(*(F.lit(float(b)) for b in budgets)), F.col("id").cast("int"))
    asked = atoms.sparkSession.range(len(budgets)).select(F.lit(0).alias("g"), F.col("id").cast("int").alias("t"), budget.alias("budget"))
    shard = F.lit(0)
    for row in cut_points(atoms.select(F.lit(0).alias("g"), "u", "size"), asked, n).collect():  # a row per border
        shard = shard + (F.lit(1) if row["cut"] is None else F.when(key > row["cut"], 1).otherwise(0))
    return shard.cast("int")


def shard_documents(docs: DataFrame, links: DataFrame | None = None, *, shards: int = SHARDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, linked_shard``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. ``links`` (doc_id, hub) names link groups; without it equal texts
    are linked. Size is UTF-8 bytes plus 1; a null text counts as empty. The law is ``bytes``: shards differ by at most about
    the size of one document. ``slot`` numbers the rows of a shard from 0. ``linked_shard`` is where propagation put a
    linked document, null without links; ``shard`` differs from it only at the borders that make sizes even. Rows equal in id and text
    are rows of their own, linked like other equal texts. A group larger than a shard is split over as few shards as quotas allow. Without
    rows the result is empty.
    """
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"shards must be 1 to {MOST_SHARDS}")
    rows = stage(_rows(docs, seed), "shard-rows")
    counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    capacity = counted["size"] / shards
    if links is None:
        members = equal_texts(rows)
    else:
        hubs = links.select("doc_id", F.xxhash64("hub").alias("hub")).distinct()
        members = rows.select("doc_id", "rid", "size", "place", "home").join(hubs, "doc_id").select("rid", "hub", "size", "place", "home")
    linked = propagate(stage(members, "shard-members"), shards, capacity * (1 + SLACK), rounds, seed)
    load = {r["shard"]: r["size"] for r in linked.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
    ours = linked.select("rid", F.col("shard").alias("linked_shard"), F.col("hub").alias("link"))
    placed = stage(rows.join(ours, "rid", "left").drop("hub"), "shard-linked")
    # The others, in order of their hashes, fill what the linked ones leave free of each shard.
    free = [max(0.0, capacity - load.get(s, 0)) for s in range(shards)]
    single = placed.where("link IS NULL").select(F.col("place").alias("u"), "size")
    filling = _beyond(single, list(accumulate(free))[:-1], counted["n"], F.col("place"))
    placed = placed.withColumn("first", F.coalesce("linked_shard", filling))
    # Order of the last cut: shards; inside a shard linked documents, group by group, between two halves of the others, so
    # that borders move through documents without links, the smallest first.
    width = max(1, (shards - 1).bit_length())
    rest = 60 - width
    half = F.when(_bits(F.xxhash64(F.lit(2), F.col("place")), 1) == 0, 0).otherwise(2)
    small = F.least(F.col("size"), F.lit(2**SIZE_BITS - 1))
    alone = F.shiftleft(F.when(half == 0, small).otherwise(2**SIZE_BITS - 1 - small), rest - SIZE_BITS) + _bits(F.col("place"), rest - SIZE_BITS)
    inner = F.shiftleft(_bits(F.xxhash64("link"), rest - 20), 20) + _bits(F.col("place"), 20)
    order = (
        F.shiftleft(F.col("first").cast("long"), 62 - width)
        + F.shiftleft(F.when(F.col("link").isNull(), half).otherwise(1).cast("long"), rest)
        + F.when(F.col("link").isNull(), alone).otherwise(inner)
    )
    placed = stage(placed.select("doc_id", "size", "text_crc32", "rid", "place", "linked_shard", order.alias("u")), "shard-order")
    shard = _beyond(placed, [capacity * t for t in range(1, shards)], counted["n"], F.col("u"))
    buckets = max(1, counted["n"] // (shards * SLOT_ROWS))
    placed = placed.withColumn("shard", shard).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(3), F.col("place")), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    starts = starts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("place", "rid")) - 1
    numbered = placed.withColumn("_local", local).join(starts, ["shard", "_bucket"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_start") + F.col("_local")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "linked_shard",
    )


@query("op8_shard_documents")
def op8(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))
