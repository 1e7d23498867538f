"""Connected components of links between integers, by joins that shrink the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links`` (a, b): the least node that it reaches.

    Every round, nodes take the least label among their own and their neighbours', then labels are followed to their own
    labels. Each label is a node of the same component, so the rounds halve the paths; they end when nothing changes.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stage(links.select(F.explode(ways).alias("way")).select("way.*"), "links")
    labels = stage(links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    for _ in range(MOST_ROUNDS):
        near = links.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("next"))
        # The old label's node may hook to the new one too, so that whole trees move.
        hooks = moved.where("next < label").groupBy("label").agg(F.min("next").alias("hook")).withColumnRenamed("label", "node")
        moved = stage(moved.join(hooks, "node", "left").select("node", "label", F.least("next", F.coalesce("hook", "next")).alias("next")), "labels")
        jumped = moved.join(moved.select(F.col("node").alias("next"), F.col("next").alias("far")), "next", "left")
        after = stage(jumped.select("node", "label", F.least("next", F.coalesce("far", "next")).alias("next")), "labels")
        changed = after.where("next < label").limit(1).count()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError("components did not settle")
