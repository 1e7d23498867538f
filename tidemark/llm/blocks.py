"""Members of groups that meet in blocks, by sketches first, so that only those with a close partner bring their full sets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sketches import cell_bits, may_repeat, sketch_members
from tidemark.session import stage

PLACE = ["anchor", "low", "high", "side", "same", "id", "component"]
_KINDS = "anchor bigint, low int, high int, side int, same boolean, id bigint, component bigint"


def meetings(members: DataFrame) -> DataFrame:
    """``PLACE`` of every member (anchor, id, component, blocks) in each pair of blocks of its group that it is part of."""
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meet = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("block", o).alias("low"), F.greatest("block", o).alias("high"), (F.col("block") > o).cast("int").alias("side"), (F.col("block") == o).alias("same")),
    )
    return members.select("anchor", "id", "component", F.explode(meet).alias("m")).select("anchor", "m.*", "id", "component")


def close_meetings(met: DataFrame, lean: DataFrame, close: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """The rows of ``met`` that ``close`` finds a partner for; it sees a pair of blocks with the columns of ``lean``, by id."""

    def kept(group: pa.Table) -> pa.Table:
        return group.filter(pa.array(close(group))).select(PLACE)

    return stage(met.join(lean, "id").groupBy("anchor", "low", "high").applyInArrow(kept, _KINDS), "near-close")


def among(ids: DataFrame) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """A filter of batches: rows whose ``id`` may be among ``ids``, a written table."""
    n = ids.count()
    bits = cell_bits(n)
    known = sketch_members(ids, bits, n)

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column("id").to_numpy(zero_copy_only=False).view(np.uint64)
        return batch.filter(pa.array(may_repeat(found, known.value, bits)))

    return kept
