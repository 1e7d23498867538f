"""Tolerant one-to-one matching of predicted against true boundaries.

Predictions are taken in ascending order and each claims the first unclaimed truth within the
tolerance. What a prediction may claim depends on the past only through the first truth position
that is still free, and just before position x that lies within [x - tolerance, x + tolerance]. A
block of positions is therefore a small table "free position on entry -> free position on exit,
matches made". Blocks are evaluated independently, tables of a run of blocks are combined into one, and the tables of
the runs are chained, so the result is exact for series of any length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import BLOCK, RUN, RUN_BLOCKS, block_of

BLOCK_SPAN = 262_144

def _block_table(predicted: np.ndarray, truth: np.ndarray, start: int, span: int, tolerance: int):
    entry = np.arange(start - tolerance, start + tolerance + 1)
    free = entry.copy()
    matched = np.zeros(len(entry), dtype=np.int64)
    for p in predicted:
        at = np.searchsorted(truth, np.maximum(free, p - tolerance))
        inside = at < len(truth)
        candidate = np.where(inside, truth[np.minimum(at, len(truth) - 1)] if len(truth) else 0, 0)
        hit = inside & (candidate <= p + tolerance)
        matched += hit
        free = np.where(hit, candidate + 1, free)
    stop = start + span
    return np.maximum(free, stop - tolerance) - (stop - tolerance), matched


def match_boundaries(
    truth: DataFrame,
    predicted: DataFrame,
    keys: Sequence[str],
    tolerance: int,
    position: str = "boundary",
    block_span: int = BLOCK_SPAN,
    run_blocks: int = RUN_BLOCKS,
) -> DataFrame:
    """``keys, n_true, n_pred, matched`` for every series that has a truth or a prediction."""
    if block_span <= 2 * tolerance:
        raise ValueError("block_span must exceed twice the tolerance")
    p = F.col(position)
    home = block_of(p, block_span)
    pred = predicted.select(*keys, p.alias("_p"), F.lit(False).alias("_is_true"), F.lit(True).alias("_home"), home.alias(BLOCK))
    true = truth.select(
        *keys,
        p.alias("_p"),
        F.lit(True).alias("_is_true"),
        F.explode(F.sequence(block_of(F.greatest(p - tolerance, F.lit(0)), block_span), block_of(p + tolerance, block_span))).alias(BLOCK),
        home.alias("_own"),
    ).select(*keys, "_p", "_is_true", (F.col(BLOCK) == F.col("_own")).alias("_home"), BLOCK)
    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf[BLOCK].iloc[0])
        is_true = pdf["_is_true"].to_numpy()
        positions = pdf["_p"].to_numpy()
        found, real = np.sort(positions[~is_true]), np.sort(positions[is_true])
        leave, matched = _block_table(found, real, block * block_span, block_span, tolerance)
        return pd.DataFrame(
            {
                **{k: [pdf[k].iloc[0]] for k in keys},
                BLOCK: [block],
                "_n_true": [int((is_true & pdf["_home"].to_numpy()).sum())],
                "_n_pred": [len(found)],
                "_exit": [leave],
                "_matched": [matched],
            }
        )

    kinds = "".join(f"`{k}` {pred.schema[k].dataType.simpleString()}, " for k in keys)
    # A group holds the positions of one block: at most 2 * block_span + 2 * tolerance rows.
    tabled = (
        pred.unionByName(true)
        .groupBy(*keys, BLOCK)
        .applyInPandas(table, f"{kinds}{BLOCK} long, _n_true long, _n_pred long, _exit array<long>, _matched array<long>")
        .select(*keys, BLOCK, "_n_true", "_n_pred", F.struct(F.col("_exit").alias("exit"), F.col("_matched").alias("matched")).alias("_t"))
    )

    width = 2 * tolerance + 1
    runs = _chain(tabled.withColumn(RUN, F.floor(F.col(BLOCK) / F.lit(run_blocks))), [*keys, RUN], BLOCK, F.col(RUN) * run_blocks, width)
    # What a run hands on is what its last block does, if that block holds a candidate; otherwise all is free.
    ends = F.col("_last") == (F.col(RUN) + 1) * run_blocks - 1
    runs = runs.select(
        *keys, RUN, "_n_true", "_n_pred",
        F.struct(F.when(ends, F.col("_t.exit")).otherwise(F.array_repeat(F.lit(0).cast("long"), width)).alias("exit"), F.col("_t.matched").alias("matched")).alias("_t"),
    )
    whole = _chain(runs, list(keys), RUN, F.lit(0), width)
    return whole.select(*keys, F.col("_n_true").alias("n_true"), F.col("_n_pred").alias("n_pred"), F.get("_t.matched", F.lit(0)).alias("matched"))


def _chain(tables: DataFrame, series: list[str], order: str, first: Column, width: int) -> DataFrame:
    """The tables (``_t``: what leaves and what was matched, by what entered) of a series as one, entered at its place ``first``.

    Between places that do not follow each other no candidate lies, so everything is free again (entry 0). Tables of a group are few: those of
    the blocks of one run, or the runs of a series.
    """
    zero = F.lit(0).cast("long")

    def step(state, table):
        follows = state["at"] + 1 == table["at"]
        entry = F.when(follows, state["exit"]).otherwise(F.array_repeat(zero, width))
        return F.struct(
            table["at"].alias("at"),
            F.transform(entry, lambda e: F.get(table["t"]["exit"], e.cast("int"))).alias("exit"),
            F.zip_with(state["matched"], entry, lambda m, e: m + F.get(table["t"]["matched"], e.cast("int"))).alias("matched"),
        )

    grouped = tables.groupBy(*series).agg(
        F.sum("_n_true").cast("long").alias("_n_true"),
        F.sum("_n_pred").cast("long").alias("_n_pred"),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("_t").alias("t")))).alias("_b"),
    )
    start = F.struct((first - 1).cast("long").alias("at"), F.sequence(zero, F.lit(width - 1).cast("long")).alias("exit"), F.array_repeat(zero, width).alias("matched"))
    found = grouped.withColumn("_s", F.aggregate("_b", start, step))
    return found.select(*series, "_n_true", "_n_pred", F.col("_s.at").alias("_last"), F.struct(F.col("_s.exit").alias("exit"), F.col("_s.matched").alias("matched")).alias("_t"))


def precision_recall(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, precision, recall, f1`` from match counts; both sides empty scores 1, 1, 1."""
    tp, n_true, n_pred = F.col("matched"), F.col("n_true"), F.col("n_pred")
    nothing = (n_true == 0) & (n_pred == 0)
    precision = F.when(nothing, 1.0).when(n_pred == 0, 0.0).otherwise(tp / n_pred)
    recall = F.when(nothing, 1.0).when((n_pred == 0) | (n_true == 0), 0.0).otherwise(tp / n_true)
    scored = counts.select(*keys, precision.alias("precision"), recall.alias("recall"))
    both = F.col("precision") + F.col("recall")
    return scored.withColumn(
        "f1", F.when(both == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / both)
    )


def boundary_precision_recall(
    truth: DataFrame,
    predicted: DataFrame,
    keys: Sequence[str],
    tolerance: int,
    position: str = "boundary",
    series: DataFrame | None = None,
    block_span: int = BLOCK_SPAN,
) -> DataFrame:
    """Precision, recall and f1 per series.

    ``series`` lists the series to report, so that those with neither truths nor predictions appear;
    without keys there is always one row.
    """
    counts = match_boundaries(truth, predicted, keys, tolerance, position, block_span)
    if not keys:
        counts = counts.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("n_true", "n_pred", "matched")])
    elif series is not None:
        counts = series.select(*keys).distinct().join(counts, list(keys), "left").na.fill(0)
    return precision_recall(counts, keys)
