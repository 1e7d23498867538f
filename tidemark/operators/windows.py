"""Past-only row windows over a regular grid.

Two physical forms give the same result. *Frames* compute every statistic as a window expression on
blocks with a halo; work is rows x scales. *Hops* copy a row into each window that holds it and
aggregate by (station, window); a hash aggregate that combines before its shuffle, never sorts and
spreads a long station by window. Hops win once windows overlap little.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import quoted
from tidemark.operators.series import BLOCK, BLOCK_ROWS, CORE, core_rows, in_block, with_halo

# Statistics in the order in which feature columns are laid out.
STATS = ("mean", "std", "trend", "energy", "max", "min")
META = ("station", "window_scale", "start_idx", "end_idx", "start_time", "end_time")
MAX_COPIES = 4


def clean_scales(scales: Sequence[int]) -> list[int]:
    return sorted({int(s) for s in scales if int(s) > 0})


def feature_names(columns: Sequence[str], scales: Sequence[int], stats: Sequence[str] = STATS) -> list[str]:
    """Column layout: by scale, then statistic, then input column."""
    return [f"{c}_s{s}_{stat}" for s in clean_scales(scales) for stat in STATS if stat in stats for c in columns]


def filter_stats(names: Sequence[str], stats: Sequence[str]) -> list[str]:
    """Names ending in one of ``stats``; all names if none does."""
    kept = [n for n in names if any(n.endswith(f"_{s}") for s in stats)]
    return kept or list(names)


def multiscale_windows(
    df: DataFrame,
    station: str,
    timestamp: str,
    position: str,
    columns: Sequence[str],
    scales: Sequence[int],
    stride: int,
    stats: Sequence[str] = STATS,
    null_policy: str = "zero",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per window end: ``META`` columns, then ``<column>_s<scale>_<stat>``.

    Window ends are the positions ``max_scale - 1, + stride, ...`` of each station; stations with
    fewer rows than the largest scale have none. ``null_policy='zero'`` writes 0.0 for a statistic
    whose window holds a null (for ``trend``: whose first or last value is null); ``'skip'``
    computes it over the known values.
    """
    scales = clean_scales(scales)
    if not scales:
        raise ValueError("at least one positive window size is needed")
    if stride < 1:
        raise ValueError("stride must be at least 1")
    if null_policy not in ("zero", "skip"):
        raise ValueError(f"unknown null policy: {null_policy!r}")
    form = _hops if scales[-1] <= stride * MAX_COPIES else _frames
    wide = form(df, station, timestamp, position, columns, scales, stride, stats, null_policy, block_rows)
    largest = scales[-1]
    return wide.select(
        F.col(station).alias("station"),
        F.lit(largest).alias("window_scale"),
        (F.col("end_idx") - (largest - 1)).cast("long").alias("start_idx"),
        F.col("end_idx").cast("long").alias("end_idx"),
        "start_time",
        "end_time",
        *feature_names(columns, scales, stats),
    )


def sliding_windows(
    df: DataFrame,
    station: str,
    timestamp: str,
    position: str,
    columns: Sequence[str],
    size: int,
    step: int,
    stats: Sequence[str] = ("mean", "std", "min", "max"),
    null_policy: str = "zero",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Single-scale windows keeping only ``stats`` (all of them if none is known)."""
    kept = tuple(s for s in STATS if s in stats) or STATS
    return multiscale_windows(
        df, station, timestamp, position, columns, [size], step, kept, null_policy, block_rows
    )


def _settle(complete: str, value: str, null_policy: str) -> str:
    if null_policy == "zero":
        return f"coalesce(CASE WHEN {complete} THEN {value} END, 0.0D)"
    return value


def _doubles(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.selectExpr(*map(quoted, keep), *[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in columns])


def _frames(df, station, timestamp, position, columns, scales, stride, stats, null_policy, block_rows):
    largest = scales[-1]
    p, ts = quoted(position), quoted(timestamp)
    frame = with_halo(_doubles(df, [station, position, timestamp], columns), position, block_rows, back=largest - 1)
    order = f"PARTITION BY {quoted(station)}, {quoted(BLOCK)} ORDER BY {p}"
    features = []
    for scale in scales:
        w = f"({order} ROWS BETWEEN {scale - 1} PRECEDING AND CURRENT ROW)"
        for c in columns:
            x = quoted(c)
            forms = {
                "mean": f"avg({x}) OVER {w}",
                "std": f"stddev_pop({x}) OVER {w}",
                "energy": f"avg({x} * {x}) OVER {w}",
                "max": f"max({x}) OVER {w}",
                "min": f"min({x}) OVER {w}",
                "trend": f"{x} - lag({x}, {scale - 1}) OVER ({order})",
            }
            for stat in stats:
                complete = "true" if stat == "trend" else f"count({x}) OVER {w} = {scale}"
                features.append(f"{_settle(complete, forms[stat], null_policy)} AS {quoted(f'{c}_s{scale}_{stat}')}")
    ends = frame.selectExpr(
        quoted(station), quoted(CORE), f"{p} AS end_idx", f"lag({ts}, {largest - 1}) OVER ({order}) AS start_time",
        f"{ts} AS end_time", *features,
    )
    return core_rows(ends.where(f"end_idx >= {largest - 1} AND pmod(end_idx - {largest - 1}, {stride}) = 0"))


def _hop_copies(df: DataFrame, position: str, size: int, stride: int) -> DataFrame:
    """Each row once per window that holds it, with the window's ``end_idx``.

    Window j ends at ``size - 1 + j * stride`` and holds the ``size`` positions up to there.
    """
    p = quoted(position)
    spans = df.selectExpr(
        "*",
        f"greatest(CAST(ceil(({p} - {size - 1}) / {stride}) AS BIGINT), 0L) AS _low",
        f"CAST(floor({p} / {stride}) AS BIGINT) AS _high",
    ).where("_low <= _high")
    ends = f"explode(sequence(_low * {stride} + {size - 1}, _high * {stride} + {size - 1}, CAST({stride} AS BIGINT))) AS end_idx"
    return spans.selectExpr("*", ends).drop("_low", "_high")


def _hops(df, station, timestamp, position, columns, scales, stride, stats, null_policy, block_rows):
    largest = scales[-1]
    p = quoted(position)
    copies = _hop_copies(_doubles(df, [station, position, timestamp], columns), position, largest, stride)
    features = []
    for scale in scales:
        for c in columns:
            x = quoted(c) if scale == largest else f"CASE WHEN {p} > end_idx - {scale} THEN {quoted(c)} END"
            last = f"max(CASE WHEN {p} = end_idx THEN {quoted(c)} END)"
            first = f"max(CASE WHEN {p} = end_idx - {scale - 1} THEN {quoted(c)} END)"
            forms = {
                "mean": f"avg({x})",
                "std": f"stddev_pop({x})",
                "energy": f"avg(({x}) * ({x}))",
                "max": f"max({x})",
                "min": f"min({x})",
                "trend": f"{last} - {first}",
            }
            for stat in stats:
                complete = "true" if stat == "trend" else f"count({x}) = {scale}"
                features.append(f"{_settle(complete, forms[stat], null_policy)} AS {quoted(f'{c}_s{scale}_{stat}')}")
    return (
        copies.groupBy(station, "end_idx")
        .agg(
            F.min(timestamp).alias("start_time"),
            F.max(timestamp).alias("end_time"),
            F.count(F.lit(1)).alias("_rows"),
            *[F.expr(f) for f in features],
        )
        .where(F.col("_rows") == largest)
        .drop("_rows")
    )


def window_median_raw_energy(
    df: DataFrame, station: str, position: str, columns: Sequence[str], size: int, stride: int
) -> DataFrame:
    """``station, end_idx, <c>_median, <c>_energy`` with the un-normalised energy.

    Null readings are skipped; a window without any reading has a null median.
    """
    copies = _hop_copies(df, position, size, stride)
    # A group holds at most ``size`` rows, so ordering its values in memory is bounded.
    return (
        copies.groupBy(F.col(station).alias("station"), "end_idx")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.percentile(c, F.lit(0.5)).alias(f"{c}_median") for c in columns],
            *[F.sum(F.col(c) * F.col(c)).alias(f"{c}_energy") for c in columns],
        )
        .where(F.col("_rows") == size)
        .drop("_rows")
    )


def sequence_stack(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    length: int,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``keys, position, sequence``: the last ``length`` vectors ending at each position."""
    if length <= 1:
        return df.select(*keys, position, F.array(vector).alias("sequence"))
    frame = with_halo(df.select(*keys, position, vector), position, block_rows, back=length - 1)
    w = in_block(keys, position).rowsBetween(-(length - 1), 0)
    stacked = core_rows(frame.withColumn("sequence", F.collect_list(vector).over(w)))
    return stacked.where(F.size("sequence") == length).select(*keys, position, "sequence")
