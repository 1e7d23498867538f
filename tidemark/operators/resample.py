"""Irregular station readings to a regular grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import present, quoted
from tidemark.functions.times import DAY, common_step, from_micros, is_zoneless, to_micros, width_micros
from tidemark.operators.series import BLOCK_ROWS, spread_join
from tidemark.session import stage

# About 40 bytes per station, so the broadcast stays near 8 MB.
BROADCAST_STATIONS = 200_000


def _floor_to(micros: Column, step: int) -> Column:
    return micros - F.pmod(micros, F.lit(step))


def _parts(numeric: Sequence[str], directional: Sequence[str]) -> dict[str, str]:
    """Averaged quantities: a numeric column is one, a direction is the two sides of its angle."""
    parts = {f"{c}__x": quoted(c) for c in numeric}
    for c in directional:
        parts[f"{c}__sin"] = f"sin(radians({quoted(c)}))"
        parts[f"{c}__cos"] = f"cos(radians({quoted(c)}))"
    return parts


def _mean(name: str) -> str:
    total, n = quoted(f"{name}_sum"), quoted(f"{name}_n")
    return f"CASE WHEN {n} > 0 THEN {total} / {n} END"


def station_spans(df: DataFrame, station: str, timestamp: str, width: str) -> DataFrame:
    """Per station: the first bin, in microseconds, and the number of bins up to the last one.

    Bins are left-closed and start at midnight of the station's first day.
    """
    step = width_micros(width)
    micros = to_micros(F.col(timestamp), is_zoneless(df, timestamp))
    return (
        df.where(F.col(station).isNotNull() & F.col(timestamp).isNotNull())
        .groupBy(station)
        .agg(F.min(micros).alias("_min"), F.max(micros).alias("_max"))
        .withColumn("_anchor", _floor_to(F.col("_min"), DAY))
        .withColumn("_first", F.col("_anchor") + _floor_to(F.col("_min") - F.col("_anchor"), step))
        .select(
            station,
            "_anchor",
            "_first",
            (F.floor((F.col("_max") - F.col("_first")) / F.lit(step)) + 1).cast("long").alias("_bins"),
        )
    )


def _held_spans(df: DataFrame, station: str, timestamp: str, width: str) -> DataFrame:
    return stage(station_spans(df, station, timestamp, width), "spans")


def densify_grid(
    df: DataFrame, station: str, timestamp: str, width: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every bin between a station's first and last reading: ``station, pos, timestamp``.

    The bins of one station are produced block by block, so a long station is spread over tasks.
    """
    return _grid(df, station, timestamp, width, block_rows).select(
        station, "pos", from_micros(F.col("_bin"), is_zoneless(df, timestamp)).alias(timestamp)
    )


def _grid(df: DataFrame, station: str, timestamp: str, width: str, block_rows: int, spans: DataFrame | None = None) -> DataFrame:
    step = width_micros(width)
    blocks = (station_spans(df, station, timestamp, width) if spans is None else spans).select(
        station,
        "_first",
        "_bins",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_bins") - 1) / block_rows))).alias("_part"),
    )
    first_pos = F.col("_part") * block_rows
    last_pos = F.least(first_pos + block_rows, F.col("_bins")) - 1
    return (
        blocks.repartition(station, "_part")
        .select(station, "_first", F.explode(F.sequence(first_pos, last_pos)).alias("pos"))
        .select(station, "pos", (F.col("_first") + F.col("pos") * step).alias("_bin"))
    )


def bin_means(
    df: DataFrame,
    station: str,
    timestamp: str,
    numeric: Sequence[str],
    directional: Sequence[str],
    width: str,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Mean per (station, bin) for bins that hold readings; key column ``_bin`` in microseconds.

    A width that divides a day needs no knowledge of the station's first day. Other widths need it:
    with few enough stations their first days are broadcast, otherwise readings are first combined
    on a step that divides both the width and a day and only then meet their station's first day.
    ``spans`` is ``station_spans`` of the same readings, stored, where the caller has it already.
    """
    step = width_micros(width)
    fine = common_step(step, DAY)
    micros = to_micros(F.col(timestamp), is_zoneless(df, timestamp))
    rows = df.where(F.col(station).isNotNull() & F.col(timestamp).isNotNull())
    parts = _parts(numeric, directional)

    def totals(source: DataFrame, bins: Column) -> DataFrame:
        return source.groupBy(station, bins.alias("_bin")).agg(
            *[F.expr(f"sum({e}) AS {quoted(n + '_sum')}") for n, e in parts.items()],
            *[F.expr(f"count({e}) AS {quoted(n + '_n')}") for n, e in parts.items()],
        )

    if fine == step:
        sums = totals(rows, _floor_to(micros, step))
    else:
        spans = (_held_spans(df, station, timestamp, width) if spans is None else spans).select(station, "_anchor")
        if spans.count() <= BROADCAST_STATIONS:
            own_bin = F.col("_anchor") + _floor_to(micros - F.col("_anchor"), step)
            sums = totals(rows.join(F.broadcast(spans), station), own_bin)
        else:
            own_bin = F.col("_anchor") + _floor_to(F.col("_fine") - F.col("_anchor"), step)
            names = [quoted(f"{n}_{kind}") for n in parts for kind in ("sum", "n")]
            fine_sums = totals(rows, _floor_to(micros, fine)).withColumnRenamed("_bin", "_fine")
            sums = (
                spread_join(fine_sums, spans, [station], ["_fine"])
                .groupBy(station, own_bin.alias("_bin"))
                .agg(*[F.expr(f"sum({t}) AS {t}") for t in names])
            )
    means = [f"{_mean(c + '__x')} AS {quoted(c)}" for c in numeric]
    for c in directional:
        angle = f"degrees(atan2({_mean(c + '__sin')}, {_mean(c + '__cos')})) + 360.0D"
        means.append(f"pmod({angle}, 360.0D) AS {quoted(c)}")
    return sums.selectExpr(quoted(station), "_bin", *means)


def resample_mean(
    df: DataFrame,
    station: str,
    timestamp: str,
    numeric: Sequence[str],
    directional: Sequence[str] = (),
    width: str = "1h",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Regular grid per station: ``station, timestamp, pos, <numeric>, <directional>``.

    Numeric columns get the mean of their non-null readings, directional columns the circular mean;
    bins without readings stay as null rows. ``pos`` counts bins from 0 within the station.
    """
    if not numeric:
        raise ValueError("at least one numeric column is needed for resampling")
    numeric, directional = present(df, numeric), present(df, directional)
    # The means need the spans too where bins do not divide a day; then the readings are read for them once.
    anchored = common_step(width_micros(width), DAY) != width_micros(width)
    spans = _held_spans(df, station, timestamp, width) if anchored else None
    means = bin_means(df, station, timestamp, numeric, directional, width, spans)
    return (
        _grid(df, station, timestamp, width, block_rows, spans)
        .join(means, [station, "_bin"], "left")
        .select(
            station,
            from_micros(F.col("_bin"), is_zoneless(df, timestamp)).alias(timestamp),
            "pos",
            *numeric,
            *directional,
        )
    )


def circular_mean(
    df: DataFrame, station: str, timestamp: str, directional: Sequence[str], width: str
) -> DataFrame:
    """Circular mean per filled bin: ``station, timestamp, <directional>``."""
    means = bin_means(df, station, timestamp, (), directional, width)
    return means.select(
        station, from_micros(F.col("_bin"), is_zoneless(df, timestamp)).alias(timestamp), *directional
    )
