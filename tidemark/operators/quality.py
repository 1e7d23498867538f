"""Clipping, missing-value ratios and the combined cleaning step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles
from tidemark.functions.scalars import encode_direction, present
from tidemark.operators.gaps import gap_fill
from tidemark.operators.series import BLOCK_ROWS
from tidemark.params import Quality


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, column, value`` with one row per input row and column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, F.inline(pairs))


def clip_bounds(df: DataFrame, columns: Sequence[str], low: float, high: float) -> DataFrame:
    """``column, clip_low, clip_high``: quantiles over all stations together."""
    found = exact_quantiles(long_form(df, columns), ["column"], "value", [low, high], few_keys=True)
    return found.select(
        "column", F.col("q")[0].alias("clip_low"), F.col("q")[1].alias("clip_high")
    )


def apply_clip(df: DataFrame, columns: Sequence[str], bounds: DataFrame) -> DataFrame:
    """Clamp ``columns`` to ``bounds``; null stays null and a column without bounds is unchanged."""
    table = bounds.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("clip_low", "clip_high")))).alias("m")
    ).scalar()

    def clamp(name: str) -> Column:
        low, high = table[name]["clip_low"], table[name]["clip_high"]
        x = F.col(name)
        return F.when(x < low, low).when(x > high, high).otherwise(x)

    return df.withColumns({c: clamp(c) for c in columns})


def clip_outliers(df: DataFrame, columns: Sequence[str], low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """Clipped rows and the bounds used."""
    bounds = clip_bounds(df, columns, low, high)
    return apply_clip(df, columns, bounds), bounds


def missing_ratio(df: DataFrame, columns: Sequence[str], name: str = "missing_ratio") -> DataFrame:
    """``column, <name>``: share of null per column."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns])
    return shares.select(F.inline(pairs))


def quality_preprocess(
    df: DataFrame,
    station: str,
    position: str,
    numeric: Sequence[str],
    directional: Sequence[str],
    settings: Quality = Quality(),
    block_rows: int = BLOCK_ROWS,
    bounds: DataFrame | None = None,
    between=lambda frame: frame,
) -> tuple[DataFrame, DataFrame]:
    """Fill, encode, clip. Returns the cleaned grid and its quality report.

    The report is ``column, missing_before, missing_after, clip_low, clip_high``. Given ``bounds``
    (stored by a training run) are applied instead of recomputed. ``between`` receives the filled
    grid, which is read several times below; a run passes a function that writes it once.
    """
    numeric, directional = present(df, numeric), present(df, directional)
    filled = between(
        encode_direction(
            gap_fill(
                df, [station], position, numeric, directional, settings.small_gap, settings.medium_gap,
                settings.drop_large_gap_rows, block_rows,
            ),
            directional,
        )
    )
    if bounds is None:
        bounds = clip_bounds(filled, numeric, settings.clip_low, settings.clip_high)
    cleaned = apply_clip(filled, numeric, bounds)
    report = (
        missing_ratio(df, numeric, "missing_before")
        .join(missing_ratio(filled, numeric, "missing_after"), "column")
        .join(bounds, "column", "left")
    )
    return cleaned, report


def final_quality_flags(cleaned: DataFrame, windows: DataFrame, numeric: Sequence[str], features: Sequence[str], window_features: Sequence[str]) -> DataFrame:
    """One row: feature counts, window count, and whether any numeric value is still null."""
    any_null = F.max(F.greatest(*[F.col(c).isNull().cast("int") for c in numeric], F.lit(0)))
    nulls = cleaned.agg((any_null == 1).alias("final_has_nan"))
    counted = windows.agg(F.count(F.lit(1)).alias("window_count"))
    return counted.select(
        F.lit(len(features)).alias("final_model_feature_count"),
        F.lit(len(window_features)).alias("window_feature_dimension"),
        "window_count",
        nulls.scalar().alias("final_has_nan"),
    )
