"""Resampling, gap filling and cleaning."""

from __future__ import annotations

from tidemark.catalog.registry import (
    BY_TYPE, DIRECTIONS, GRID_12H, NUMERIC, aligned_sql, chain, clean_sql, fill_sql, query, rounded, telemetry,
    telemetry_sql,
)
from tidemark.functions.scalars import sentinel_to_null
from tidemark.operators.gaps import bfill_limited, circular_gap_fill, ffill_limited, gap_fill, interpolate_linear_limited
from tidemark.operators.quality import apply_clip, clip_bounds, final_quality_flags, missing_ratio, quality_preprocess
from tidemark.operators.resample import circular_mean, densify_grid, resample_mean
from tidemark.operators.windows import feature_names, sliding_windows
from tidemark.params import Quality
from tidemark.session import stage

ALL = [*NUMERIC, *DIRECTIONS]
# Small blocks, so that the checks cover values carried across block borders.
BLOCKS = 16


def clean(spark, sf_dir, by="user_id"):
    return sentinel_to_null(telemetry(spark, sf_dir, by), ALL)


def grid(spark, sf_dir, by="user_id", width="12h"):
    return resample_mean(clean(spark, sf_dir, by), "STATION", "DATE", NUMERIC, DIRECTIONS, width)


@query("resample_mean", chain(telemetry_sql(BY_TYPE), clean_sql(), aligned_sql(1))
       + f"SELECT STATION, DATE, pos, {rounded(*NUMERIC)}, {rounded(*DIRECTIONS)} FROM aligned")
def resample_query(spark, sf_dir):
    return grid(spark, sf_dir, "event_type", "1h")


@query("resample_anchored", chain(telemetry_sql(), clean_sql(), aligned_sql(7))
       + f"SELECT STATION, DATE, pos, {rounded(*NUMERIC)}, {rounded(*DIRECTIONS)} FROM aligned")
def resample_anchored_query(spark, sf_dir):
    return grid(spark, sf_dir, width="7h")


@query("circular_mean", chain(*GRID_12H)
       + f"SELECT STATION, DATE, {rounded(*DIRECTIONS)} FROM aligned WHERE EXISTS (SELECT 1 FROM binned b WHERE b.STATION = aligned.STATION AND b.bin = epoch_us(DATE))")
def circular_mean_query(spark, sf_dir):
    return circular_mean(clean(spark, sf_dir), "STATION", "DATE", DIRECTIONS, "12h")


@query("densify_grid", chain(*GRID_12H) + "SELECT STATION, DATE, pos FROM aligned")
def densify_query(spark, sf_dir):
    return densify_grid(telemetry(spark, sf_dir), "STATION", "DATE", "12h", block_rows=BLOCKS)


@query("ffill_limited", chain(*GRID_12H) + """SELECT STATION, pos, """ + rounded(
    "coalesce(AIR_TEMP, lag(AIR_TEMP, 1) OVER w, lag(AIR_TEMP, 2) OVER w) AS AIR_TEMP")
    + " FROM aligned WINDOW w AS (PARTITION BY STATION ORDER BY pos)")
def ffill_query(spark, sf_dir):
    return ffill_limited(grid(spark, sf_dir), ["STATION"], "pos", ["AIR_TEMP"], 2, BLOCKS).select(
        "STATION", "pos", "AIR_TEMP"
    )


@query("bfill_limited", chain(*GRID_12H) + """SELECT STATION, pos, """ + rounded(
    "coalesce(AIR_TEMP, lead(AIR_TEMP, 1) OVER w, lead(AIR_TEMP, 2) OVER w) AS AIR_TEMP")
    + " FROM aligned WINDOW w AS (PARTITION BY STATION ORDER BY pos)")
def bfill_query(spark, sf_dir):
    return bfill_limited(grid(spark, sf_dir), ["STATION"], "pos", ["AIR_TEMP"], 2, BLOCKS).select(
        "STATION", "pos", "AIR_TEMP"
    )


@query("interpolate_linear_limited", chain(*GRID_12H, fill_sql({"WIND_SPEED": "WIND_SPEED"}, 0, 3))
       + f"SELECT STATION, pos, {rounded('WIND_SPEED')} FROM filled")
def interpolate_query(spark, sf_dir):
    return interpolate_linear_limited(grid(spark, sf_dir), ["STATION"], "pos", ["WIND_SPEED"], 3, BLOCKS).select(
        "STATION", "pos", "WIND_SPEED"
    )


@query("gap_fill", chain(*GRID_12H, fill_sql({c: c for c in NUMERIC}, 1, 2))
       + f"SELECT STATION, DATE, pos, {rounded(*NUMERIC)} FROM filled")
def gap_fill_query(spark, sf_dir):
    return gap_fill(grid(spark, sf_dir), ["STATION"], "pos", NUMERIC, (), 1, 2, block_rows=BLOCKS).select(
        "STATION", "DATE", "pos", *NUMERIC
    )


CIRCLE = {"s": "sin(radians(WIND_DIR))", "c": "cos(radians(WIND_DIR))"}


@query("circular_gap_fill", chain(*GRID_12H, fill_sql(CIRCLE, 1, 2))
       + f"SELECT STATION, pos, {rounded('(degrees(atan2(s, c)) + 360) % 360 AS WIND_DIR')} FROM filled")
def circular_fill_query(spark, sf_dir):
    return circular_gap_fill(grid(spark, sf_dir), ["STATION"], "pos", DIRECTIONS, 1, 2, BLOCKS).select(
        "STATION", "pos", "WIND_DIR"
    )


@query("drop_large_gap_rows", chain(*GRID_12H, fill_sql({**{c: c for c in NUMERIC}, **CIRCLE}, 1, 1))
       + f"SELECT STATION, pos, {rounded(*NUMERIC)} FROM filled WHERE "
       + " AND ".join(f"{c} IS NOT NULL" for c in [*NUMERIC, "s"]))
def drop_rows_query(spark, sf_dir):
    return gap_fill(
        grid(spark, sf_dir), ["STATION"], "pos", NUMERIC, DIRECTIONS, 1, 1, drop_large_gap_rows=True, block_rows=BLOCKS
    ).select("STATION", "pos", *NUMERIC)


@query("missing_ratio", chain(*GRID_12H) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rounded(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing_ratio')} FROM aligned"
    for c in ALL))
def missing_query(spark, sf_dir):
    return missing_ratio(grid(spark, sf_dir), ALL)


def _bounds_sql(source: str, low: float, high: float, columns=tuple(NUMERIC)) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", quantile_cont({c}, {low}) AS clip_low, quantile_cont({c}, {high}) AS clip_high FROM {source}"
        for c in columns
    )
    return f"bounds AS ({rows})"


def _clip_sql(c: str) -> str:
    low = f"(SELECT clip_low FROM bounds WHERE \"column\" = '{c}')"
    high = f"(SELECT clip_high FROM bounds WHERE \"column\" = '{c}')"
    return f"CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END AS {c}"


@query("clip_outliers", chain(telemetry_sql(), clean_sql(), _bounds_sql("clean", 0.005, 0.995))
       + "SELECT STATION, DATE, " + rounded(*[_clip_sql(c) for c in NUMERIC]) + " FROM clean")
def clip_query(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return apply_clip(rows, NUMERIC, clip_bounds(rows, NUMERIC, 0.005, 0.995)).select("STATION", "DATE", *NUMERIC)


@query("quality_preprocess", chain(*GRID_12H, fill_sql({c: c for c in NUMERIC}, 1, 2), _bounds_sql("filled", 0.005, 0.995))
       + "SELECT b.\"column\", " + rounded("missing_before", "missing_after", "clip_low", "clip_high")
       + " FROM bounds b JOIN (" + " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", (SELECT avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM aligned) AS missing_before, "
           f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM filled) AS missing_after" for c in NUMERIC)
       + ") m ON m.\"column\" = b.\"column\"")
def quality_query(spark, sf_dir):
    _, report = quality_preprocess(
        stage(grid(spark, sf_dir), "grid"), "STATION", "pos", NUMERIC, DIRECTIONS, Quality(small_gap=1, medium_gap=2),
        BLOCKS, between=lambda df: stage(df, "filled"),
    )
    return report


@query("final_quality_flags", chain(*GRID_12H, fill_sql({c: c for c in NUMERIC}, 1, 2))
       + """SELECT 4 AS final_model_feature_count, 8 AS window_feature_dimension,
  (SELECT count(*) FROM filled WHERE pos >= 11 AND (pos - 11) % 12 = 0) AS window_count,
  (SELECT bool_or(WIND_SPEED IS NULL OR SEA_LVL_PRES IS NULL OR AIR_TEMP IS NULL OR WAVE_HGT IS NULL) FROM filled) AS final_has_nan""")
def flags_query(spark, sf_dir):
    filled = gap_fill(grid(spark, sf_dir), ["STATION"], "pos", NUMERIC, (), 1, 2)
    stats = ("mean", "std")
    windows = sliding_windows(filled, "STATION", "DATE", "pos", NUMERIC, 12, 12, stats)
    return final_quality_flags(filled, windows, NUMERIC, NUMERIC, feature_names(NUMERIC, [12], stats))
