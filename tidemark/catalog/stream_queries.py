"""Readings to scored windows on a stream, against SQL over the closed bins."""

from __future__ import annotations

import numpy as np

from tidemark.catalog.registry import (
    BY_TYPE, DIRECTIONS, HOUR_US, NUMERIC, aligned_sql, chain, clean_sql, fill_sql, query, rounded, scratch, telemetry, telemetry_sql,
)
from tidemark.catalog.window_queries import stats_sql
from tidemark.operators.hmm import HmmParameters
from tidemark.operators.windows import STATS
from tidemark.params import Columns, Params, Windows
from tidemark.sources.model_store import StoredModels
from tidemark.streaming.windows import score_stream

LATENESS_HOURS, PATIENCE = 2, 200
SCALES, STRIDE = (6, 12), 3
LOW, HIGH = 5.0, 95.0
DECIDING, MIDDLE, SPREAD = "AIR_TEMP_s12_mean", 50.0, 10.0
LIVE = Params(
    columns=Columns(numeric=tuple(NUMERIC), directional=tuple(DIRECTIONS), width="1h"),
    windows=Windows(multiscale=True, scales=SCALES, stride=STRIDE),
)
SMALL, MEDIUM = LIVE.quality.small_gap, LIVE.quality.medium_gap

SIDES = {**{c: c for c in NUMERIC}, "WIND_S": "sin(radians(WIND_DIR))", "WIND_C": "cos(radians(WIND_DIR))"}
FEATURES = [*NUMERIC, "WIND_DIR_SIN", "WIND_DIR_COS"]
LENGTH = "sqrt(WIND_S * WIND_S + WIND_C * WIND_C)"
# A value is open while its gap has no end, lies beyond the fill limit after the last known one and may still be filled.
OPEN = " OR ".join(
    f"""({c}__x IS NULL AND {c}__ni IS NULL AND coalesce(pos - {c}__pi > {SMALL}, true)
     AND CASE WHEN pos - {c}__pi <= {SMALL + MEDIUM} THEN seen - {c}__pi < {PATIENCE} ELSE pos + {SMALL} > seen END)"""
    for c in SIDES
)
VALUES = [v for s in SCALES for v in stats_sql(FEATURES, s, STATS)]
NAMES = [v.rpartition(" AS ")[2] for v in VALUES]
ORDER = "PARTITION BY STATION ORDER BY pos"
SQL = chain(
    telemetry_sql(BY_TYPE),
    clean_sql(),
    f"""closed AS (SELECT * FROM clean WHERE (epoch_us(DATE) // {HOUR_US}) * {HOUR_US} + {HOUR_US}
  <= (SELECT max(epoch_us(DATE)) FROM clean) // 1000 * 1000 - {LATENESS_HOURS * HOUR_US})""",
    aligned_sql(1, source="closed"),
    fill_sql(SIDES, SMALL, MEDIUM),
    f"""ends AS (SELECT STATION, max(pos) AS seen FROM aligned GROUP BY 1),
open_from AS (SELECT STATION, min(CASE WHEN {OPEN} THEN pos END) AS first_open FROM filled__k JOIN ends USING (STATION) GROUP BY 1),
features AS (SELECT STATION, DATE, pos, WIND_SPEED, SEA_LVL_PRES, CASE WHEN AIR_TEMP IS NOT NULL THEN least(greatest(AIR_TEMP, {LOW}), {HIGH}) END AS AIR_TEMP, WAVE_HGT,
  WIND_S / {LENGTH} AS WIND_DIR_SIN, WIND_C / {LENGTH} AS WIND_DIR_COS
  FROM filled),
wins AS (SELECT STATION AS station, pos AS end_idx, DATE AS end_time, lag(DATE, {SCALES[-1] - 1}) OVER ({ORDER}) AS start_time, {", ".join(VALUES)}
  FROM features)""",
) + f"""SELECT station, {SCALES[-1]} AS window_scale, end_idx - {SCALES[-1] - 1} AS start_idx, end_idx, start_time, end_time, {rounded(*NAMES)},
  CAST({DECIDING} > {MIDDLE} AS INTEGER) AS micro_state, CAST({DECIDING} > {MIDDLE} AS INTEGER) AS macro_state
FROM wins JOIN open_from USING (station)
WHERE end_idx >= {SCALES[-1] - 1} AND (end_idx - {SCALES[-1] - 1}) % {STRIDE} = 0 AND end_idx < coalesce(first_open, end_idx + 1)"""


def planted_models(spark) -> StoredModels:
    """Two states that the mean air temperature tells apart, and bounds for one column."""
    even = np.full((2, 2), 0.5)
    return StoredModels(
        spark.createDataFrame([(DECIDING, MIDDLE, SPREAD)], "column string, mean double, scale double"),
        HmmParameters(np.array([0.5, 0.5]), even, np.array([[-1.0], [1.0]]), np.array([[1.0], [1.0]])),
        {"window_features": [DECIDING], "numeric": NUMERIC, "directional": DIRECTIONS},
        spark.createDataFrame([("AIR_TEMP", LOW, HIGH)], "column string, clip_low double, clip_high double"),
    )


@query("stream_windows", SQL)
def stream_windows_query(spark, sf_dir):
    rows, folder = telemetry(spark, sf_dir, "event_type").drop("event_id"), scratch(spark, "live")
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    return spark.read.parquet(score_stream(stream, LIVE, planted_models(spark), folder, f"{LATENESS_HOURS} hours", PATIENCE))
