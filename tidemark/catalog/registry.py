"""The register and the shared pieces of SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# Microseconds of the bin widths used in the checks.
HOUR_US = 3_600_000_000
# Means of short decimals often end in an exact half at the seventh place, which two engines may round
# apart after summing in different orders. Both sides shift by this much before rounding.
DIGITS = 6
NUDGE = "0.0000000314159"


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` with the SQL that must give the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return settle(function(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


def settle(df: DataFrame) -> DataFrame:
    """Doubles to six decimals without negative zero, zoned timestamps to zone-less."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c + F.lit(float(NUDGE)), DIGITS) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def rounded(*columns: str) -> str:
    """SQL list of ``round(c, 6) + 0.0 AS c``; ``expression AS name`` is taken apart."""
    out = []
    for c in columns:
        expression, _, name = c.rpartition(" AS ")
        out.append(f"round(CAST({expression or name} AS DOUBLE) + CAST({NUDGE} AS DOUBLE), {DIGITS}) + 0.0 AS {name}")
    return ", ".join(out)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(shared_dir(spark), "queries", f"{name}-{uuid.uuid4().hex}")


# ---- telemetry views ------------------------------------------------------------------------

NUMERIC = ["WIND_SPEED", "SEA_LVL_PRES", "AIR_TEMP", "WAVE_HGT"]
DIRECTIONS = ["WIND_DIR"]
BY_USER = "CAST(user_id AS VARCHAR)"
BY_TYPE = "event_type"


def telemetry(spark: SparkSession, sf_dir: str, by: str = "user_id") -> DataFrame:
    """``events`` as telemetry; ``by`` is the column that plays the station."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("double")
    return table(spark, sf_dir, "events").select(
        F.col(by).cast("string").alias("STATION"),
        F.col("ts").alias("DATE"),
        F.col("value").alias("WIND_SPEED"),
        (k + 1000).alias("SEA_LVL_PRES"),
        k.alias("AIR_TEMP"),
        ((F.col("event_id") % 97) / 10.0).alias("WAVE_HGT"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("WIND_DIR"),
        "event_id",
    )


def telemetry_sql(station: str = BY_USER) -> str:
    return f"""telemetry AS (
  SELECT {station} AS STATION, ts AS DATE, value AS WIND_SPEED, k + 1000 AS SEA_LVL_PRES, k AS AIR_TEMP,
         CAST(event_id % 97 AS DOUBLE) / 10 AS WAVE_HGT, CAST((event_id * 37) % 360 AS DOUBLE) AS WIND_DIR, event_id
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS k FROM events))"""


def clean_sql(columns: Sequence[str] = (*NUMERIC, *DIRECTIONS)) -> str:
    replaced = ", ".join(f"CASE WHEN {c} IN (99, 999, 9999, 99999) THEN NULL ELSE {c} END AS {c}" for c in columns)
    return f"clean AS (SELECT STATION, DATE, {replaced} FROM telemetry)"


def aligned_sql(
    hours: int, numeric: Sequence[str] = NUMERIC, directions: Sequence[str] = DIRECTIONS, source: str = "clean"
) -> str:
    width = hours * HOUR_US
    means = [f"avg({c}) AS {c}" for c in numeric]
    means += [f"avg(sin(radians({c}))) AS {c}__s, avg(cos(radians({c}))) AS {c}__c" for c in directions]
    shown = list(numeric)
    shown += [f"(degrees(atan2({c}__s, {c}__c)) + 360) % 360 AS {c}" for c in directions]
    return f"""spans AS (
  SELECT STATION, epoch_us(date_trunc('day', min(DATE))) AS a, epoch_us(min(DATE)) AS mn, epoch_us(max(DATE)) AS mx
  FROM {source} GROUP BY STATION),
binned AS (
  SELECT t.STATION, a + ((epoch_us(DATE) - a) // {width}) * {width} AS bin, {", ".join(means)}
  FROM {source} t JOIN spans USING (STATION) GROUP BY 1, 2),
grid AS (
  SELECT STATION, unnest(range(a + ((mn - a) // {width}) * {width}, mx + 1, {width})) AS bin FROM spans),
aligned AS (
  SELECT g.STATION, make_timestamp(g.bin) AS DATE,
         row_number() OVER (PARTITION BY g.STATION ORDER BY g.bin) - 1 AS pos, {", ".join(shown)}
  FROM grid g LEFT JOIN binned b ON g.STATION = b.STATION AND g.bin = b.bin)"""


def fill_sql(
    columns: dict[str, str], small: int, medium: int, source: str = "aligned", name: str = "filled", keep: str = "STATION, DATE, pos"
) -> str:
    """Three bounded fills of ``columns`` (output name to input expression) by their closed form."""
    up = "OVER (PARTITION BY STATION ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = "OVER (PARTITION BY STATION ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    raw = ", ".join(f"{e} AS {c}__x" for c, e in columns.items())
    seen = ", ".join(
        f"max(CASE WHEN {c}__x IS NOT NULL THEN pos END) {up} AS {c}__pi, last_value({c}__x IGNORE NULLS) {up} AS {c}__pv, "
        f"min(CASE WHEN {c}__x IS NOT NULL THEN pos END) {down} AS {c}__ni, first_value({c}__x IGNORE NULLS) {down} AS {c}__nv"
        for c in columns
    )
    out = ", ".join(
        f"""CASE WHEN {c}__x IS NOT NULL THEN {c}__x
     WHEN pos - {c}__pi <= {small} THEN {c}__pv
     WHEN {c}__ni - pos <= {small} THEN {c}__nv
     WHEN {c}__pi IS NULL OR pos - {c}__pi > {small + medium} THEN NULL
     WHEN {c}__ni IS NULL THEN {c}__pv
     ELSE {c}__pv + ({c}__nv - {c}__pv) * (pos - ({c}__pi + {small})) / CAST(({c}__ni - {small}) - ({c}__pi + {small}) AS DOUBLE)
     END AS {c}"""
        for c in columns
    )
    return f"""{name}__r AS (SELECT *, {raw} FROM {source}),
{name}__k AS (SELECT *, {seen} FROM {name}__r),
{name} AS (SELECT {keep}, {out} FROM {name}__k)"""


def chain(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


GRID_12H = (telemetry_sql(), clean_sql(), aligned_sql(12))
