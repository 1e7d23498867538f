"""Reading telemetry and bringing it into the expected shape."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import numeric_columns, present

DEFAULT_STATION = "STATION_0"
FEWEST_FEATURES = 4
BYTE_ORDER_MARK = "﻿"


class IngestError(ValueError):
    """The input cannot be used as telemetry."""


def scan_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A ``.csv`` or ``.parquet`` file or folder.

    CSV columns are read as text unless a schema is given, so that station codes such as ``0042``
    stay intact; ``typed`` turns the measurement columns into numbers.
    """
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in (".csv", ".parquet"):
        raise IngestError(f"unsupported dataset format {suffix!r}, expected .csv or .parquet")
    try:
        if suffix == ".parquet":
            return spark.read.parquet(path)
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader).csv(path)
    except AnalysisException as missing:
        raise IngestError(f"input dataset not found: {path}") from missing


def typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text measurements as doubles; text that is no number becomes null."""
    text = [f.name for f in df.schema.fields if f.name in set(columns) and isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.col(c).try_cast("double") for c in text}) if text else df


def ingest_clean(
    df: DataFrame, timestamp: str, station: str, expected: Sequence[str] = (), strict: bool = False, check_rows: bool = True
) -> DataFrame:
    """Parsed timestamps, rows without one dropped.

    ``strict`` demands every expected column. Rows are not sorted here; every ordered operator
    states its own order.
    """
    missing = sorted({timestamp, station, *expected} - set(df.columns))
    if missing and (strict or timestamp in missing or station in missing):
        raise IngestError(f"missing required columns: {missing}")
    if isinstance(df.schema[timestamp].dataType, (T.StringType, T.DateType)):
        df = df.withColumn(timestamp, F.try_to_timestamp(F.col(timestamp).cast("string")))
    if not isinstance(df.schema[station].dataType, T.StringType):
        df = df.withColumn(station, F.col(station).cast("string"))
    df = typed(df.where(F.col(timestamp).isNotNull()), expected)
    if check_rows and df.select(timestamp).isEmpty():
        raise IngestError("no row has a valid timestamp")
    return df


def scan_pruned_capped(
    df: DataFrame, columns: Sequence[str], cap: int, order_by: Sequence[str], last: bool = True
) -> DataFrame:
    """The first or last ``cap`` rows in ``order_by`` order, with only the needed columns."""
    kept = present(df, columns)
    order = [F.desc(c) if last else F.asc(c) for c in order_by]
    return df.orderBy(*order).limit(cap).select(*kept)


def _squeezed(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "", name).upper()


def _matching(names: Sequence[str], wanted: str) -> str | None:
    if wanted in names:
        return wanted
    for form in (str.lower, _squeezed):
        found = [n for n in names if form(n) == form(wanted)]
        if found:
            return found[-1]
    return None


def normalize_headers(df: DataFrame, station: str, timestamp: str) -> DataFrame:
    """Trimmed names without a byte order mark; station and timestamp found in any spelling.

    A table without a station column gets the constant ``STATION_0``.
    """
    names = [c.strip().lstrip(BYTE_ORDER_MARK) for c in df.columns]
    renames = {_matching(names, wanted): wanted for wanted in (station, timestamp)}
    named = df.toDF(*[renames.get(n, n) for n in names])
    return named if station in named.columns else named.withColumn(station, F.lit(DEFAULT_STATION))


def align_schema(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Expected columns that are absent are added as null."""
    absent = [c for c in columns if c not in set(df.columns)]
    return df.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else df


def select_features(df: DataFrame, numeric: Sequence[str], station: str) -> list[str]:
    """The configured columns that are present (at least four), or every numeric column if none is configured."""
    if not numeric:
        return numeric_columns(df, {station})
    found = present(df, numeric)
    if len(found) < FEWEST_FEATURES:
        raise IngestError(f"too few configured features present: {found}")
    return found


def model_features(numeric: Sequence[str], directional: Sequence[str], available: Sequence[str]) -> list[str]:
    """Numeric features, then every direction's sine, then every cosine, without repeats."""
    encoded = [f"{c}_SIN" for c in directional] + [f"{c}_COS" for c in directional]
    return list(dict.fromkeys([*numeric, *[c for c in encoded if c in set(available)]]))
