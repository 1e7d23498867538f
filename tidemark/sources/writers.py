"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_processed(df: DataFrame, path: str, form: str = "parquet", station: str | None = None, groups: int = 0) -> None:
    """The cleaned grid; ``groups`` > 0 spreads stations over that many folders."""
    writer = df
    folders = []
    if station and groups > 0:
        writer = df.withColumn("station_group", F.pmod(F.xxhash64(station), F.lit(groups)).cast("int"))
        folders = ["station_group"]
    _write(writer, path, form, folders)


def write_window_features(windows: DataFrame, path: str, form: str = "parquet") -> None:
    """The feature table with its key columns."""
    _write(windows, path, form)


def write_window_regimes(windows: DataFrame, path: str, form: str = "csv") -> None:
    """Window meta with one ``regime_<model>`` column per model."""
    kept = ["station", "window_scale", "start_idx", "end_idx", "start_time", "end_time"]
    _write(windows.select(*kept, *[c for c in windows.columns if c.startswith("regime_")]), path, form)


def write_reports_json(reports: dict[str, DataFrame], path: str) -> None:
    """One JSON folder per report."""
    for name, table in reports.items():
        table.write.mode("overwrite").json(f"{path}/{name}")


def export_report(report: DataFrame, path: str) -> None:
    """One report as CSV with a header."""
    report.write.mode("overwrite").option("header", True).csv(path)


def _write(df: DataFrame, path: str, form: str, folders: list[str] | None = None) -> None:
    if form not in ("parquet", "csv"):
        raise ValueError(f"unsupported output format: {form!r}")
    writer = df.write.mode("overwrite").partitionBy(*(folders or []))
    if form == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
