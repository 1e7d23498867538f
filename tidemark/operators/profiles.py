"""Per-regime descriptions of labelled windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import columns_like, first_mean_column, numeric_columns
from tidemark.functions.times import duration_hours, to_micros

# Regime names from the calmest to the roughest, and the measures that rank them.
REGIME_NAMES = ("calm regime", "rough sea regime", "storm regime")
SEVERITY_PREFIXES = ("WAVE_HGT", "WIND_SPEED", "SEA_LVL_PRES")


def regime_profiles(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> DataFrame:
    """``regime`` and the mean of every numeric feature."""
    features = numeric_columns(df, {label, *exclude})
    return df.groupBy(F.col(label).cast("int").alias("regime")).agg(*[F.avg(c).alias(c) for c in features])


def regime_frame(windows: DataFrame, label: str, name: str = "regime_id") -> DataFrame:
    """Window meta, the regime id, the ``_mean`` features and the window length in hours."""
    means = [c for c in windows.columns if c.endswith("_mean")]
    return windows.select(
        "station", "window_scale", "start_idx", "end_idx", "start_time", "end_time",
        F.col(label).cast("int").alias(name),
        *means,
        duration_hours(F.col("start_time"), F.col("end_time")).alias("duration_hours"),
    )


def semantic_regime_names(frame: DataFrame, label: str = "regime_id") -> DataFrame:
    """``regime_id, severity, regime_name``: regimes ranked by the mean of their severity measures."""
    measures = [m for m in (first_mean_column(frame.columns, p) for p in SEVERITY_PREFIXES) if m]
    measures = measures or [c for c in frame.columns if c.endswith("_mean")][:5]
    if not measures:
        raise ValueError("no _mean feature to rank regimes by")
    means = frame.groupBy(F.col(label).alias("regime_id")).agg(*[F.avg(m).alias(m) for m in measures])
    known = sum((F.col(m).isNotNull().cast("int") for m in measures), F.lit(0))
    total = sum((F.coalesce(F.col(m), F.lit(0.0)) for m in measures), F.lit(0.0))
    scored = means.select("regime_id", F.when(known > 0, total / known).alias("severity"))
    # One row per regime.
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("severity"), "regime_id"))
    title = F.concat(F.lit("high-variance regime "), F.col("_rank").cast("string"))
    for place, text in reversed(list(enumerate(REGIME_NAMES, start=1))):
        title = F.when(F.col("_rank") == place, text).otherwise(title)
    return scored.withColumn("_rank", rank).withColumn("regime_name", title).drop("_rank")


def regime_summary_table(frame: DataFrame, names: DataFrame, features: Sequence[str]) -> DataFrame:
    """Windows, mean length and mean features per regime, most frequent first."""
    features = [c for c in features if c in frame.columns]
    summary = frame.groupBy("regime_id").agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.avg("duration_hours").alias("avg_window_duration_hr"),
        *[F.avg(c).alias(f"mean_{c}") for c in features],
    )
    return (
        summary.join(names.select("regime_id", "regime_name"), "regime_id")
        .select("regime_id", "regime_name", "n_windows", "avg_window_duration_hr", *[f"mean_{c}" for c in features])
        .orderBy(F.desc("n_windows"), "regime_id")
    )


def regime_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label)).agg(F.count(F.lit(1)).alias("count")).orderBy(label)


def crosstab_micro_macro(df: DataFrame, micro: str, macro: str, macro_values: Sequence[int]) -> DataFrame:
    """One row per micro state, one count column ``macro_<id>`` per macro state; a state that is not listed is refused."""
    listed = F.col(macro).isNull() | F.col(macro).isin(list(macro_values))
    refused = F.raise_error(F.concat(F.lit("macro state without a column: "), F.col(macro).cast("string")))
    rows = df.select(F.col(micro).alias("micro"), F.when(listed, F.col(macro)).otherwise(refused).alias("_macro"))
    return rows.groupBy("micro").agg(*[F.count(F.when(F.col("_macro") == v, 1)).alias(f"macro_{v}") for v in macro_values])


def regime_timeline_frame(windows: DataFrame, label: str) -> DataFrame:
    """Interval rows for a timeline chart."""
    return windows.select(
        "station", "start_time", "end_time", "start_idx", "end_idx", F.col(label).cast("string").alias("regime")
    )


def sensor_series_frame(windows: DataFrame, prefix: str, label: str) -> DataFrame:
    """Time-ordered values of the first ``<prefix>_*_mean`` column with their regime."""
    column = first_mean_column(windows.columns, prefix)
    if column is None:
        raise ValueError(f"no {prefix}_*_mean column")
    return windows.select(
        "station", "start_time", "end_time", F.col(column).alias("value"), F.col(label).cast("string").alias("regime")
    )


def hierarchy_timeline_frame(windows: DataFrame, macro: str, micro: str) -> DataFrame:
    """Each window twice, once per level."""
    levels = F.array(
        F.struct(F.lit("Macro").alias("level"), F.col(macro).cast("string").alias("state")),
        F.struct(F.lit("Micro").alias("level"), F.col(micro).cast("string").alias("state")),
    )
    return windows.select("station", "start_time", "end_time", "start_idx", "end_idx", F.inline(levels))


def mean_columns(names: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """First ``_mean`` column of each prefix that has one."""
    return [columns_like(names, p)[0] for p in prefixes if columns_like(names, p)]


def map_micro_to_macro(df: DataFrame, micro: str, mapping: DataFrame, name: str = "macro_state") -> DataFrame:
    """Adds the macro id of each micro id; a micro id without a macro id is an error.

    ``mapping`` has ``micro_state, macro_state``, one row per state of a fitted model.
    """
    pairs = mapping.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("micro_state").cast("int"), F.col("macro_state").cast("int"))))
    ).scalar()
    macro = F.element_at(pairs, F.col(micro).cast("int"))
    missing = F.raise_error(F.concat(F.lit("no macro state for micro state "), F.col(micro).cast("string"))).cast("int")
    return df.withColumn(name, F.when(macro.isNull(), missing).otherwise(macro))


def share_of_group(counts: DataFrame, group: Sequence[str], count: str = "count", name: str = "share") -> DataFrame:
    total = F.sum(count).over(Window.partitionBy(*group))
    return counts.withColumn(name, F.col(count) / total)


def argmax_per_group(df: DataFrame, group: Sequence[str], value: str, tie: Sequence[str]) -> DataFrame:
    """The row with the largest ``value`` per group; ties go to the smallest ``tie`` columns.

    An aggregate over structs combines before the shuffle, so a very frequent group is no bottleneck.
    """
    kind = df.schema[value].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        rank = -to_micros(F.col(value), isinstance(kind, T.TimestampNTZType))
    else:
        rank = -F.col(value)
    rest = [c for c in df.columns if c not in set(group) and c not in set(tie)]
    best = F.min(F.struct(rank.alias("_rank"), *tie, *rest))
    ranked = df.where(F.col(value).isNotNull())
    return ranked.groupBy(*group).agg(best.alias("_best")).select(*group, "_best.*").select(*df.columns)
