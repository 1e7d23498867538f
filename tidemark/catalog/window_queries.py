"""Row windows over the grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.grid_queries import BLOCKS, clean, grid
from tidemark.catalog.registry import (
    BY_TYPE, GRID_12H, NUMERIC, aligned_sql, chain, clean_sql, fill_sql, query, rounded, table, telemetry, telemetry_sql,
)
from tidemark.operators.gaps import gap_fill
from tidemark.operators.labels import backfill_head_labels
from tidemark.operators.profiles import argmax_per_group, share_of_group
from tidemark.operators.resample import resample_mean
from tidemark.operators.series import number_rows, previous_values
from tidemark.operators.windows import (
    filter_stats, multiscale_windows, sequence_stack, sliding_windows, window_median_raw_energy,
)

SHOWN = ["WIND_SPEED", "AIR_TEMP"]
FILLED = (*GRID_12H, fill_sql({c: c for c in SHOWN}, 1, 2))
ORDER = "PARTITION BY STATION ORDER BY pos"


def filled(spark, sf_dir):
    return gap_fill(grid(spark, sf_dir), ["STATION"], "pos", SHOWN, (), 1, 2, block_rows=BLOCKS)


def stats_sql(columns, scale: int, stats, policy: str = "zero") -> list[str]:
    """``expression AS name`` for statistics over the last ``scale`` rows."""
    frame = f"OVER ({ORDER} ROWS BETWEEN {scale - 1} PRECEDING AND CURRENT ROW)"
    forms = {
        "mean": f"avg({{c}}) {frame}",
        "std": f"stddev_pop({{c}}) {frame}",
        "trend": f"{{c}} - lag({{c}}, {scale - 1}) OVER ({ORDER})",
        "energy": f"avg({{c}} * {{c}}) {frame}",
        "max": f"max({{c}}) {frame}",
        "min": f"min({{c}}) {frame}",
    }
    out = []
    for stat in stats:
        for c in columns:
            value = forms[stat].format(c=c)
            if policy == "zero" and stat != "trend":
                value = f"CASE WHEN count({c}) {frame} = {scale} THEN {value} END"
            if policy == "zero":
                value = f"coalesce({value}, 0.0)"
            out.append(f"{value} AS {c}_s{scale}_{stat}")
    return out


def windows_sql(columns, scales, stride: int, stats, source: str = "filled", policy: str = "zero") -> str:
    largest = max(scales)
    values = [v for s in sorted(scales) for v in stats_sql(columns, s, stats, policy)]
    names = [v.rpartition(" AS ")[2] for v in values]
    return f"""SELECT station, {largest} AS window_scale, end_idx - {largest - 1} AS start_idx, end_idx, start_time, end_time, {rounded(*names)}
FROM (SELECT STATION AS station, pos AS end_idx, DATE AS end_time, lag(DATE, {largest - 1}) OVER ({ORDER}) AS start_time,
      {", ".join(values)} FROM {source}) t
WHERE end_idx >= {largest - 1} AND (end_idx - {largest - 1}) % {stride} = 0"""


EVERY = ("mean", "std", "trend", "energy", "max", "min")


@query("row_position", chain(telemetry_sql()) + """SELECT event_id, row_number() OVER (PARTITION BY STATION ORDER BY DATE, event_id) - 1 AS pos
FROM telemetry""")
def row_position_query(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    days = {"day": F.date_trunc("day", "DATE")}
    return number_rows(rows, ["STATION"], ["DATE", "event_id"], days).select("event_id", "pos")


@query("window_stats", chain(*FILLED) + windows_sql(SHOWN, [6], 1, EVERY))
def window_stats_query(spark, sf_dir):
    return multiscale_windows(filled(spark, sf_dir), "STATION", "DATE", "pos", SHOWN, [6], 1, block_rows=BLOCKS)


@query("multiscale_windows", chain(*FILLED) + windows_sql(SHOWN, [3, 6, 12], 2, EVERY))
def multiscale_query(spark, sf_dir):
    return multiscale_windows(filled(spark, sf_dir), "STATION", "DATE", "pos", SHOWN, [12, 3, 6, 3, 0], 2, block_rows=BLOCKS)


@query("multiscale_windows_hops", chain(*FILLED) + windows_sql(SHOWN, [3, 6, 12], 4, EVERY))
def multiscale_hops_query(spark, sf_dir):
    return multiscale_windows(filled(spark, sf_dir), "STATION", "DATE", "pos", SHOWN, [3, 6, 12], 4)


@query("sliding_windows", chain(*FILLED) + windows_sql(SHOWN, [12], 6, ("mean", "std", "max", "min")))
def sliding_query(spark, sf_dir):
    return sliding_windows(filled(spark, sf_dir), "STATION", "DATE", "pos", SHOWN, 12, 6)


@query("window_count_tumbling", chain(*FILLED) + windows_sql(SHOWN, [12], 12, ("mean", "std")))
def tumbling_query(spark, sf_dir):
    return sliding_windows(filled(spark, sf_dir), "STATION", "DATE", "pos", SHOWN, 12, 12, ("mean", "std"))


@query("null_poison_zero", chain(*GRID_12H) + windows_sql(["AIR_TEMP"], [4], 1, EVERY, "aligned"))
def null_poison_query(spark, sf_dir):
    return multiscale_windows(grid(spark, sf_dir), "STATION", "DATE", "pos", ["AIR_TEMP"], [4], 1, block_rows=BLOCKS)


@query("null_skip", chain(*GRID_12H) + windows_sql(["AIR_TEMP"], [4], 1, ("mean", "max", "min"), "aligned", "skip"))
def null_skip_query(spark, sf_dir):
    return multiscale_windows(
        grid(spark, sf_dir), "STATION", "DATE", "pos", ["AIR_TEMP"], [4], 1, ("mean", "max", "min"), "skip", BLOCKS
    )


@query("window_meta", chain(*GRID_12H) + """SELECT station, 12 AS window_scale, end_idx - 11 AS start_idx, end_idx, start_time, end_time
FROM (SELECT STATION AS station, pos AS end_idx, DATE AS end_time, lag(DATE, 11) OVER (PARTITION BY STATION ORDER BY pos) AS start_time FROM aligned)
WHERE end_idx >= 11 AND (end_idx - 11) % 2 = 0""")
def window_meta_query(spark, sf_dir):
    windows = multiscale_windows(grid(spark, sf_dir), "STATION", "DATE", "pos", ["AIR_TEMP"], [12], 2, ("mean",), block_rows=BLOCKS)
    return windows.drop("AIR_TEMP_s12_mean")


@query("filter_stats", chain(*FILLED) + windows_sql(SHOWN, [6], 6, ("mean", "max")))
def filter_stats_query(spark, sf_dir):
    windows = multiscale_windows(filled(spark, sf_dir), "STATION", "DATE", "pos", SHOWN, [6], 6)
    meta, features = windows.columns[:6], windows.columns[6:]
    return windows.select(*meta, *filter_stats(features, ["mean", "max"]))


@query("window_median_raw_energy", chain(*GRID_12H) + f"""SELECT STATION AS station, end_idx,
  {rounded("quantile_cont(WIND_SPEED, 0.5) AS WIND_SPEED_median", "sum(WIND_SPEED * WIND_SPEED) AS WIND_SPEED_energy")}
FROM (SELECT a.STATION, b.pos AS end_idx, a.WIND_SPEED FROM aligned a JOIN aligned b ON a.STATION = b.STATION
      AND a.pos BETWEEN b.pos - 7 AND b.pos WHERE b.pos >= 7 AND (b.pos - 7) % 4 = 0) GROUP BY 1, 2""")
def median_query(spark, sf_dir):
    return window_median_raw_energy(grid(spark, sf_dir), "STATION", "pos", ["WIND_SPEED"], 8, 4)


@query("sequence_stack", chain(*FILLED) + """SELECT STATION, pos, unnest(range(4)) AS step, """ + rounded("unnest(sequence) AS wind") + """
FROM (SELECT STATION, pos, list(coalesce(WIND_SPEED, 0)) OVER (PARTITION BY STATION ORDER BY pos ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS sequence FROM filled)
WHERE pos >= 3""")
def sequence_query(spark, sf_dir):
    rows = filled(spark, sf_dir).select("STATION", "pos", F.array(F.coalesce("WIND_SPEED", F.lit(0.0))).alias("v"))
    stacked = sequence_stack(rows, ["STATION"], "pos", "v", 4, BLOCKS)
    return stacked.select("STATION", "pos", F.posexplode("sequence").alias("step", "v")).select(
        "STATION", "pos", F.col("step").cast("long").alias("step"), F.col("v")[0].alias("wind")
    )


@query("backfill_head_labels", chain(*GRID_12H) + """SELECT STATION, pos, CASE WHEN pos < p0 THEN l0 ELSE label END AS label
FROM (SELECT *, min(CASE WHEN label IS NOT NULL THEN pos END) OVER (PARTITION BY STATION) AS p0,
             arg_min(label, pos) FILTER (WHERE label IS NOT NULL) OVER (PARTITION BY STATION) AS l0
      FROM (SELECT STATION, pos, CASE WHEN pos >= 20 THEN CAST(floor(WIND_SPEED / 20) AS INTEGER) END AS label FROM aligned))""")
def backfill_query(spark, sf_dir):
    label = F.when(F.col("pos") >= 20, F.floor(F.col("WIND_SPEED") / 20).cast("int"))
    rows = grid(spark, sf_dir).select("STATION", "pos", label.alias("label"))
    return backfill_head_labels(rows, ["STATION"], "pos", "label", BLOCKS)


@query("diff_rows", chain(*GRID_12H) + f"""SELECT STATION, pos, {rounded("WIND_SPEED - lag(WIND_SPEED) OVER (" + ORDER + ") AS diff")}
FROM aligned""")
def diff_query(spark, sf_dir):
    rows = previous_values(grid(spark, sf_dir), ["STATION"], "pos", ["WIND_SPEED"], BLOCKS)
    return rows.select("STATION", "pos", (F.col("WIND_SPEED") - F.col("prev_WIND_SPEED")).alias("diff"))


@query("share_of_group", f"""SELECT user_id, event_type, n AS count, {rounded("n / sum(n) OVER (PARTITION BY user_id) AS share")}
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)""")
def share_query(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("count"))
    return share_of_group(counts, ["user_id"])


@query("argmax_per_group", f"""SELECT event_type, event_id, {rounded("value")} FROM
(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1""")
def argmax_query(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return argmax_per_group(rows, ["event_type"], "value", ["event_id"])


def regime_features(spark, sf_dir):
    """Windowed regime features per station."""
    rows = resample_mean(clean(spark, sf_dir, "event_type"), "STATION", "DATE", NUMERIC, (), "1h")
    full = gap_fill(rows, ["STATION"], "pos", NUMERIC)
    return sliding_windows(full, "STATION", "DATE", "pos", NUMERIC, 12, 12, ("mean", "std"))


REGIME_FEATURES_SQL = chain(
    telemetry_sql(BY_TYPE), clean_sql(), aligned_sql(1), fill_sql({c: c for c in NUMERIC}, 2, 6)
) + windows_sql(NUMERIC, [12], 12, ("mean", "std"))
query("regime_features", REGIME_FEATURES_SQL)(regime_features)
