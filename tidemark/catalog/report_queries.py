"""Regime descriptions and operational reports.

The windows are four 7-day bins of ``lineitem`` per supplier; micro states are classes of the mean
quantity and macro states pairs of micro states.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.grid_queries import BLOCKS, grid
from tidemark.catalog.registry import CHECKS, GRID_12H, NUMERIC, aligned_sql, chain, query, rounded, scratch, table
from tidemark.catalog.window_queries import windows_sql
from tidemark.functions.times import duration_hours
from tidemark.operators import profiles, reports
from tidemark.operators.labels import label_positions, transition_matrix
from tidemark.operators.resample import resample_mean
from tidemark.operators.windows import sliding_windows
from tidemark.params import Columns, Params
from tidemark.plans.reporting import compose_reports
from tidemark.session import stage
from tidemark.sources.writers import export_report

SENSORS = ["WIND_SPEED", "WAVE_HGT", "SEA_LVL_PRES"]
MEANS = [f"{c}_s4_mean" for c in SENSORS]
WIND, WAVE, PRES = MEANS
MICRO_STATES = 6


def voyage(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("STATION"),
        F.col("l_shipdate").alias("DATE"),
        F.col("l_quantity").cast("double").alias("WIND_SPEED"),
        (F.col("l_extendedprice") / 20000.0).alias("WAVE_HGT"),
        (F.col("l_discount") * 100 + 1000).alias("SEA_LVL_PRES"),
    )


def weekly(spark, sf_dir):
    return resample_mean(voyage(spark, sf_dir), "STATION", "DATE", SENSORS, (), "7d")


def labelled(spark, sf_dir, rows=None):
    rows = weekly(spark, sf_dir) if rows is None else rows
    windows = sliding_windows(rows, "STATION", "DATE", "pos", SENSORS, 4, 4, ("mean",))
    micro = F.least(F.lit(MICRO_STATES - 1), F.greatest(F.lit(0), F.floor((F.col(WIND) - 15) / 4))).cast("int")
    return (
        windows.withColumn("micro_state", micro)
        .withColumn("macro_state", F.floor(F.col("micro_state") / 2).cast("int"))
        .withColumn("duration_hours", duration_hours(F.col("start_time"), F.col("end_time")))
    )


def held(spark, sf_dir, rows=None):
    """The labelled windows written once, for reports that read them several times."""
    return stage(labelled(spark, sf_dir, rows), "labelled")


def scored(spark, sf_dir, rows=None):
    rows = held(spark, sf_dir, rows)
    return reports.name_macro_states(rows, reports.macro_names(rows))


def _plain(sql: str) -> str:
    """Window SQL without the rounding of its outputs."""
    head, _, tail = sql.partition("start_time, end_time, ")
    return head + "start_time, end_time, " + ", ".join(MEANS) + "\nFROM (" + tail.split("\nFROM (", 1)[1]


VOYAGE = (
    """voyage AS (SELECT 'S' || l_suppkey AS STATION, l_shipdate AS DATE, CAST(l_quantity AS DOUBLE) AS WIND_SPEED,
  l_extendedprice / 20000.0 AS WAVE_HGT, l_discount * 100 + 1000 AS SEA_LVL_PRES FROM lineitem)""",
    aligned_sql(24 * 7, SENSORS, (), "voyage"),
    "wins AS (" + _plain(windows_sql(SENSORS, [4], 4, ("mean",), "aligned")) + ")",
    f"""micros AS (SELECT *, CAST(least({MICRO_STATES - 1}, greatest(0, floor(({WIND} - 15) / 4))) AS INTEGER) AS micro_state,
  (epoch_us(end_time) - epoch_us(start_time)) / 3.6e9 AS duration_hours FROM wins)""",
    "macros AS (SELECT *, CAST(micro_state // 2 AS INTEGER) AS macro_state FROM micros)",
    f"""macro_means AS (SELECT macro_state, avg({WAVE}) AS wave, avg({WIND}) AS wind, avg({PRES}) AS pres, avg(duration_hours) AS hours,
  count(*) AS n FROM macros GROUP BY 1)""",
    """names AS (SELECT macro_state, CASE WHEN wave = max(wave) OVER () THEN 'Storm-like' WHEN wind = max(wind) OVER () THEN 'Windy'
  WHEN pres = min(pres) OVER () THEN 'Low-pressure' ELSE 'Regime ' || macro_state END AS macro_state_name FROM macro_means)""",
    "scored AS (SELECT * FROM macros JOIN names USING (macro_state))",
    """severity AS (SELECT *, CASE WHEN severity_score >= 0.66 THEN 'High' WHEN severity_score >= 0.33 THEN 'Medium' ELSE 'Low' END AS severity_level
  FROM (SELECT macro_state, wave, wind,
    0.7 * CASE WHEN max(wave) OVER () - min(wave) OVER () <= 1e-9 THEN 0 ELSE (wave - min(wave) OVER ()) / (max(wave) OVER () - min(wave) OVER ()) END
    + 0.3 * CASE WHEN max(wind) OVER () - min(wind) OVER () <= 1e-9 THEN 0 ELSE (wind - min(wind) OVER ()) / (max(wind) OVER () - min(wind) OVER ()) END
    AS severity_score FROM macro_means))""",
)
BASE = chain(*VOYAGE)


@query("regime_frame", BASE + f"""SELECT station, window_scale, start_idx, end_idx, start_time, end_time, micro_state AS regime_id,
  {rounded(*MEANS, "duration_hours")} FROM macros""")
def regime_frame_query(spark, sf_dir):
    return profiles.regime_frame(labelled(spark, sf_dir).drop("duration_hours"), "micro_state")


@query("regime_profiles", BASE + "SELECT micro_state AS regime, " + rounded(*[f"avg({m}) AS {m}" for m in MEANS])
       + " FROM macros GROUP BY 1")
def profiles_query(spark, sf_dir):
    return profiles.regime_profiles(labelled(spark, sf_dir).select("micro_state", *MEANS), "micro_state")


NAMED = f"""ranked AS (SELECT micro_state AS regime_id, (avg({WAVE}) + avg({WIND}) + avg({PRES})) / 3 AS severity,
  row_number() OVER (ORDER BY (avg({WAVE}) + avg({WIND}) + avg({PRES})) / 3) AS r, count(*) AS n_windows,
  avg(duration_hours) AS hours, avg({WIND}) AS w FROM macros GROUP BY 1),
titles AS (SELECT *, CASE r WHEN 1 THEN 'calm regime' WHEN 2 THEN 'rough sea regime' WHEN 3 THEN 'storm regime'
  ELSE 'high-variance regime ' || r END AS regime_name FROM ranked)"""


@query("semantic_regime_names", chain(*VOYAGE, NAMED) + f"SELECT regime_id, {rounded('severity')}, regime_name FROM titles")
def names_query(spark, sf_dir):
    return profiles.semantic_regime_names(profiles.regime_frame(held(spark, sf_dir), "micro_state"))


@query("regime_summary_table", chain(*VOYAGE, NAMED) + "SELECT regime_id, regime_name, n_windows, "
       + rounded("hours AS avg_window_duration_hr", f"w AS mean_{WIND}") + " FROM titles")
def summary_query(spark, sf_dir):
    frame = profiles.regime_frame(held(spark, sf_dir), "micro_state")
    return profiles.regime_summary_table(frame, profiles.semantic_regime_names(frame), [WIND, "absent"])


@query("map_micro_to_macro", BASE + "SELECT station, end_idx, micro_state, macro_state FROM macros")
def map_query(spark, sf_dir):
    rows = held(spark, sf_dir)
    mapping = rows.select("micro_state", "macro_state").distinct()
    return profiles.map_micro_to_macro(rows.select("station", "end_idx", "micro_state"), "micro_state", mapping)


@query("crosstab_micro_macro", BASE + "SELECT micro_state AS micro, " + ", ".join(
    f"count(*) FILTER (WHERE macro_state = {v}) AS macro_{v}" for v in range(3)) + " FROM macros GROUP BY 1")
def crosstab_query(spark, sf_dir):
    return profiles.crosstab_micro_macro(labelled(spark, sf_dir), "micro_state", "macro_state", range(3))


@query("regime_distribution", BASE + "SELECT macro_state_name, count(*) AS count FROM scored GROUP BY 1")
def distribution_query(spark, sf_dir):
    return profiles.regime_distribution(scored(spark, sf_dir), "macro_state_name")


@query("regime_timeline_frame", BASE + """SELECT station, start_time, end_time, start_idx, end_idx,
  CAST(micro_state AS VARCHAR) AS regime FROM macros""")
def timeline_query(spark, sf_dir):
    return profiles.regime_timeline_frame(labelled(spark, sf_dir), "micro_state")


@query("sensor_series_frame", BASE + f"""SELECT station, start_time, end_time, {rounded(f"{WAVE} AS value")},
  CAST(macro_state AS VARCHAR) AS regime FROM macros""")
def series_query(spark, sf_dir):
    return profiles.sensor_series_frame(labelled(spark, sf_dir), "WAVE_HGT", "macro_state")


@query("hierarchy_timeline_frame", BASE + """SELECT station, start_time, end_time, start_idx, end_idx, level, state FROM
(SELECT *, 'Macro' AS level, CAST(macro_state AS VARCHAR) AS state FROM macros UNION ALL
 SELECT *, 'Micro' AS level, CAST(micro_state AS VARCHAR) AS state FROM macros)""")
def hierarchy_timeline_query(spark, sf_dir):
    return profiles.hierarchy_timeline_frame(labelled(spark, sf_dir), "macro_state", "micro_state")


@query("severity_map", BASE + "SELECT macro_state, " + rounded("wave AS wave_mean", "wind AS wind_mean", "severity_score")
       + ", severity_level FROM severity")
def severity_map_query(spark, sf_dir):
    return reports.severity_map(held(spark, sf_dir))


@query("last_n_windows", BASE + f"SELECT station, end_idx, end_time, {rounded(WIND)} FROM macros ORDER BY station DESC, end_idx DESC LIMIT 300")
def last_n_query(spark, sf_dir):
    return reports.last_n_windows(labelled(spark, sf_dir)).select("station", "end_idx", "end_time", WIND)


@query("risk_snapshot", BASE + f""", recent AS (SELECT * FROM macros ORDER BY end_time DESC, station DESC LIMIT 120),
snap AS (SELECT avg({WAVE}) AS wave, avg({WIND}) AS wind, avg({WAVE}) + avg({WIND}) / 15 AS score FROM recent)
SELECT {rounded("wave", "wind", "score")}, CASE WHEN score >= 4.5 THEN 'High' WHEN score >= 2.5 THEN 'Medium' ELSE 'Low' END AS level,
  CASE WHEN score >= 4.5 THEN 'Rough/storm tendency in recent windows' WHEN score >= 2.5 THEN 'Moderate marine variability'
  ELSE 'Relatively calm marine behavior' END || ' (wave=' || printf('%.2f', wave) || ', wind=' || printf('%.2f', wind) || ').' AS note
FROM snap""")
def snapshot_query(spark, sf_dir):
    return reports.risk_snapshot(labelled(spark, sf_dir), ["end_time", "station"])


@query("macro_names", BASE + "SELECT macro_state, macro_state_name FROM names")
def macro_names_query(spark, sf_dir):
    return reports.macro_names(labelled(spark, sf_dir))


@query("regime_notes", BASE + f"""SELECT macro_state, {rounded("hours AS avg_duration_hr")}, '{WIND}: ' || printf('%.2f', wind) || ' | {WAVE}: ' ||
  printf('%.2f', wave) || ' | {PRES}: ' || printf('%.2f', pres) AS profile_hint, 'Marine regime ' || macro_state AS interpretation
FROM macro_means""")
def notes_query(spark, sf_dir):
    return reports.regime_notes(labelled(spark, sf_dir))


TRANSITIONS = f"""pairs AS (SELECT lag(micro_state) OVER (PARTITION BY station ORDER BY end_idx) AS from_state, micro_state AS to_state FROM macros),
moves AS (SELECT from_state, to_state, count(*) / sum(count(*)) OVER (PARTITION BY from_state) AS p FROM pairs
  WHERE from_state IS NOT NULL GROUP BY 1, 2),
map AS (SELECT DISTINCT micro_state, macro_state FROM macros),
-- States that do not occur stand for themselves, with probability zero from states that do.
cells AS (SELECT a.range AS from_state, b.range AS to_state FROM range({MICRO_STATES}) a, range({MICRO_STATES}) b),
probs AS (SELECT CAST(c.from_state AS INTEGER) AS micro_state, CAST(coalesce(map.macro_state, c.to_state) AS INTEGER) AS macro_state,
  sum(coalesce(p, 0)) AS probability FROM cells c LEFT JOIN moves USING (from_state, to_state)
  LEFT JOIN map ON map.micro_state = c.to_state GROUP BY 1, 2)"""


def transitions(rows):
    ordered = label_positions(rows, ["station"], block_rows=BLOCKS)
    return transition_matrix(ordered, ["station"], "seq", "micro_state", MICRO_STATES, BLOCKS)


@query("next_macro_probs", chain(*VOYAGE, TRANSITIONS) + f"SELECT micro_state, macro_state, {rounded('probability')} FROM probs WHERE micro_state = 2")
def next_macro_query(spark, sf_dir):
    rows = held(spark, sf_dir)
    mapping = rows.select("micro_state", "macro_state").distinct()
    return reports.next_macro_probs(transitions(rows), mapping, 2)


@query("early_warning", chain(*VOYAGE, TRANSITIONS) + f""", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station
  ORDER BY end_time DESC, end_idx) AS r FROM macros) WHERE r = 1),
high AS (SELECT micro_state, sum(probability) AS q FROM probs WHERE macro_state IN (SELECT macro_state FROM severity WHERE severity_level = 'High') GROUP BY 1),
risk AS (SELECT l.*, severity_level, coalesce(q, 0) AS prob_high_next, 0.7 * coalesce(severity_score, 0) + 0.3 * coalesce(q, 0) AS risk_score
  FROM latest l LEFT JOIN severity USING (macro_state) LEFT JOIN high USING (micro_state))
SELECT station, end_time, macro_state, CASE WHEN risk_score >= 0.66 THEN 'High' WHEN risk_score >= 0.33 THEN 'Medium' ELSE 'Low' END AS risk_level,
  {rounded(f"{WAVE} AS wave_mean", f"{WIND} AS wind_mean", "risk_score", "prob_high_next")},
  'regime=' || macro_state || ' (' || coalesce(severity_level, 'Unknown') || ') | wave=' || printf('%.2f', {WAVE}) || ' | wind=' || printf('%.2f', {WIND})
  || ' | next-high-prob=' || printf('%.2f', prob_high_next) AS explanation FROM risk""")
def warning_query(spark, sf_dir):
    rows = held(spark, sf_dir)
    mapping = rows.select("micro_state", "macro_state").distinct()
    return reports.early_warning(rows, transitions(rows), mapping)


MONTHS = """months AS (SELECT *, strftime(end_time, '%Y-%m') AS month FROM scored),
shares AS (SELECT month, macro_state_name, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY month) AS share FROM months GROUP BY 1, 2),
station_shares AS (SELECT station, month, macro_state_name, count(*) AS count,
  count(*) / sum(count(*)) OVER (PARTITION BY station, month) AS share FROM months GROUP BY 1, 2, 3)"""
REGIMES = ["Storm-like", "Windy", "Low-pressure", "Regime 0", "Regime 1", "Regime 2"]


@query("monthly_regime_shares", chain(*VOYAGE, MONTHS) + f"SELECT month, macro_state_name, count, {rounded('share')} FROM shares")
def shares_query(spark, sf_dir):
    return reports.monthly_regime_shares(scored(spark, sf_dir))


@query("monthly_share_pivot", chain(*VOYAGE, MONTHS) + "SELECT month, " + ", ".join(
    f"round(100.0 * count(*) FILTER (WHERE macro_state_name = '{n}') / count(*), 2) + 0.0 AS \"{n}\"" for n in REGIMES)
    + " FROM months GROUP BY 1")
def pivot_query(spark, sf_dir):
    return reports.monthly_share_pivot(scored(spark, sf_dir), REGIMES)


@query("dominant_regime_month", chain(*VOYAGE, MONTHS) + f"""SELECT month, macro_state_name, count, {rounded("share AS dominant_share", "avg_wave", "avg_wind")}
FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY share DESC, macro_state_name) AS r FROM shares) JOIN
(SELECT month, avg({WAVE}) AS avg_wave, avg({WIND}) AS avg_wind FROM months GROUP BY 1) USING (month) WHERE r = 1""")
def dominant_query(spark, sf_dir):
    return reports.dominant_regime_month(scored(spark, sf_dir))


@query("dominant_regime_station_month", chain(*VOYAGE, MONTHS) + f"""SELECT station, month, macro_state_name, count, {rounded("share AS dominant_share")}
FROM (SELECT *, row_number() OVER (PARTITION BY station, month ORDER BY share DESC, macro_state_name) AS r FROM station_shares) WHERE r = 1""")
def dominant_station_query(spark, sf_dir):
    return reports.dominant_regime_station_month(scored(spark, sf_dir))


PLAN = MONTHS + """,
plan AS (SELECT station, month, severity_level AS l, severity_score AS s FROM months JOIN severity USING (macro_state))"""
SHARE = "avg(CASE WHEN l = '{0}' THEN 1.0 ELSE 0.0 END)"
PERCENT = "round(" + SHARE + " * 100.0, 2) + 0.0"


@query("planning_overall", chain(*VOYAGE, PLAN) + f"""SELECT month, {PERCENT.format("Low")} AS low_share, {PERCENT.format("Medium")} AS med_share,
  {PERCENT.format("High")} AS high_share, round(avg(s), 3) + 0.0 AS avg_severity, count(*) AS windows,
  CASE WHEN {SHARE.format("Low")} >= 0.6 THEN 'Yes' ELSE 'No' END AS recommended FROM plan GROUP BY 1""")
def planning_query(spark, sf_dir):
    return reports.planning_overall(scored(spark, sf_dir))


@query("planning_station", chain(*VOYAGE, PLAN) + f"""SELECT *, CASE WHEN low_share >= 60 AND high_share <= 15 THEN 'Yes' ELSE 'No' END AS recommended
FROM (SELECT station, month, {PERCENT.format("Low")} AS low_share, {PERCENT.format("High")} AS high_share,
  round(avg(s), 3) + 0.0 AS avg_severity, count(*) AS windows FROM plan GROUP BY 1, 2)""")
def planning_station_query(spark, sf_dir):
    return reports.planning_station(scored(spark, sf_dir))


@query("dashboard_kpis", BASE + f"""SELECT count(*) AS windows, count(DISTINCT micro_state) AS micro_states,
  count(DISTINCT macro_state_name) AS macro_regimes, {rounded("avg(duration_hours) AS avg_duration_hr")} FROM scored""")
def kpis_query(spark, sf_dir):
    return reports.dashboard_kpis(scored(spark, sf_dir))


def _health_column(c: str) -> str:
    return f"""SELECT STATION, '{c}' AS c, count(*) AS n, count(*) - count(x) AS nulls, count(d) AS steps, count(*) FILTER (WHERE d = 0) AS flat,
  any_value(mad) AS mad, count(*) FILTER (WHERE abs(x - med) / (1.4826 * mad) > 6) AS spikes
  FROM (SELECT *, quantile_cont(abs(x - med), 0.5) OVER (PARTITION BY STATION) AS mad FROM (
    SELECT STATION, {c} AS x, {c} - lag({c}) OVER (PARTITION BY STATION ORDER BY pos) AS d,
           quantile_cont({c}, 0.5) OVER (PARTITION BY STATION) AS med FROM health_rows)) GROUP BY STATION"""


def health_sql(source: str, columns=NUMERIC) -> str:
    return f"""health_rows AS ({source}),
health_columns AS ({" UNION ALL ".join(_health_column(c) for c in columns)}),
rates AS (SELECT STATION, any_value(n) AS rows, avg(nulls / n) AS missing_rate, avg(CASE WHEN steps > 0 THEN flat / steps ELSE 0 END) AS flatline_rate,
  avg(CASE WHEN nulls = 0 AND mad > 1e-9 THEN spikes / n ELSE 0 END) AS spike_rate FROM health_columns GROUP BY 1),
gaps AS (SELECT STATION, CASE WHEN count(g) >= 2 AND any_value(m) > 0 THEN count(*) FILTER (WHERE g > 2.5 * m) / count(g) ELSE 0 END AS gap_rate
  FROM (SELECT *, quantile_cont(g, 0.5) OVER (PARTITION BY STATION) AS m FROM (
    SELECT STATION, epoch_us(DATE) - lag(epoch_us(DATE)) OVER (PARTITION BY STATION ORDER BY pos) AS g FROM health_rows)) GROUP BY 1),
health AS (SELECT *, greatest(0, least(1, 1 - (0.45 * missing_rate + 0.25 * flatline_rate + 0.2 * spike_rate + 0.1 * gap_rate))) AS score
  FROM rates JOIN gaps USING (STATION))
SELECT STATION, rows, round(missing_rate, 4) + 0.0 AS missing_rate, round(flatline_rate, 4) + 0.0 AS flatline_rate,
  round(spike_rate, 4) + 0.0 AS spike_rate, round(gap_rate, 4) + 0.0 AS gap_rate, round(score, 4) + 0.0 AS health_score,
  CASE WHEN score >= 0.75 THEN 'Good' WHEN score >= 0.5 THEN 'Warning' ELSE 'Critical' END AS status FROM health"""


@query("sensor_health", chain(*GRID_12H) + ", " + health_sql("SELECT * FROM aligned"))
def health_query(spark, sf_dir):
    return reports.sensor_health(stage(grid(spark, sf_dir), "grid"), "STATION", "DATE", "pos", NUMERIC, BLOCKS)


@query("anomaly_topk", BASE + f"SELECT station, end_idx, {rounded(WAVE)} FROM macros ORDER BY {WAVE} DESC, station, end_idx LIMIT 10")
def anomaly_query(spark, sf_dir):
    return reports.anomaly_topk(labelled(spark, sf_dir).select("station", "end_idx", WAVE), WAVE)


@query("error_summary", BASE + "SELECT " + rounded(f"avg({WAVE}) AS mean", f"quantile_cont({WAVE}, 0.5) AS median",
                                                  f"quantile_cont({WAVE}, 0.95) AS p95") + " FROM macros")
def error_summary_query(spark, sf_dir):
    return reports.error_summary(held(spark, sf_dir), WAVE)


def exported(name: str):
    """A query that runs the reports over the labelled voyages, exports one and reads the file again."""

    def run(spark, sf_dir):
        grid = stage(weekly(spark, sf_dir), "weekly")
        rows = scored(spark, sf_dir, grid)
        params = Params(columns=Columns(numeric=tuple(SENSORS), width="7d"))
        mapping = rows.select("micro_state", "macro_state").distinct()
        report = compose_reports(rows, grid, transitions(rows), mapping, params, SENSORS, keep=stage, block_rows=BLOCKS).exports[name]
        path = f"{scratch(spark, 'export')}/{name}.csv"
        export_report(report, path)
        return spark.read.schema(report.schema).csv(path, header=True)

    return run


query("report_regime_labels", BASE + f"""SELECT station, window_scale, start_idx, end_idx, start_time, end_time, micro_state, macro_state,
  macro_state_name, {rounded(*MEANS, "duration_hours")} FROM scored""")(exported("regime_labels"))
query("report_early_warning", CHECKS["early_warning"])(exported("early_warning"))
query("report_seasonal_summary", CHECKS["dominant_regime_month"])(exported("seasonal_summary"))
query("report_operational_planning", CHECKS["planning_overall"])(exported("operational_planning"))
query("report_sensor_health", chain(*VOYAGE[:2]) + ", " + health_sql("SELECT * FROM aligned", SENSORS))(exported("sensor_health"))
