"""Label sequences, boundaries and regime descriptions.

The labels are hourly means of ``events`` cut into classes, so that SQL can make the same ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import HOUR_US, chain, query, rounded, table
from tidemark.functions.times import to_micros
from tidemark.operators.boundaries import boundary_precision_recall
from tidemark.operators.labels import (
    duration_statistics, label_positions, labels_to_boundaries, next_row_pair, pressure_drop, regime_durations,
    run_lengths_by_state, smooth_labels, transition_entropy, transition_matrix,
)

# Small blocks, so that the checks cover runs and carries across block borders.
BLOCKS = 64
STATION, WHOLE = ["station"], []


def hourly(spark, sf_dir):
    """``station, hour, label, other, pressure``."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("double")
    hour = F.floor(to_micros(F.col("ts"), True) / F.lit(HOUR_US)).cast("long")
    means = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("station"), hour.alias("hour")).agg(
        F.avg("value").alias("v"), F.avg(k).alias("k")
    )
    return means.select(
        "station", "hour",
        F.least(F.lit(3), F.floor(F.col("v") / 20)).cast("int").alias("label"),
        F.least(F.lit(3), F.floor(F.col("k") / 25)).cast("int").alias("other"),
        (F.col("k") + 1000).alias("pressure"),
    )


def sequences(spark, sf_dir, keys=STATION):
    return label_positions(hourly(spark, sf_dir), keys, "station", "hour", block_rows=BLOCKS)


def sequences_sql(whole: bool = False) -> str:
    series = "'all'" if whole else "station"
    return f"""hourly AS (
  SELECT event_type AS station, epoch_us(ts) // {HOUR_US} AS hour, avg(value) AS v,
         avg(CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE)) AS k FROM events GROUP BY 1, 2),
labels AS (
  SELECT station, hour, CAST(least(3, floor(v / 20)) AS INTEGER) AS label, CAST(least(3, floor(k / 25)) AS INTEGER) AS other,
         k + 1000 AS pressure, {series} AS series,
         row_number() OVER (PARTITION BY {series} ORDER BY station, hour) - 1 AS seq FROM hourly)"""


def runs_sql(column: str = "label", source: str = "labels", name: str = "runs") -> str:
    return f"""{name}_m AS (
  SELECT *, CASE WHEN lag({column}) OVER (PARTITION BY series ORDER BY seq) IS DISTINCT FROM {column} THEN 1 ELSE 0 END AS st FROM {source}),
{name}_i AS (SELECT *, sum(st) OVER (PARTITION BY series ORDER BY seq) AS run FROM {name}_m),
{name} AS (SELECT series, run, min(seq) AS run_start, any_value({column}) AS label, count(*) AS len FROM {name}_i GROUP BY 1, 2)"""


def smooth_sql(minimum: int) -> str:
    return f"""{runs_sql()},
kept AS (SELECT *, CASE WHEN len >= {minimum} THEN label
  WHEN run = 1 THEN coalesce(lead(label) OVER (PARTITION BY series ORDER BY run), label) END AS k FROM runs),
sm AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY series ORDER BY run) AS smoothed FROM kept),
smoothed AS (SELECT i.station, i.hour, i.series, i.seq, i.label, sm.smoothed FROM runs_i i JOIN sm USING (series, run))"""


STATS_SQL = "CAST(count(*) AS DOUBLE) AS n_segments, " + rounded(
    "avg(len) AS mean_duration", "quantile_cont(len, 0.5) AS median_duration", "quantile_cont(len, 0.9) AS p90_duration"
) + ", CAST(min(len) AS DOUBLE) AS min_duration, CAST(max(len) AS DOUBLE) AS max_duration"


@query("smooth_labels", chain(sequences_sql(), smooth_sql(3)) + "SELECT station, hour, label, smoothed FROM smoothed")
def smooth_query(spark, sf_dir):
    rows = smooth_labels(sequences(spark, sf_dir), STATION, "seq", "label", 3, block_rows=BLOCKS)
    return rows.select("station", "hour", "label", "smoothed")


@query("smooth_labels_whole", chain(sequences_sql(True), smooth_sql(2)) + "SELECT station, hour, seq, smoothed FROM smoothed")
def smooth_whole_query(spark, sf_dir):
    rows = smooth_labels(sequences(spark, sf_dir, WHOLE), WHOLE, "seq", "label", 2, block_rows=BLOCKS)
    return rows.select("station", "hour", "seq", "smoothed")


@query("regime_durations", chain(sequences_sql(), runs_sql()) + "SELECT series AS station, run_start, len AS duration FROM runs")
def durations_query(spark, sf_dir):
    return regime_durations(sequences(spark, sf_dir), STATION, "seq", "label", BLOCKS)


@query("run_lengths_by_state", chain(sequences_sql(True), runs_sql()) + "SELECT run_start, label AS state, len AS run_length FROM runs")
def run_lengths_query(spark, sf_dir):
    return run_lengths_by_state(sequences(spark, sf_dir, WHOLE), WHOLE, "seq", "label", BLOCKS)


@query("duration_statistics", chain(sequences_sql(), runs_sql()) + f"SELECT series AS station, {STATS_SQL} FROM runs GROUP BY 1")
def duration_stats_query(spark, sf_dir):
    runs = regime_durations(sequences(spark, sf_dir), STATION, "seq", "label", BLOCKS)
    return duration_statistics(runs, STATION)


@query("duration_statistics_whole", chain(sequences_sql(True), runs_sql()) + f"SELECT {STATS_SQL} FROM runs")
def duration_stats_whole_query(spark, sf_dir):
    return duration_statistics(regime_durations(sequences(spark, sf_dir, WHOLE), WHOLE, "seq", "label", BLOCKS))


PAIRS_SQL = """pairs AS (SELECT series, seq, lag(label) OVER (PARTITION BY series ORDER BY seq) AS from_state, label AS to_state FROM labels)"""


def matrix_sql(states: int) -> str:
    return f"""{PAIRS_SQL},
counts AS (SELECT from_state, to_state, count(*) AS n FROM pairs WHERE from_state IS NOT NULL GROUP BY 1, 2),
cells AS (SELECT CAST(a.range AS INTEGER) AS from_state, CAST(b.range AS INTEGER) AS to_state FROM range({states}) a, range({states}) b),
matrix AS (SELECT from_state, to_state, coalesce(n, 0) AS n,
  CASE WHEN sum(n) OVER (PARTITION BY from_state) > 0 THEN coalesce(n, 0) / sum(n) OVER (PARTITION BY from_state) ELSE 0.0 END AS p
  FROM cells LEFT JOIN counts USING (from_state, to_state))"""


@query("next_row_pair", chain(sequences_sql(), PAIRS_SQL) + """SELECT series AS station, seq, from_state, to_state FROM pairs
WHERE from_state IS NOT NULL""")
def pairs_query(spark, sf_dir):
    return next_row_pair(sequences(spark, sf_dir), STATION, "seq", "label", BLOCKS)


@query("transition_matrix", chain(sequences_sql(), matrix_sql(5)) + f"SELECT from_state, to_state, n, {rounded('p')} FROM matrix")
def matrix_query(spark, sf_dir):
    return transition_matrix(sequences(spark, sf_dir), STATION, "seq", "label", 5, BLOCKS)


@query("transition_matrix_whole", chain(sequences_sql(True), matrix_sql(4)) + f"SELECT from_state, to_state, n, {rounded('p')} FROM matrix")
def matrix_whole_query(spark, sf_dir):
    return transition_matrix(sequences(spark, sf_dir, WHOLE), WHOLE, "seq", "label", block_rows=BLOCKS)


@query("transition_entropy", chain(sequences_sql(), matrix_sql(5)) + "SELECT " + rounded("avg(e) AS transition_entropy") + """
FROM (SELECT from_state, CASE WHEN sum(p) > 0 THEN sum(-greatest(p, 1e-12) * ln(greatest(p, 1e-12))) ELSE 0 END AS e
      FROM matrix GROUP BY 1)""")
def entropy_query(spark, sf_dir):
    return transition_entropy(matrix_query(spark, sf_dir))


BOUNDARY_SQL = "{name} AS (SELECT series, seq AS boundary FROM (SELECT *, lag({c}) OVER (PARTITION BY series ORDER BY seq) AS p FROM labels) WHERE p <> {c})"


@query("labels_to_boundaries", chain(sequences_sql(), BOUNDARY_SQL.format(name="found", c="label"))
       + "SELECT series AS station, boundary FROM found")
def boundaries_query(spark, sf_dir):
    return labels_to_boundaries(sequences(spark, sf_dir), STATION, "seq", "label", BLOCKS)


@query("lag_changes", chain(sequences_sql()) + """SELECT station, count(*) AS changes FROM
(SELECT station, label, lag(label) OVER (PARTITION BY station ORDER BY seq) AS p FROM labels) WHERE p <> label GROUP BY 1""")
def changes_query(spark, sf_dir):
    found = labels_to_boundaries(sequences(spark, sf_dir), STATION, "seq", "label", BLOCKS)
    return found.groupBy("station").agg(F.count(F.lit(1)).alias("changes"))


def matching_sql(tolerance: int) -> str:
    """Greedy matching, one prediction per recursion step."""
    return f"""ordered AS (SELECT series, boundary AS p, row_number() OVER (PARTITION BY series ORDER BY boundary) AS r FROM pred),
step AS (
  SELECT series, CAST(0 AS BIGINT) AS r, CAST(-1000000 AS BIGINT) AS free, CAST(0 AS BIGINT) AS tp FROM (SELECT DISTINCT series FROM labels)
  UNION ALL
  SELECT s.series, n.r, CASE WHEN n.t <= n.p + {tolerance} THEN n.t + 1 ELSE s.free END,
         s.tp + CASE WHEN n.t <= n.p + {tolerance} THEN 1 ELSE 0 END
  FROM step s JOIN LATERAL (
    SELECT o.r, o.p, min(t.boundary) AS t FROM ordered o LEFT JOIN truth t
      ON t.series = o.series AND t.boundary >= greatest(s.free, o.p - {tolerance})
    WHERE o.series = s.series AND o.r = s.r + 1 GROUP BY o.r, o.p) n ON TRUE),
matched AS (SELECT series, max(tp) AS tp FROM step GROUP BY 1),
sizes AS (SELECT s.series, tp, (SELECT count(*) FROM pred WHERE pred.series = s.series) AS np,
  (SELECT count(*) FROM truth WHERE truth.series = s.series) AS nt FROM matched s),
ratios AS (SELECT series, tp / np AS precision, tp / nt AS recall FROM sizes)"""


def match_chain(whole: bool, tolerance: int) -> str:
    return "WITH RECURSIVE " + ",\n".join([
        sequences_sql(whole), BOUNDARY_SQL.format(name="pred", c="label"), BOUNDARY_SQL.format(name="truth", c="other"),
        matching_sql(tolerance),
    ]) + "\n"


PR = rounded("precision", "recall", "2 * precision * recall / (precision + recall) AS f1")


@query("boundary_precision_recall", match_chain(False, 1) + f"SELECT series AS station, {PR} FROM ratios")
def precision_query(spark, sf_dir):
    rows = sequences(spark, sf_dir)
    truth = labels_to_boundaries(rows, STATION, "seq", "other", BLOCKS)
    found = labels_to_boundaries(rows, STATION, "seq", "label", BLOCKS)
    return boundary_precision_recall(truth, found, STATION, 1, series=rows, block_span=BLOCKS)


@query("changepoint_alignment", match_chain(True, 0) + f"SELECT {PR} FROM ratios")
def alignment_query(spark, sf_dir):
    rows = sequences(spark, sf_dir, WHOLE)
    breaks = labels_to_boundaries(rows, WHOLE, "seq", "other", BLOCKS)
    found = labels_to_boundaries(rows, WHOLE, "seq", "label", BLOCKS)
    return boundary_precision_recall(breaks, found, WHOLE, 0, block_span=BLOCKS)


@query("pressure_drop", chain(sequences_sql(True)) + "SELECT CAST(count(*) AS DOUBLE) AS n_transitions, " + rounded(
    "avg(d) AS mean_pressure_delta_post_minus_pre", "quantile_cont(d, 0.5) AS median_pressure_delta_post_minus_pre",
    "quantile_cont(d, 0.1) AS p10_pressure_delta_post_minus_pre") + """
FROM (SELECT label, lag(label) OVER w AS p,
  avg(pressure) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)
  - avg(pressure) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS d
  FROM labels WINDOW w AS (PARTITION BY series ORDER BY seq)) WHERE p <> label""")
def pressure_query(spark, sf_dir):
    return pressure_drop(sequences(spark, sf_dir, WHOLE), WHOLE, "seq", "label", "pressure", 3, BLOCKS)
