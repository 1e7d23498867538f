"""Models, scoring, sinks and streams. What an iterative fit returns has no SQL equivalent."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.catalog.grid_queries import clean
from tidemark.catalog.label_queries import sequences_sql
from tidemark.catalog.registry import (
    BY_TYPE, DIRECTIONS, NUMERIC, aligned_sql, chain, clean_sql, query, rounded, scratch, table, telemetry, telemetry_sql,
)
from tidemark.catalog.window_queries import REGIME_FEATURES_SQL, regime_features
from tidemark.functions.times import to_micros
from tidemark.operators import clusters, hierarchy, hmm, latent
from tidemark.operators.agreement import centroids
from tidemark.operators.changepoints import changepoints, landmark_changepoints
from tidemark.operators.labels import label_positions
from tidemark.operators.scaling import feature_array, scaler_params, standardize
from tidemark.operators.windows import META
from tidemark.params import Columns, Models, Params, Windows
from tidemark.plans.discovery import discover
from tidemark.plans.scoring import score_telemetry, score_windows
from tidemark.session import cut_lineage, stage
from tidemark.sources.model_store import StoredModels, load_models, save_models
from tidemark.sources.writers import write_reports_json, write_window_features, write_window_regimes
from tidemark.streaming.live import stream_resample, stream_score

HOURLY = chain(telemetry_sql(BY_TYPE), clean_sql(), aligned_sql(1))
STATION = ["station"]
ROUNDS = 6
HOUR = 3_600_000_000


def vectors(spark, sf_dir):
    """``station, end_idx, seq, point, x``: standardised hourly window features."""
    windows = cut_lineage(regime_features(spark, sf_dir))
    columns = [c for c in windows.columns if c not in META]
    scaled, _ = standardize(windows, columns)
    rows = feature_array(scaled, columns, "x").select(
        "station", "end_idx", F.concat_ws("/", "station", F.col("end_idx").cast("string")).alias("point"), "x"
    )
    return cut_lineage(label_positions(rows, STATION))


def points(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


# Groups planted so far apart that every fit must find them, which SQL knows from the labels.
FAR = 1000.0
GROUPS = "SELECT min(vec_id) AS first_id, count(*) AS n{more} FROM embeddings GROUP BY {by}"


def planted(spark, sf_dir, group="label"):
    """``points`` moved ``FAR`` along the axis of their group."""
    x = F.transform("x", lambda v, i: v + F.when(i == F.expr(group), FAR).otherwise(0.0))
    return cut_lineage(points(spark, sf_dir).withColumn("x", x))


def found_groups(labels, name="regime"):
    return labels.groupBy(name).agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n")).drop(name)


def chosen(fit):
    return found_groups(fit.labels).withColumn("k", F.lit(fit.k).cast("long"))


@query("kmeans_fit", GROUPS.format(more="", by="label"))
def kmeans_query(spark, sf_dir):
    return found_groups(clusters.kmeans_fit(planted(spark, sf_dir), "x", 10, restarts=3).labels)


@query("kmeans_select_k", GROUPS.format(more=", (SELECT count(DISTINCT label) FROM embeddings) AS k", by="label"))
def kmeans_select_query(spark, sf_dir):
    return chosen(clusters.kmeans_select_k(planted(spark, sf_dir), "vec_id", "x", [5, 10, 12], restarts=2, silhouette="squared"))


def two_groups(spark, sf_dir):
    """Two far groups in two dimensions, for mixtures."""
    x = F.array(F.col("x")[0] + F.when(F.col("label") < 5, 0.0).otherwise(FAR), F.col("x")[1])
    return cut_lineage(points(spark, sf_dir).withColumn("x", x))


@query("gmm_fit", GROUPS.format(more="", by="label < 5"))
def gmm_query(spark, sf_dir):
    return found_groups(clusters.gmm_fit(two_groups(spark, sf_dir), "x", 2).labels)


@query("gmm_select_k")
def gmm_select_query(spark, sf_dir):
    fit = clusters.gmm_select_k(vectors(spark, sf_dir), "x", [2, 3], max_iter=20)
    return clusters.score_table(fit.labels, "gmm", fit.scores)


@query("embedding_select_k", GROUPS.format(more=", (SELECT count(DISTINCT label) FROM embeddings) AS k", by="label"))
def embedding_select_query(spark, sf_dir):
    embedded, _ = latent.latent_embedding(planted(spark, sf_dir), "x", 9)
    embedded = cut_lineage(embedded)
    return chosen(clusters.embedding_select_k(embedded, "vec_id", "latent", [12, 10, 5], restarts=2, silhouette="squared"))


def line(spark, sf_dir):
    """Points on one line through three dimensions."""
    t = F.col("vec_id") / 100
    return points(spark, sf_dir).select("vec_id", F.array(t, 2 * t, 2 * t).alias("x"))


PLACE = "abs(3 * (vec_id / 100 - (SELECT avg(vec_id / 100) FROM embeddings)))"


@query("pca_projection", f"SELECT vec_id, {rounded(PLACE + ' AS pc1', '0.0 AS pc2')} FROM embeddings")
def pca_query(spark, sf_dir):
    return latent.pca_projection(line(spark, sf_dir), "x").select("vec_id", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2"))


@query("latent_embedding", f"SELECT vec_id, {rounded(PLACE + ' AS z')} FROM embeddings")
def embedding_query(spark, sf_dir):
    embedded, _ = latent.latent_embedding(line(spark, sf_dir), "x", 1)
    return embedded.select("vec_id", F.abs(F.col("latent")[0]).alias("z"))


@query("latent_projection")
def projection_query(spark, sf_dir):
    embedded, _ = latent.latent_embedding(vectors(spark, sf_dir), "x", 4)
    return latent.latent_projection(embedded, "latent").select("station", "end_idx", "latent_pc1", "latent_pc2")


@query("latent_kmeans", GROUPS.format(more="", by="label"))
def latent_kmeans_query(spark, sf_dir):
    embedded, _ = latent.latent_embedding(planted(spark, sf_dir), "x", 9)
    return found_groups(clusters.kmeans_fit(cut_lineage(embedded), "latent", 10, restarts=3).labels)


@query("latent_hmm")
def latent_hmm_query(spark, sf_dir):
    embedded, _ = latent.latent_embedding(vectors(spark, sf_dir), "x", 3)
    fit = hmm.hmm_fit(embedded, STATION, "seq", "latent", 2, iterations=ROUNDS)
    return hmm.hmm_decode(embedded, STATION, "seq", "latent", fit.parameters).select("station", "end_idx", "state")


@query("super_regimes", "SELECT label, label % 3 AS super_regime, count(*) AS n FROM embeddings GROUP BY 1, 2")
def super_query(spark, sf_dir):
    merged, _ = hierarchy.super_regimes(planted(spark, sf_dir, "label % 3"), "label", "x", 3)
    return merged.groupBy("label", "super_regime").agg(F.count(F.lit(1)).alias("n"))


@query("macro_from_state_means", """SELECT a, b, count(*) AS n FROM
(SELECT label % 3 AS a, lead(label % 3) OVER (ORDER BY vec_id) AS b FROM embeddings) WHERE b IS NOT NULL GROUP BY 1, 2""")
def macro_query(spark, sf_dir):
    rows = planted(spark, sf_dir, "label % 3").withColumn("station", F.lit("one"))
    ordered = label_positions(rows, STATION, index="vec_id")
    means = centroids(rows, "label", "x").select(F.col("label").alias("state"), F.col("centroid").alias("mean"))
    _, mapping, matrix = hierarchy.macro_from_state_means(ordered, cut_lineage(means), STATION, "seq", "label", 3, restarts=2)
    # Macro states are numbered by the fit; the least state of each names it.
    names = cut_lineage(mapping.groupBy("macro_state").agg(F.min("micro_state").alias("name")))
    a, b = (names.select(F.col("macro_state").alias(c), F.col("name").alias(n)) for c, n in (("from_state", "a"), ("to_state", "b")))
    return matrix.where("n > 0").join(a, "from_state").join(b, "to_state").select("a", "b", F.col("n").cast("long").alias("n"))


@query("hmm_select_states")
def hmm_select_query(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    fit = hmm.hmm_select_states(rows, STATION, "seq", "x", [2, 3], iterations=ROUNDS)
    return clusters.score_table(rows, "hmm", fit.bic_by_states)


@query("hmm_bic", f"""SELECT event_type, {rounded("-2 * ll + (9 + 2 * 3 * 4) * ln(greatest(n, 2)) AS bic")} FROM
(SELECT event_type, -sum(value) AS ll, count(*) AS n FROM events GROUP BY 1)""")
def bic_query(spark, sf_dir):
    scores = table(spark, sf_dir, "events").groupBy("event_type").agg(
        (-F.sum("value")).alias("log_likelihood"), F.count(F.lit(1)).alias("rows"), F.lit(3).alias("states"), F.lit(4).alias("dimensions")
    )
    return hmm.bic_table(scores).select("event_type", "bic")


@query("hmm_seed_stability")
def stability_query(spark, sf_dir):
    return hmm.hmm_seed_stability(vectors(spark, sf_dir), STATION, "seq", "x", 2, [0, 42, 100], iterations=3)


# A three-state model of hourly event values for the decoding checks.
STATE_MEANS, STATE_VARIANCES = (20.0, 40.0, 90.0), (100.0, 200.0, 900.0)
STAY, MOVE = 0.8, 0.1


def fixed_model():
    import numpy as np

    transitions = np.full((3, 3), MOVE) + np.eye(3) * (STAY - MOVE)
    return hmm.HmmParameters(
        np.full(3, 1 / 3), transitions, np.array(STATE_MEANS)[:, None], np.array(STATE_VARIANCES)[:, None]
    )


def hourly_values(spark, sf_dir):
    hour = F.floor(to_micros(F.col("ts"), True) / F.lit(HOUR)).cast("long")
    means = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("station"), hour.alias("hour")).agg(
        F.array(F.avg("value")).alias("x")
    )
    return label_positions(means, STATION, index="hour")


def density_sql(value: str, state: int) -> str:
    m, v = STATE_MEANS[state], STATE_VARIANCES[state]
    return f"-0.5 * (ln(2 * pi() * {v}) + ({value} - {m}) * ({value} - {m}) / {v})"


VALUES = f"""vals AS (SELECT event_type AS station, epoch_us(ts) // {HOUR} AS hour, avg(value) AS v FROM events GROUP BY 1, 2)"""


def two_levels(spark, sf_dir):
    """``hourly_values`` moved ``FAR`` on every other day."""
    level = F.when(F.floor(F.col("hour") / 24) % 2 == 1, FAR).otherwise(0.0)
    return cut_lineage(hourly_values(spark, sf_dir).withColumn("x", F.transform("x", lambda v: v + level)))


LEVELS = f"""levels AS (SELECT station, hour, (hour // 24) % 2 AS level, v + {FAR} * ((hour // 24) % 2) AS x FROM vals)"""


@query("hmm_fit", chain(VALUES, LEVELS, """steps AS (
  SELECT level, lead(level) OVER (PARTITION BY station ORDER BY hour) AS after FROM levels)""") + f"""SELECT CAST(level AS INTEGER) AS state,
  {rounded("m AS mean", "p AS stays")} FROM (SELECT level, avg(x) AS m FROM levels GROUP BY 1)
  JOIN (SELECT level, avg(CASE WHEN level = after THEN 1.0 ELSE 0.0 END) AS p FROM steps WHERE after IS NOT NULL GROUP BY 1) USING (level)""")
def hmm_query(spark, sf_dir):
    found = hmm.hmm_fit(two_levels(spark, sf_dir), STATION, "seq", "x", 2, iterations=40, tolerance=1e-9).parameters
    order = found.means[:, 0].argsort()
    rows = [(n, float(found.means[s, 0]), float(found.transitions[s, s])) for n, s in enumerate(order)]
    return spark.createDataFrame(rows, "state int, mean double, stays double")


@query("hmm_emission", chain(VALUES) + " UNION ALL ".join(
    f"SELECT station, hour, {s} AS state, {rounded(density_sql('v', s) + ' AS log_density')} FROM vals" for s in range(3)))
def emission_query(spark, sf_dir):
    return hmm.hmm_emission(hourly_values(spark, sf_dir), "x", fixed_model().state_table(spark), ["station", "hour"])


def _step(target: int) -> str:
    options = [f"f.s{i} + ln({STAY if i == target else MOVE})" for i in range(3)]
    return f"greatest({', '.join(options)}) + e{target}"


VITERBI = f"""WITH RECURSIVE {VALUES},
e AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY hour) - 1 AS seq,
  {", ".join(f"{density_sql('v', s)} AS e{s}" for s in range(3))} FROM vals),
f AS (
  SELECT station, seq, e0 + ln(1 / 3.0) AS s0, e1 + ln(1 / 3.0) AS s1, e2 + ln(1 / 3.0) AS s2 FROM e WHERE seq = 0
  UNION ALL
  SELECT e.station, e.seq, {", ".join(_step(t) for t in range(3))} FROM f JOIN e ON e.station = f.station AND e.seq = f.seq + 1),
ends AS (SELECT station, max(seq) AS seq FROM e GROUP BY 1),
b AS (
  SELECT station, seq, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS state FROM f JOIN ends USING (station, seq)
  UNION ALL
  SELECT station, seq, CASE WHEN a0 >= a1 AND a0 >= a2 THEN 0 WHEN a1 >= a2 THEN 1 ELSE 2 END FROM (
    SELECT f.station, f.seq, {", ".join(f"f.s{i} + CASE WHEN b.state = {i} THEN ln({STAY}) ELSE ln({MOVE}) END AS a{i}" for i in range(3))}
    FROM b JOIN f ON f.station = b.station AND f.seq = b.seq - 1))
"""


@query("hmm_decode", VITERBI + "SELECT station, hour, state FROM b JOIN e USING (station, seq)")
def decode_query(spark, sf_dir):
    rows = hourly_values(spark, sf_dir)
    return hmm.hmm_decode(rows, STATION, "seq", "x", fixed_model(), block_rows=100).select("station", "hour", "state")


PLANTED_BREAKS = chain(VALUES) + """SELECT station, seq AS boundary FROM (
  SELECT station, row_number() OVER (PARTITION BY station ORDER BY hour) - 1 AS seq, count(*) OVER (PARTITION BY station) AS n FROM vals)
WHERE seq % 20 = 0 AND seq > 0 AND n - seq >= 2"""


def planted_levels(spark, sf_dir):
    """Hourly values that change their level every 20 rows."""
    level = F.when(F.floor(F.col("seq") / 20) % 2 == 1, FAR).otherwise(0.0)
    return cut_lineage(hourly_values(spark, sf_dir).withColumn("x", F.transform("x", lambda v: v + level)))


@query("changepoints", PLANTED_BREAKS)
def changepoints_query(spark, sf_dir):
    return changepoints(planted_levels(spark, sf_dir), STATION, "seq", "x", penalty=2.0, segment_rows=250, overlap=30)


@query("changepoints_landmarks", PLANTED_BREAKS)
def changepoints_landmarks_query(spark, sf_dir):
    return landmark_changepoints(planted_levels(spark, sf_dir), STATION, "seq", "x", penalty=2.0, block_rows=100, run_blocks=2)


# ---- sinks, stored models, streams ----------------------------------------------------------


@query("write_window_features", REGIME_FEATURES_SQL)
def write_features_query(spark, sf_dir):
    path = scratch(spark, "features")
    write_window_features(regime_features(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("write_window_regimes", HOURLY + """SELECT STATION AS station, 12 AS window_scale, pos - 11 AS start_idx, pos AS end_idx,
  CAST(pos % 5 AS INTEGER) AS regime_kmeans FROM aligned WHERE pos >= 11 AND (pos - 11) % 12 = 0""")
def write_regimes_query(spark, sf_dir):
    path = scratch(spark, "regimes")
    windows = regime_features(spark, sf_dir)
    write_window_regimes(windows.withColumn("regime_kmeans", (F.col("end_idx") % 5).cast("int")), path)
    shape = "station string, window_scale int, start_idx long, end_idx long, start_time timestamp, end_time timestamp, regime_kmeans int"
    return spark.read.schema(shape).csv(path, header=True).drop("start_time", "end_time")


@query("write_reports_json", chain(sequences_sql()) + "SELECT label, count(*) AS n FROM labels GROUP BY 1")
def write_reports_query(spark, sf_dir):
    from tidemark.catalog.label_queries import hourly

    path = scratch(spark, "reports")
    counts = hourly(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    write_reports_json({"distribution": counts}, path)
    return spark.read.schema("label int, n long").json(f"{path}/distribution")


def stored(spark, sf_dir, windows):
    columns = [c for c in windows.columns if c not in META]
    scaler = cut_lineage(scaler_params(windows, columns))
    rows = vectors(spark, sf_dir)
    fit = hmm.hmm_fit(rows, STATION, "seq", "x", 2, iterations=3)
    settings = {"window_features": columns, "numeric": NUMERIC, "directional": []}
    return StoredModels(scaler, fit.parameters, settings)


@query("model_store")
def store_query(spark, sf_dir):
    windows = cut_lineage(regime_features(spark, sf_dir))
    path = scratch(spark, "models")
    save_models(spark, stored(spark, sf_dir, windows), path)
    loaded = load_models(spark, path)
    return loaded.hmm.state_table(spark).select(
        "state", "start", F.posexplode("mean").alias("i", "mean"), F.lit(loaded.mode).alias("mode")
    )


@query("score_windows")
def score_query(spark, sf_dir):
    windows = cut_lineage(regime_features(spark, sf_dir))
    return score_windows(windows, stored(spark, sf_dir, windows))


SMALL = Params(
    columns=Columns(numeric=tuple(NUMERIC), directional=tuple(DIRECTIONS), width="1h"),
    windows=Windows(multiscale=False, size=12, step=12, stats=("mean", "std")),
    models=Models(candidates=(2,), restarts=1, hmm_iterations=3, super_regimes=2),
)


@query("discover_regimes")
def discover_query(spark, sf_dir):
    return discover(telemetry(spark, sf_dir, "event_type").drop("event_id"), SMALL, stability=False).labelled


@query("score_telemetry")
def score_telemetry_query(spark, sf_dir):
    windows = cut_lineage(regime_features(spark, sf_dir))
    path = scratch(spark, "models")
    save_models(spark, stored(spark, sf_dir, windows), path)
    raw = telemetry(spark, sf_dir, "event_type").drop("event_id")
    plain = replace(SMALL, columns=replace(SMALL.columns, directional=()))
    return score_telemetry(raw, plain, load_models(spark, path), keep=stage)


LATENESS_HOURS = 2


@query("stream_resample", chain(telemetry_sql(BY_TYPE), clean_sql()) + f"""SELECT STATION, make_timestamp(bin) AS DATE, {rounded(*NUMERIC)},
  {rounded("(degrees(atan2(s, c)) + 360) % 360 AS WIND_DIR")} FROM (
  SELECT STATION, (epoch_us(DATE) // {HOUR}) * {HOUR} AS bin, {", ".join(f"avg({c}) AS {c}" for c in NUMERIC)},
    avg(sin(radians(WIND_DIR))) AS s, avg(cos(radians(WIND_DIR))) AS c FROM clean GROUP BY 1, 2)
WHERE bin + {HOUR} <= (SELECT max(epoch_us(DATE)) FROM clean) // 1000 * 1000 - {LATENESS_HOURS * HOUR}""")
def stream_resample_query(spark, sf_dir):
    source, output, checkpoint = scratch(spark, "source"), scratch(spark, "out"), scratch(spark, "state")
    rows = clean(spark, sf_dir, "event_type").withColumn("DATE", F.col("DATE").cast("timestamp"))
    rows.write.parquet(source)
    stream = stream_resample(
        spark.readStream.schema(rows.schema).parquet(source), "STATION", "DATE", NUMERIC, DIRECTIONS, "1h", f"{LATENESS_HOURS} hours"
    )
    run = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(output)
    )
    run.awaitTermination()
    return spark.read.parquet(output)


@query("stream_score")
def stream_score_query(spark, sf_dir):
    windows = cut_lineage(regime_features(spark, sf_dir))
    source, output, checkpoint = scratch(spark, "source"), scratch(spark, "out"), scratch(spark, "state")
    windows.write.parquet(source)
    models = stored(spark, sf_dir, windows)
    stream = spark.readStream.schema(windows.schema).parquet(source)
    stream_score(stream, models, output, checkpoint).start().awaitTermination()
    return spark.read.parquet(output).select("station", "end_idx", "micro_state", "macro_state")
