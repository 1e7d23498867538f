import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import START
from tidemark.operators.hmm import HmmParameters
from tidemark.operators.resample import resample_mean
from tidemark.operators.windows import META
from tidemark.params import Columns, Models, Params, Windows
from tidemark.plans.discovery import discover
from tidemark.plans.experiment import compare_experiments, run_experiment
from tidemark.plans.scoring import score_telemetry, score_windows
from tidemark.session import cut_lineage, shared_dir, stage
from tidemark.sources.model_store import StoredModels, load_models, save_models
from tidemark.streaming.live import stream_resample, stream_score

NUMERIC = ("WIND_SPEED", "SEA_LVL_PRES", "AIR_TEMP", "WAVE_HGT")
PARAMS = Params(
    columns=Columns(numeric=NUMERIC, directional=("WIND_DIR",), width="1h"),
    windows=Windows(multiscale=True, scales=(3, 6), stride=6),
    models=Models(candidates=(2,), restarts=1, hmm_iterations=2, latent_dim=3, super_regimes=2, min_segment=2),
)


def telemetry(spark, stations=3, hours=72):
    rng = random.Random(1)
    rows = []
    for s in range(stations):
        for h in range(hours):
            if rng.random() < 0.15:
                continue
            rough = (h // 24) % 2
            rows.append((
                f"S{s}", START + dt.timedelta(hours=h, minutes=rng.randint(0, 59)), 5 + 20 * rough + rng.random(),
                1015 - 20 * rough + rng.random(), 99.0 if rng.random() < 0.05 else 15 + rng.random(), 1 + 4 * rough + rng.random(),
                float(rng.randint(0, 359)),
            ))
    return spark.createDataFrame(rows, "STATION string, DATE timestamp, WIND_SPEED double, SEA_LVL_PRES double, AIR_TEMP double, WAVE_HGT double, WIND_DIR double")


def test_discovery_stores_models_that_score(spark, tmp_path):
    raw = telemetry(spark)
    result = discover(raw, PARAMS, latent=True, stability=False)
    names = {"kmeans", "gmm", "hmm", "dense_ae_kmeans", "dense_ae_hmm", "dense_ae_hmm_macro", "hierarchy_super"}
    assert {c.removeprefix("regime_") for c in result.labelled.columns if c.startswith("regime_")} == names
    windows = result.windows.count()
    assert windows > 30 and result.labelled.count() == windows
    assert result.quality.count() == 4 and result.quality_flags.first().window_count == windows
    found = {(m, k) for m, k, _ in result.metrics}
    assert {("kmeans", "silhouette_sampled_post"), ("hmm", "bic"), ("gmm", "aic"), ("changepoint", "n_breaks_landmarks")} <= found
    assert {"changepoints", "pca_projection", "reconstruction_error", "macro_profiles", "changepoint_alignment_hmm"} <= set(result.diagnostics)
    calm = result.labelled.where(F.hour("end_time") < 24).select("regime_kmeans").distinct().count()
    assert calm == 2
    save_models(spark, result.models, str(tmp_path / "models"))
    models = load_models(spark, str(tmp_path / "models"))
    assert models.mode == "dense_hierarchical" == result.models.mode
    scored = score_telemetry(raw.withColumnRenamed("STATION", " station"), PARAMS, models)
    assert scored.count() == windows
    assert {"micro_state", "macro_state", "macro_state_name", "reconstruction_error", "duration_hours"} <= set(scored.columns)
    # Unsmoothed decoding of the training windows, with the stored parameters, repeats for every run.
    again = score_windows(result.windows, models).select("station", "end_idx", "micro_state")
    assert again.exceptAll(scored.select("station", "end_idx", "micro_state")).count() == 0


def test_experiment_with_whole_table_scope(spark, tmp_path):
    root = str(tmp_path)
    result = run_experiment(telemetry(spark, 2, 48), PARAMS, "first", root, "a note", keys=(), stability=False)
    rows, means = compare_experiments(spark, root)
    compared = {r.model: r for r in rows.collect()}
    assert set(compared) == {"kmeans", "gmm", "hmm", "hierarchy_super", "changepoint"}
    assert compared["hmm"].bic is not None and compared["kmeans"].transition_entropy is not None
    assert means.count() == 5
    assert spark.read.json(f"{root}/first/experiment").first().notes == "a note"
    assert spark.read.parquet(f"{root}/first/artifacts/window_features").count() == result.windows.count()
    assert load_models(spark, f"{root}/first/artifacts/models").mode == "hmm_only"
    pairs = result.diagnostics["transition_matrix_kmeans"].agg(F.sum("n")).first()[0]
    assert pairs == result.windows.count() - 1
    assert result.models.mode == "hmm_only"
    assert result.metrics_frame("x").where("model = 'kmeans'").count() > 3


def test_stream_equals_batch_for_closed_bins(spark, tmp_path):
    raw = telemetry(spark, 2, 30)
    raw.write.parquet(str(tmp_path / "in"))
    stream = stream_resample(
        spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")), "STATION", "DATE", ["WIND_SPEED"], ["WIND_DIR"], "1h", "2 hours"
    )
    run = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    run.start(str(tmp_path / "out")).awaitTermination()
    got = {(r.STATION, r.DATE): (r.WIND_SPEED, r.WIND_DIR) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = resample_mean(raw, "STATION", "DATE", ["WIND_SPEED"], ["WIND_DIR"], "1h").where("WIND_SPEED IS NOT NULL")
    closed = raw.agg(F.max("DATE")).first()[0] - dt.timedelta(hours=3)
    wanted = {(r.STATION, r.DATE): (r.WIND_SPEED, r.WIND_DIR) for r in batch.collect() if r.DATE <= closed}
    assert got.keys() == wanted.keys()
    for key, values in wanted.items():
        assert got[key] == pytest.approx(values)
    with pytest.raises(ValueError):
        stream_resample(raw, "STATION", "DATE", ["WIND_SPEED"], [], "7h", "1 hour")


def test_stream_scoring_does_not_depend_on_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = [(s, 12, i, i + 12, START, START, rng.gauss(0, 1) + 1.2 * ((i // 3) % 2)) for s in "AB" for i in range(60)]
    windows = spark.createDataFrame(rows, [*META, "x_mean"])
    hmm = HmmParameters(np.array([0.5, 0.5]), np.array([[0.8, 0.2], [0.2, 0.8]]), np.array([[-0.5], [0.7]]), np.array([[1.0], [1.0]]))
    scaler = spark.createDataFrame([("x_mean", 0.5, 1.0)], "column string, mean double, scale double")
    models = StoredModels(scaler, hmm, {"window_features": ["x_mean"], "numeric": [], "directional": []})
    wanted = {(r.station, r.end_idx): r.micro_state for r in score_windows(windows, models, causal=True).collect()}
    assert len(wanted) == 120 and len(set(wanted.values())) == 2
    for n in (1, 2, 5):
        source = str(tmp_path / f"in{n}")
        for part in range(n):  # one file and one micro-batch per part
            low, high = 60 * part // n, 60 * (part + 1) // n
            windows.where(F.col("start_idx").between(low, high - 1)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(windows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        for _ in range(2):  # a restart adds nothing
            stream_score(stream, models, str(tmp_path / f"out{n}"), str(tmp_path / f"state{n}")).start().awaitTermination()
        got = spark.read.parquet(str(tmp_path / f"out{n}")).collect()
        assert len(got) == 120 and {(r.station, r.end_idx): r.micro_state for r in got} == wanted


def test_shared_folder(spark):
    folder = shared_dir(spark)
    assert shared_dir(spark) == folder == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(5)
    assert stage(df, "numbers").count() == 5 and cut_lineage(df).count() == 5
