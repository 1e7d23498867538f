"""One discovery run with everything it produces written to a folder, ready for comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.experiments import (
    append_record,
    comparative_mean_by_model,
    comparative_rows,
    experiment_record,
    union_experiments,
)
from tidemark.params import Params
from tidemark.plans.discovery import Discovery, discover
from tidemark.sources.model_store import save_models
from tidemark.sources.writers import export_report, write_processed, write_reports_json, write_window_features, write_window_regimes


def run_experiment(
    raw: DataFrame,
    params: Params,
    experiment_id: str,
    root: str,
    notes: str = "",
    keys: Sequence[str] = ("station",),
    latent: bool = False,
    stability: bool = True,
) -> Discovery:
    """Discover regimes in ``raw`` and write tables, reports, models and the record below ``root``."""
    spark = raw.sparkSession
    result = discover(raw, params, keys, latent, stability)
    folder = f"{root}/{experiment_id}"
    artifacts = f"{folder}/artifacts"
    write_processed(result.grid, f"{artifacts}/processed_data")
    write_window_features(result.windows, f"{artifacts}/window_features")
    write_window_regimes(result.labelled, f"{artifacts}/window_regimes")
    metrics = result.metrics_frame(experiment_id)
    reports = {"model_metrics": metrics, "quality_report": result.quality, "quality_flags": result.quality_flags}
    write_reports_json({**reports, **result.diagnostics}, f"{artifacts}/reports")
    if result.models is not None:
        save_models(spark, result.models, f"{artifacts}/models")
    entropies = metrics.where(F.col("metric") == "transition_entropy").select(
        "experiment_id", "model", F.col("value").alias("transition_entropy")
    )
    export_report(comparative_rows(metrics, entropies, params.models.silhouette).coalesce(1), f"{folder}/comparative_rows.csv")
    append_record(
        experiment_record(metrics, experiment_id, params.to_dict(), notes, {"quality_report": result.quality}),
        f"{folder}/experiment",
    )
    return result


def compare_experiments(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """All comparative rows below ``root`` and their mean per model; both are written there too."""
    rows = union_experiments(spark, root)
    means = comparative_mean_by_model(rows)
    export_report(rows, f"{root}/comparative_results.csv")
    export_report(means, f"{root}/comparative_results_mean_by_model.csv")
    return rows, means
