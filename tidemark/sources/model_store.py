"""Fitted parameters as tables in one folder."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.hmm import HmmParameters, parameters_from_tables
from tidemark.operators.latent import LinearBasis

PLAIN_MODE = "hmm_only"
LATENT_MODE = "dense_hierarchical"


@dataclass
class StoredModels:
    """What scoring needs. ``mode`` tells whether windows are embedded before the sequence model."""

    scaler: DataFrame
    hmm: HmmParameters
    settings: dict
    bounds: DataFrame | None = None
    basis: LinearBasis | None = None
    mapping: DataFrame | None = None

    @property
    def mode(self) -> str:
        return LATENT_MODE if self.basis is not None and self.mapping is not None else PLAIN_MODE


def save_models(spark: SparkSession, models: StoredModels, path: str) -> None:
    tables = {
        "scaler": models.scaler,
        "hmm_states": models.hmm.state_table(spark),
        "hmm_transitions": models.hmm.transition_table(spark),
    }
    if models.bounds is not None:
        tables["clip_bounds"] = models.bounds
    if models.mode == LATENT_MODE:
        tables["macro_mapping"] = models.mapping
        tables["basis"] = models.basis.as_table(spark)
        tables["basis_mean"] = spark.createDataFrame([(models.basis.mean,)], "mean array<double>")
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    manifest = [(models.mode, json.dumps(models.settings), sorted(tables))]
    # Written last: a folder with a manifest is complete.
    spark.createDataFrame(manifest, "mode string, settings string, tables array<string>").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/manifest")


def load_models(spark: SparkSession, path: str) -> StoredModels:
    manifest = spark.read.schema("mode string, settings string, tables array<string>").json(f"{path}/manifest").first()

    def table(name: str) -> DataFrame | None:
        return spark.read.parquet(f"{path}/{name}") if name in manifest["tables"] else None

    basis = None
    if manifest["mode"] == LATENT_MODE:
        weights = [list(r["weights"]) for r in table("basis").orderBy("component").collect()]
        basis = LinearBasis(list(table("basis_mean").first()["mean"]), weights)
    return StoredModels(
        table("scaler"),
        parameters_from_tables(table("hmm_states"), table("hmm_transitions")),
        json.loads(manifest["settings"]),
        table("clip_bounds"),
        basis,
        table("macro_mapping"),
    )
