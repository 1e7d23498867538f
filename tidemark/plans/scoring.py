"""Scoring telemetry with stored models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import lookup_default, sentinel_to_null
from tidemark.functions.times import duration_hours
from tidemark.operators.hmm import hmm_decode
from tidemark.operators.labels import label_positions
from tidemark.operators.latent import project, reconstruction_error
from tidemark.operators.quality import quality_preprocess
from tidemark.operators.reports import macro_names, name_macro_states
from tidemark.operators.resample import resample_mean
from tidemark.operators.scaling import apply_scaler, feature_array
from tidemark.operators.series import block_of, number_rows
from tidemark.operators.windows import META, filter_stats, multiscale_windows, sliding_windows
from tidemark.params import Params
from tidemark.sources.model_store import LATENT_MODE, StoredModels
from tidemark.sources.readers import align_schema, ingest_clean, model_features, normalize_headers


def same(df: DataFrame, name: str) -> DataFrame:
    """The default for ``keep``: no intermediate table."""
    return df


def window_features(grid: DataFrame, params: Params, features: Sequence[str]) -> DataFrame:
    """Windows of the configured kind over a cleaned grid."""
    c, w = params.columns, params.windows
    if w.multiscale:
        return multiscale_windows(grid, c.station, c.timestamp, "pos", features, w.scales, w.stride)
    return sliding_windows(grid, c.station, c.timestamp, "pos", features, w.size, w.step, w.stats)


def window_feature_columns(windows: DataFrame, params: Params) -> list[str]:
    names = [n for n in windows.columns if n not in META]
    return names if params.windows.multiscale else filter_stats(names, params.windows.stats)


def clean_grid(
    raw: DataFrame,
    params: Params,
    numeric: Sequence[str],
    directional: Sequence[str],
    bounds: DataFrame | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = same,
) -> tuple[DataFrame, DataFrame]:
    """Raw rows to a regular, filled, clipped grid; and the quality report.

    ``keep`` may write an intermediate result that is read more than once.
    """
    c, q = params.columns, params.quality
    rows = sentinel_to_null(raw, [*numeric, *directional], q.sentinels)
    grid = keep(resample_mean(rows, c.station, c.timestamp, numeric, directional, c.width), "grid")
    cleaned, report = quality_preprocess(
        grid, c.station, "pos", numeric, directional, q, bounds=bounds, between=lambda df: keep(df, "filled")
    )
    if q.drop_large_gap_rows:
        buckets = {"part": block_of(F.col("_bin_pos"))}
        cleaned = number_rows(
            cleaned.withColumnRenamed("pos", "_bin_pos"), [c.station], ["_bin_pos"], buckets, "pos"
        ).drop("_bin_pos")
    return cleaned, report


def score_vectors(windows: DataFrame, models: StoredModels) -> tuple[DataFrame, str]:
    """Windows with the vector that the sequence model reads, and its name; ``_x`` is the scaled features."""
    columns = models.settings["window_features"]
    # Features are scaled under other names, so that the windows keep theirs.
    own = {c: f"_scaled_{i}" for i, c in enumerate(columns)}
    copied = windows.withColumns({name: F.col(c) for c, name in own.items()})
    parameters = models.scaler.replace(own, subset=["column"])
    scaled = feature_array(apply_scaler(copied, list(own.values()), parameters), list(own.values()), "_x").drop(*own.values())
    if models.mode == LATENT_MODE:
        return project(scaled, "_x", models.basis, "_z"), "_z"
    return scaled, "_x"


def score_states(decoded: DataFrame, models: StoredModels) -> tuple[DataFrame, list[str]]:
    """Adds the macro state of ``micro_state`` and, if embedded, the error; and the names of what scoring adds."""
    added = ["micro_state", "macro_state"]
    if models.mode == LATENT_MODE:
        pairs = {int(r["micro_state"]): int(r["macro_state"]) for r in models.mapping.collect()}
        decoded = reconstruction_error(
            decoded, "_x", models.basis.as_table(decoded.sparkSession),
            F.array(*[F.lit(float(m)) for m in models.basis.mean]),
        )
        return decoded.withColumn("macro_state", lookup_default(F.col("micro_state"), pairs)), [*added, "reconstruction_error"]
    return decoded.withColumn("macro_state", F.col("micro_state")), added


def score_windows(
    windows: DataFrame, models: StoredModels, keys: Sequence[str] = ("station",), causal: bool = False
) -> DataFrame:
    """Window table to ``micro_state, macro_state, macro_state_name`` and, if embedded, the error.

    ``causal`` gives each window the state that is known when it ends, as a stream does.
    """
    scaled, vector = score_vectors(windows, models)
    ordered = label_positions(scaled.select("station", "end_idx", *dict.fromkeys(("_x", vector))), list(keys), name="_seq")
    decoded = hmm_decode(ordered, list(keys), "_seq", vector, models.hmm, "micro_state", causal=causal)
    decoded, added = score_states(decoded, models)
    means = [n for n in windows.columns if n.endswith("_mean")]
    return windows.join(decoded.select("station", "end_idx", *added), ["station", "end_idx"]).select(
        *META, *added, *means, duration_hours(F.col("start_time"), F.col("end_time")).alias("duration_hours")
    )


def name_scored(scored: DataFrame) -> DataFrame:
    return name_macro_states(scored, macro_names(scored))


def score_run(
    raw: DataFrame,
    params: Params,
    models: StoredModels,
    use_stored_bounds: bool = True,
    keep: Callable[[DataFrame, str], DataFrame] = same,
) -> tuple[DataFrame, DataFrame]:
    """Raw rows to the cleaned grid and the scored windows.

    Clip bounds come from the training run; ``use_stored_bounds=False`` recomputes them on the rows
    being scored.
    """
    c = params.columns
    numeric, directional = models.settings["numeric"], models.settings["directional"]
    named = align_schema(normalize_headers(raw, c.station, c.timestamp), [*numeric, *directional])
    rows = ingest_clean(named, c.timestamp, c.station, [*numeric, *directional])
    grid, _ = clean_grid(rows, params, numeric, directional, models.bounds if use_stored_bounds else None, keep)
    windows = keep(window_features(grid, params, model_features(numeric, directional, grid.columns)), "windows")
    return grid, name_scored(score_windows(windows, models))


def score_telemetry(
    raw: DataFrame,
    params: Params,
    models: StoredModels,
    use_stored_bounds: bool = True,
    keep: Callable[[DataFrame, str], DataFrame] = same,
) -> DataFrame:
    """The scored windows of ``score_run``."""
    return score_run(raw, params, models, use_stored_bounds, keep)[1]
