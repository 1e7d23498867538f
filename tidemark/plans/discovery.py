"""The full run: raw telemetry to labelled windows, diagnostics and stored models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.agreement import davies_bouldin
from tidemark.operators.boundaries import boundary_precision_recall
from tidemark.operators.changepoints import changepoints, landmark_changepoints
from tidemark.operators.clusters import SILHOUETTE_NAMES, gmm_select_k, kmeans_select_k, silhouette_for_selection
from tidemark.operators.hierarchy import hierarchy_source, macro_from_state_means, super_regimes
from tidemark.operators.hmm import HmmFit, hmm_decode, hmm_seed_stability, hmm_select_states
from tidemark.operators.labels import (
    duration_statistics,
    label_positions,
    labels_to_boundaries,
    pressure_drop,
    regime_durations,
    smooth_labels,
    transition_entropy,
    transition_matrix,
)
from tidemark.operators.latent import LinearBasis, latent_embedding, pca_projection, reconstruction_error
from tidemark.operators.profiles import regime_profiles
from tidemark.operators.quality import final_quality_flags
from tidemark.operators.reports import error_summary
from tidemark.operators.scaling import apply_scaler, feature_array, scaler_params
from tidemark.functions.scalars import first_mean_column, present
from tidemark.operators.windows import META
from tidemark.params import Params
from tidemark.plans.scoring import clean_grid, window_feature_columns, window_features
from tidemark.session import stage
from tidemark.sources.model_store import StoredModels
from tidemark.sources.readers import ingest_clean, model_features, select_features

STABILITY_SEEDS = (0, 100)


@dataclass
class Discovery:
    """Result tables. ``labelled`` holds window meta and one ``regime_<model>`` column per model."""

    grid: DataFrame
    quality: DataFrame
    quality_flags: DataFrame
    windows: DataFrame
    labelled: DataFrame
    metrics: list[tuple[str, str, float]]
    diagnostics: dict[str, DataFrame]
    models: StoredModels | None
    fits: dict[str, object] = field(default_factory=dict)

    def metrics_frame(self, experiment_id: str = "run") -> DataFrame:
        return self.grid.sparkSession.createDataFrame(
            [(experiment_id, *m) for m in self.metrics], "experiment_id string, model string, metric string, value double"
        )


# Metrics of the two searches, which are different numbers.
BREAK_COUNTS = {"landmarks": "n_breaks_landmarks", "pairs": "n_breaks"}


def _changepoints(base: DataFrame, keys: list[str], m) -> DataFrame:
    """Breaks of every series by the search that the settings ask for."""
    if m.changepoint_search not in BREAK_COUNTS:
        raise ValueError(f"changepoint_search must be one of {sorted(BREAK_COUNTS)}")
    if m.changepoint_search == "pairs":
        return changepoints(base, keys, "seq", "x", m.changepoint_penalty, m.changepoint_segment, bandwidth=m.changepoint_bandwidth)
    return landmark_changepoints(base, keys, "seq", "x", m.changepoint_penalty, bandwidth=m.changepoint_bandwidth)


def discover(
    raw: DataFrame,
    params: Params,
    keys: Sequence[str] = ("station",),
    latent: bool = False,
    stability: bool = True,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> Discovery:
    """Find regimes in ``raw``.

    ``keys`` is the scope of a sequence: ``('station',)`` keeps stations apart, ``()`` strings all
    windows together in (station, end_idx) order. ``latent`` adds models on a linear embedding.
    """
    c, m = params.columns, params.models
    keys = list(keys)
    rows = ingest_clean(raw, c.timestamp, c.station, [*c.numeric, *c.directional])
    numeric = select_features(rows, c.numeric, c.station)
    directional = present(rows, c.directional)
    grid, quality = clean_grid(rows, params, numeric, directional, keep=keep)
    grid = keep(grid, "cleaned")
    features = model_features(numeric, directional, grid.columns)
    windows = keep(window_features(grid, params, features), "windows")
    columns = window_feature_columns(windows, params)
    scaler = keep(scaler_params(windows, columns), "scaler")
    vectors = feature_array(apply_scaler(windows, columns, scaler), columns, "x").select("station", "end_idx", "x")
    base = keep(
        label_positions(vectors, keys, name="seq").withColumn(
            "point", F.concat_ws("\u0001", "station", F.col("end_idx").cast("string"))
        ),
        "vectors",
    )
    run = _Run(base, windows, keys, m, keep)

    kmeans = kmeans_select_k(base, "point", "x", m.candidates, m.seed, m.restarts, "label", m.silhouette)
    run.add("kmeans", kmeans.labels, "x", {SILHOUETTE_NAMES[m.silhouette]: kmeans.score, "n_states": kmeans.k}, kmeans.k)
    gmm = gmm_select_k(base, "x", m.candidates, m.seed, name="label")
    run.add("gmm", gmm.labels, "x", {"bic": gmm.score, "aic": gmm.aic[gmm.k], "n_states": gmm.k}, gmm.k)
    hmm = run.add_hmm("hmm", base, "x")
    fits: dict[str, object] = {"kmeans": kmeans, "gmm": gmm, "hmm": hmm}

    breaks = keep(_changepoints(base, keys, m), "changepoints")
    run.metrics.append(("changepoint", BREAK_COUNTS[m.changepoint_search], float(breaks.count())))
    run.diagnostics["changepoints"] = breaks
    seeds = {*STABILITY_SEEDS, m.seed}
    if stability:
        states = hmm.parameters.states if hmm else max(m.candidates)
        run.add_stability("hmm_raw_features", base, "x", states, seeds)

    basis: LinearBasis | None = None
    mapping: DataFrame | None = None
    if latent:
        basis, mapping, fits["dense_ae_hmm"] = _latent_branch(run, base, columns, windows, stability, seeds)

    source = hierarchy_source(run.labels)
    merged = super_regimes(run.joined(source), "label", "x", m.super_regimes) if source else None
    if merged is not None:
        run.labels["hierarchy_super"] = keep(
            merged[0].select("station", "end_idx", "seq", F.col("super_regime").alias("label")), "hierarchy_super"
        )
        run.diagnostics["super_regimes"] = merged[1]
        run.metrics.append(("hierarchy_super", "n_super_regimes", float(min(m.super_regimes, merged[1].count()))))

    if base.limit(3).count() >= 3:
        run.diagnostics["pca_projection"] = pca_projection(base, "x").select("station", "end_idx", "pc1", "pc2")
    for name, labels in run.labels.items():
        found = labels_to_boundaries(labels, keys, "seq", "label")
        run.diagnostics[f"changepoint_alignment_{name}"] = boundary_precision_recall(
            breaks, found, keys, m.boundary_tolerance, series=labels
        )

    labelled = windows.select(*META)
    for name, labels in run.labels.items():
        labelled = labelled.join(
            labels.select("station", "end_idx", F.col("label").alias(f"regime_{name}")), ["station", "end_idx"]
        )
    settings = {
        "numeric": numeric, "directional": directional, "model_features": features, "window_features": columns,
        "params": params.to_dict(),
    }
    scoring_hmm = fits.get("dense_ae_hmm") or hmm
    models = None
    if scoring_hmm is not None:
        bounds = quality.select("column", "clip_low", "clip_high")
        models = StoredModels(scaler, scoring_hmm.parameters, settings, bounds, basis, mapping)
    return Discovery(
        grid, quality, final_quality_flags(grid, windows, numeric, features, columns), windows,
        keep(labelled.select(*META, *[f"regime_{n}" for n in run.labels]), "labelled"),
        run.metrics, run.diagnostics, models, fits,
    )


class _Run:
    """Collects labels, metrics and diagnostics model by model."""

    def __init__(self, base, windows, keys, settings, keep):
        self.base, self.windows, self.keys, self.settings, self.keep = base, windows, keys, settings, keep
        self.labels: dict[str, DataFrame] = {}
        self.metrics: list[tuple[str, str, float]] = []
        self.diagnostics: dict[str, DataFrame] = {}

    def joined(self, name: str) -> DataFrame:
        return self.base.join(self.labels[name].select("station", "end_idx", "label"), ["station", "end_idx"])

    def add(self, name, labels, vector, scores, states, smooth=True, matrix=None) -> DataFrame:
        """Smooth the labels of a model, keep them and measure them."""
        kept = labels.select("station", "end_idx", "seq", F.col("label").cast("int").alias("label"))
        if smooth:
            kept = smooth_labels(kept, self.keys, "seq", "label", self.settings.min_segment).select(
                "station", "end_idx", "seq", F.col("smoothed").alias("label")
            )
        kept = self.keep(kept, f"labels-{name}")
        self.labels[name] = kept
        judged = labels.select("station", "end_idx", "point", vector).join(kept, ["station", "end_idx"])
        durations = duration_statistics(regime_durations(kept, self.keys, "seq", "label"))
        if matrix is None:
            matrix = transition_matrix(kept, self.keys, "seq", "label", states)
        measured = {
            **scores,
            f"{SILHOUETTE_NAMES[self.settings.silhouette]}_post": silhouette_for_selection(
                judged, "point", "label", vector, self.settings.silhouette
            ),
            "davies_bouldin": davies_bouldin(judged, "label", vector).first()[0],
            "mean_regime_duration": durations.first()["mean_duration"],
            "transition_entropy": transition_entropy(matrix).first()[0],
        }
        self.metrics += [(name, metric, float(value)) for metric, value in measured.items()]
        self.diagnostics[f"duration_stats_{name}"] = durations
        self.diagnostics[f"transition_matrix_{name}"] = matrix
        return kept

    def add_hmm(self, name: str, frame: DataFrame, vector: str) -> HmmFit | None:
        s = self.settings
        fit = hmm_select_states(
            frame, self.keys, "seq", vector, s.candidates, s.seed, s.hmm_iterations, s.hmm_tolerance
        )
        if fit is None:
            return None
        decoded = hmm_decode(frame, self.keys, "seq", vector, fit.parameters, "label")
        scores = {"n_states": fit.parameters.states, "log_likelihood": fit.log_likelihood, "bic": fit.bic}
        matrix = fit.parameters.transition_table(frame.sparkSession)
        self.add(name, decoded, vector, scores, fit.parameters.states, matrix=matrix)
        return fit

    def add_stability(self, name, frame, vector, states, seeds) -> None:
        s = self.settings
        pairs = hmm_seed_stability(
            frame, self.keys, "seq", vector, states, seeds, s.hmm_iterations, s.hmm_tolerance
        )
        if pairs is not None:
            self.diagnostics[f"stability_{name}"] = pairs


def _latent_branch(run: _Run, base, columns, windows, stability, seeds):
    """Models on the linear embedding that stands in for a trained encoder."""
    m = run.settings
    embedded, basis = latent_embedding(base, "x", min(m.latent_dim, len(columns)), "z")
    embedded = run.keep(embedded, "latent")
    errors = reconstruction_error(
        embedded, "x", basis.as_table(base.sparkSession), F.array(*[F.lit(v) for v in basis.mean])
    )
    run.diagnostics["reconstruction_error"] = error_summary(errors, "reconstruction_error")
    kmeans = kmeans_select_k(embedded, "point", "z", m.candidates, m.seed, m.restarts, "label", m.silhouette)
    run.add("dense_ae_kmeans", kmeans.labels, "z", {f"{SILHOUETTE_NAMES[m.silhouette]}_embed": kmeans.score, "n_states": kmeans.k}, kmeans.k)
    fit = run.add_hmm("dense_ae_hmm", embedded, "z")
    if fit is None:
        return None, None, None
    means = fit.parameters.state_table(base.sparkSession).select("state", "mean")
    macro, mapping, matrix = macro_from_state_means(
        run.labels["dense_ae_hmm"], means, run.keys, "seq", "label", m.super_regimes, m.seed, m.restarts
    )
    mapping = run.keep(mapping, "macro-mapping")
    labels = embedded.join(macro.select("station", "end_idx", F.col("macro_state").alias("label")), ["station", "end_idx"])
    n_macro = mapping.select("macro_state").distinct().count()
    kept = run.add("dense_ae_hmm_macro", labels, "z", {"n_states": n_macro}, n_macro, smooth=False, matrix=matrix)
    described = windows.join(kept.select("station", "end_idx", "seq", "label"), ["station", "end_idx"])
    run.diagnostics["macro_profiles"] = regime_profiles(described, "label", ["start_idx", "end_idx", "window_scale", "seq"])
    pressure = first_mean_column(windows.columns, "SEA_LVL_PRES")
    if pressure is not None:
        run.diagnostics["macro_pressure_drop"] = pressure_drop(described, run.keys, "seq", "label", pressure)
    if stability:
        run.add_stability("hmm_dense_latent", embedded, "z", fit.parameters.states, seeds)
    return basis, mapping, fit
