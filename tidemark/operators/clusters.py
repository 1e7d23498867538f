"""KMeans and Gaussian mixtures over windows, with selection of the number of states."""

from __future__ import annotations

import math
from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.agreement import silhouette_exact, silhouette_fast, silhouette_sampled

# The silhouettes of a selection and how their metrics are named. They are different numbers: the exact one
# compares every two points, the sampled one judged points with all, the squared one needs work in proportion to the rows.
SILHOUETTE_NAMES = {"exact": "silhouette", "squared": "silhouette_squared", "sampled": "silhouette_sampled"}


@dataclass
class ClusterFit:
    """A fitted model with its labels and, after a selection, the score of every candidate."""

    labels: DataFrame
    k: int
    model: object
    score: float | None = None
    scores: dict[int, float] | None = None
    aic: dict[int, float] | None = None


@contextmanager
def kept(df: DataFrame):
    """Hold ``df`` for a loop of passes and let it go afterwards."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_vector", array_to_vector(F.col(vector).cast("array<double>")))


def _labelled(model, df: DataFrame, name: str) -> DataFrame:
    extra = {"_vector", "_probability"}
    out = model.transform(df)
    return out.withColumn(name, F.col("_prediction").cast("int")).drop("_prediction", *extra)


def candidate_states(candidates: Iterable[int]) -> list[int]:
    ks = sorted({int(k) for k in candidates if int(k) >= 2})
    if not ks:
        raise ValueError("no candidate number of states of at least 2")
    return ks


def kmeans_fit(
    df: DataFrame, vector: str, k: int, seed: int = 42, restarts: int = 20, max_iter: int = 100, name: str = "regime"
) -> ClusterFit:
    """Best of ``restarts`` runs by training cost."""
    with kept(_vectors(df.select(vector), vector)) as rows:
        best = None
        for offset in range(max(1, restarts)):
            model = KMeans(
                k=k, seed=seed + offset, maxIter=max_iter, tol=1e-4, featuresCol="_vector", predictionCol="_prediction"
            ).fit(rows)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
    return ClusterFit(_labelled(best, _vectors(df, vector), name), k, best, float(best.summary.trainingCost))


def silhouette_for_selection(df: DataFrame, point: str, label: str, vector: str, kind: str = "sampled") -> float:
    """The silhouette that the caller asks for, whatever the number of rows."""
    if kind not in SILHOUETTE_NAMES:
        raise ValueError(f"silhouette must be one of {sorted(SILHOUETTE_NAMES)}")
    if kind == "squared":
        return silhouette_fast(df, label, vector)
    if kind == "sampled":
        return float(silhouette_sampled(df, point, label, vector).first()["silhouette_sampled"])
    return float(silhouette_exact(df, point, label, vector).first()["silhouette"])


def kmeans_select_k(
    df: DataFrame,
    point: str,
    vector: str,
    candidates: Iterable[int],
    seed: int = 42,
    restarts: int = 20,
    name: str = "regime",
    silhouette: str = "sampled",
) -> ClusterFit:
    """The candidate with the largest silhouette, the smallest k on ties. ``point`` identifies rows."""
    return _select(df, point, vector, candidate_states(candidates), seed, restarts, name, silhouette)


def embedding_select_k(
    df: DataFrame,
    point: str,
    vector: str,
    candidates: Iterable[int],
    seed: int = 42,
    restarts: int = 20,
    name: str = "regime",
    silhouette: str = "sampled",
) -> ClusterFit | None:
    """As ``kmeans_select_k`` on an embedding, trying candidates in the order given.

    None when no candidate yields at least two clusters.
    """
    fit = _select(df, point, vector, [int(k) for k in candidates], seed, restarts, name, silhouette)
    return fit if fit.score is not None and fit.score > -1.0 else None


def _select(df, point, vector, ks, seed, restarts, name, silhouette) -> ClusterFit:
    best = None
    scores = {}
    with kept(df.select(point, vector)) as rows:
        for k in ks:
            fit = kmeans_fit(rows, vector, k, seed, restarts, name="_label")
            scores[k] = silhouette_for_selection(fit.labels, point, "_label", vector, silhouette)
            if best is None or scores[k] > scores[best.k]:
                best = fit
    labels = _labelled(best.model, _vectors(df, vector), name)
    return ClusterFit(labels, best.k, best.model, scores[best.k], scores)


def gmm_fit(df: DataFrame, vector: str, k: int, seed: int = 42, max_iter: int = 100, name: str = "regime") -> ClusterFit:
    """Full-covariance mixture; ``score`` is the log-likelihood."""
    rows = _vectors(df, vector)
    model = GaussianMixture(
        k=k, seed=seed, maxIter=max_iter, tol=1e-3, featuresCol="_vector", predictionCol="_prediction",
        probabilityCol="_probability",
    ).fit(rows)
    return ClusterFit(_labelled(model, rows, name), k, model, float(model.summary.logLikelihood))


def mixture_parameters(k: int, dimensions: int) -> int:
    return k * dimensions + k * dimensions * (dimensions + 1) // 2 + k - 1


def gmm_select_k(
    df: DataFrame, vector: str, candidates: Iterable[int], seed: int = 42, max_iter: int = 100, name: str = "regime"
) -> ClusterFit:
    """The candidate with the smallest BIC; AIC is reported beside it."""
    bic, aic = {}, {}
    best = None
    with kept(df.select(vector)) as rows:
        total, dimensions = rows.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
        for k in candidate_states(candidates):
            fit = gmm_fit(rows, vector, k, seed, max_iter)
            free = mixture_parameters(k, dimensions)
            bic[k] = -2 * fit.score + free * math.log(total)
            aic[k] = -2 * fit.score + 2 * free
            if best is None or bic[k] < bic[best.k]:
                best = fit
    return ClusterFit(_labelled(best.model, _vectors(df, vector), name), best.k, best.model, bic[best.k], bic, aic)


def score_table(df: DataFrame, family: str, scores: dict[int, float]) -> DataFrame:
    """``family, k, score`` rows of a selection, as a table."""
    return df.sparkSession.createDataFrame(
        [(family, int(k), float(s)) for k, s in scores.items()], "family string, k int, score double"
    )
