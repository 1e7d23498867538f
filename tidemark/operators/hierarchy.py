"""Micro states grouped into macro regimes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.agreement import centroids
from tidemark.operators.clusters import kmeans_fit
from tidemark.operators.labels import transition_matrix
from tidemark.operators.profiles import map_micro_to_macro

# Labelings from which macro regimes are derived, most preferred first.
SOURCE_ORDER = ("dense_ae_hmm", "dense_ae_kmeans", "hmm", "vae_ablation", "deep_lstm_ae", "gmm", "kmeans")


def hierarchy_source(available: Sequence[str], order: Sequence[str] = SOURCE_ORDER) -> str | None:
    """The most preferred labeling among those available."""
    return next((name for name in order if name in set(available)), None)


def hierarchy_labels(df: DataFrame, label_columns: dict[str, str], name: str = "hierarchy_label") -> DataFrame:
    """Adds the label of the most preferred model that has one, row by row, and that model's name."""
    ordered = [m for m in SOURCE_ORDER if m in label_columns]
    if not ordered:
        raise ValueError("no known labeling to build on")
    source = F.coalesce(*[F.when(F.col(label_columns[m]).isNotNull(), F.lit(m)) for m in ordered])
    return df.withColumn(name, F.coalesce(*[F.col(label_columns[m]) for m in ordered])).withColumn("hierarchy_source", source)


def _ward(points: np.ndarray, sizes: int) -> list[int]:
    """Merge the pair of groups that adds least variance until ``sizes`` groups are left."""
    groups = [[i] for i in range(len(points))]
    while len(groups) > sizes:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                a, b = points[groups[i]], points[groups[j]]
                gap = a.mean(axis=0) - b.mean(axis=0)
                cost = len(a) * len(b) / (len(a) + len(b)) * float(gap @ gap)
                if best is None or cost < best[0]:
                    best = (cost, i, j)
        _, i, j = best
        groups[i] = sorted(groups[i] + groups.pop(j))
    groups.sort(key=lambda g: g[0])
    label = {member: g for g, members in enumerate(groups) for member in members}
    return [label[i] for i in range(len(points))]


def super_regimes(
    df: DataFrame, label: str, vector: str, n_super: int = 2, name: str = "super_regime"
) -> tuple[DataFrame, DataFrame] | None:
    """Labels merged to ``n_super`` groups by the distance of their mean vectors, and the mapping.

    Groups are numbered by their smallest state. None with fewer than two states. Only the mean
    vectors, one per state of a model, reach the driver.
    """
    rows = centroids(df, label, vector).orderBy("label").collect()
    if len(rows) < 2:
        return None
    merged = _ward(np.array([r["centroid"] for r in rows]), min(int(n_super), len(rows)))
    mapping = df.sparkSession.createDataFrame(
        [(int(r["label"]), int(g)) for r, g in zip(rows, merged)], "micro_state int, macro_state int"
    )
    return map_micro_to_macro(df, label, mapping, name), mapping


def macro_from_state_means(
    labels: DataFrame,
    state_means: DataFrame,
    keys: Sequence[str],
    position: str,
    micro: str,
    n_macro: int = 4,
    seed: int = 42,
    restarts: int = 20,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Macro labels, the micro to macro mapping and the macro transition matrix.

    ``state_means`` is ``state, mean`` with one row per micro state; at least two are needed.
    """
    states = state_means.count()
    if states < 2:
        raise ValueError("at least two micro states are needed")
    fit = kmeans_fit(state_means, "mean", min(int(n_macro), states), seed, restarts, name="macro_state")
    mapping = fit.labels.select(F.col("state").cast("int").alias("micro_state"), "macro_state")
    macro = map_micro_to_macro(labels, micro, mapping)
    return macro, mapping, transition_matrix(macro, keys, position, "macro_state")
