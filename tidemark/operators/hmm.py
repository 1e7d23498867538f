"""Gaussian hidden Markov models over ordered windows, for series of any length.

A forward or Viterbi recursion is a chain of small matrix products, and a chain may be bracketed at
will. A series is cut into blocks; each block is reduced to one k x k table (stage 1), the tables of
a series are chained (stage 2), and with what enters and leaves every block known the blocks finish
independently (stage 3). The result equals the plain recursion over the series.

The chain of a series with more than ``CHAIN_TABLES`` blocks is itself cut: runs of tables are
multiplied first, the products are chained, and each run is then resolved from both its ends. No
task handles more than ``CHAIN_TABLES`` tables until a series has ``CHAIN_TABLES`` squared blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.agreement import adjusted_rand
from tidemark.operators.clusters import candidate_states, kmeans_fit
from tidemark.operators.series import BLOCK, block_of
from tidemark.session import stage

HMM_BLOCK_ROWS = 8_192
CHAIN_TABLES = 8_192
# The variance prior of the maximisation step and the floor of its denominator.
VARIANCE_PRIOR = 1e-2
DENOMINATOR_FLOOR = 1e-5
START_VARIANCE = 1e-3


@dataclass
class HmmParameters:
    """k start probabilities, k x k transitions, k x d means and variances."""

    start: np.ndarray
    transitions: np.ndarray
    means: np.ndarray
    variances: np.ndarray

    @property
    def states(self) -> int:
        return len(self.start)

    def transition_table(self, spark) -> DataFrame:
        k = self.states
        return spark.createDataFrame(
            [(i, j, float(self.transitions[i, j])) for i in range(k) for j in range(k)],
            "from_state int, to_state int, p double",
        )

    def state_table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [
                (s, float(self.start[s]), [float(x) for x in self.means[s]], [float(x) for x in self.variances[s]])
                for s in range(self.states)
            ],
            "state int, start double, mean array<double>, variance array<double>",
        )


def parameters_from_tables(states: DataFrame, transitions: DataFrame) -> HmmParameters:
    """The inverse of ``state_table`` and ``transition_table``."""
    rows = states.orderBy("state").collect()
    k = len(rows)
    matrix = np.zeros((k, k))
    for r in transitions.collect():
        matrix[r["from_state"], r["to_state"]] = r["p"]
    return HmmParameters(
        np.array([r["start"] for r in rows]),
        matrix,
        np.array([r["mean"] for r in rows]),
        np.array([r["variance"] for r in rows]),
    )


@dataclass
class HmmFit:
    parameters: HmmParameters
    log_likelihood: float
    bic: float | None = None
    bic_by_states: dict[int, float] = field(default_factory=dict)
    iterations: int = 0


def hmm_bic(log_likelihood: float, states: int, dimensions: int, rows: int) -> float:
    free = states * states + 2 * states * dimensions
    return -2.0 * log_likelihood + free * math.log(max(rows, 2))


def bic_table(scores: DataFrame) -> DataFrame:
    """Adds ``bic`` to rows of ``log_likelihood, states, dimensions, rows``."""
    free = F.col("states") * F.col("states") + 2 * F.col("states") * F.col("dimensions")
    return scores.withColumn(
        "bic", -2.0 * F.col("log_likelihood") + free * F.ln(F.greatest(F.col("rows"), F.lit(2)).cast("double"))
    )


def hmm_emission(df: DataFrame, vector: str, states: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep, state, log_density`` of each vector under each diagonal Gaussian state."""
    table = states.agg(F.array_sort(F.collect_list(F.struct("state", "mean", "variance")))).scalar()
    rows = df.select(*keep, F.col(vector).cast("array<double>").alias("_x"), F.explode(table).alias("_s"))
    terms = F.zip_with(
        F.zip_with("_x", F.col("_s.mean"), lambda x, m: (x - m) * (x - m)),
        F.col("_s.variance"),
        lambda sq, v: -0.5 * (F.ln(F.lit(2 * math.pi) * v) + sq / v),
    )
    density = F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)
    return rows.select(*keep, F.col("_s.state").alias("state"), density.alias("log_density"))


# ---- per-block arithmetic -------------------------------------------------------------------


def _log(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(p)


def emissions(x: np.ndarray, parameters: HmmParameters) -> np.ndarray:
    gap = (x[:, None, :] - parameters.means[None]) ** 2 / parameters.variances[None]
    norm = np.log(2 * np.pi * parameters.variances).sum(axis=1)
    return -0.5 * (gap.sum(axis=2) + norm[None])


def _logsumexp(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    return _log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis=axis)


def _likelihood_table(log_b: np.ndarray, first: bool, parameters: HmmParameters) -> np.ndarray:
    """log P(block, last state = j | state before the block = i)."""
    k = parameters.states
    scale = log_b.max(axis=1)
    b = np.exp(log_b - scale[:, None])
    enter = np.tile(parameters.start, (k, 1)) if first else parameters.transitions
    table = enter * b[0]
    logs = np.full(k, scale.sum())
    for t in range(1, len(b)):
        table = (table @ parameters.transitions) * b[t]
        size = table.sum(axis=1)
        size[size == 0] = 1.0
        logs += np.log(size)
        table /= size[:, None]
    return _log(table) + logs[:, None]


def _best_table(log_b: np.ndarray, first: bool, parameters: HmmParameters) -> np.ndarray:
    """Score of the best path through the block from state i before it to state j at its end."""
    k = parameters.states
    log_a = _log(parameters.transitions)
    table = (np.tile(_log(parameters.start), (k, 1)) if first else log_a) + log_b[0]
    for t in range(1, len(log_b)):
        table = (table[:, :, None] + log_a[None]).max(axis=1) + log_b[t]
    return table


def _expected_counts(x, log_b, first, before, after, evidence, parameters):
    """Sufficient statistics of one block: start, transitions, occupancy, sums and square sums."""
    k, n = parameters.states, len(x)
    a = parameters.transitions
    scale = log_b.max(axis=1)
    b = np.exp(log_b - scale[:, None])
    weight = np.exp(before - before.max()) if not first else None
    alpha = np.empty((n, k))
    alpha[0] = (parameters.start if first else weight @ a) * b[0]
    alpha[0] /= alpha[0].sum()
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ a) * b[t]
        alpha[t] /= alpha[t].sum()
    beta = np.empty((n, k))
    beta[-1] = np.exp(after - after.max())
    for t in range(n - 2, -1, -1):
        beta[t] = a @ (b[t + 1] * beta[t + 1])
        beta[t] /= beta[t].max()
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    incoming = b * beta
    if n > 1:
        joint = alpha[:-1, :, None] * a[None] * incoming[1:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    if not first:
        joint = weight[:, None] * a * incoming[0][None]
        pairs += joint / joint.sum()
    start = gamma[0] if first else np.zeros(k)
    return np.concatenate(
        [
            [evidence if first else 0.0],
            start,
            pairs.ravel(),
            gamma.sum(axis=0),
            (gamma.T @ x).ravel(),
            (gamma.T @ (x * x)).ravel(),
        ]
    )


def _best_path(log_b, first, entry, leave, parameters) -> np.ndarray:
    """Best states of one block that follow state ``entry`` and end in state ``leave``."""
    n = len(log_b)
    log_a = _log(parameters.transitions)
    back = np.zeros(log_b.shape, dtype=np.int64)
    score = (_log(parameters.start) if first else log_a[entry]) + log_b[0]
    for t in range(1, n):
        options = score[:, None] + log_a
        back[t] = options.argmax(axis=0)
        score = options.max(axis=0) + log_b[t]
    path = np.empty(n, dtype=np.int64)
    path[-1] = leave
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def causal_path(log_b, scores: np.ndarray | None, parameters) -> tuple[np.ndarray, np.ndarray]:
    """At each row the last state of the best path up to it, and the scores after the last row.

    ``scores`` are those after the row before the first, None at the start of a series. They are kept relative to
    their largest, which no comparison notices.
    """
    log_a = _log(parameters.transitions)
    path = np.empty(len(log_b), dtype=np.int64)
    for t, b in enumerate(log_b):
        scores = (_log(parameters.start) if scores is None else (scores[:, None] + log_a).max(axis=0)) + b
        path[t] = scores.argmax()
        scores = scores - scores[path[t]]
    return path, scores


# ---- the three stages -----------------------------------------------------------------------


def arrange_blocks(
    df: DataFrame, keys: Sequence[str], position: str, vector: str, block_rows: int = HMM_BLOCK_ROWS
) -> DataFrame:
    """``_series, _block, _p, _x`` laid out so that every later pass finds its blocks in place."""
    series = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    return (
        df.select(
            series.alias("_series"),
            block_of(F.col(position), block_rows).alias(BLOCK),
            F.col(position).alias("_p"),
            F.col(vector).cast("array<double>").alias("_x"),
        )
        .repartition("_series", BLOCK)
        .sortWithinPartitions("_series", BLOCK, "_p")
    )


@contextmanager
def arranged(df: DataFrame, keys: Sequence[str], position: str, vector: str, block_rows: int = HMM_BLOCK_ROWS):
    held = arrange_blocks(df, keys, position, vector, block_rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _matrix(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    ordered = pdf.sort_values("_p")
    return ordered, np.stack(ordered["_x"].to_numpy())


def _block_tables(blocks: DataFrame, parameters: HmmParameters, reduce_block) -> DataFrame:
    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        _, x = _matrix(pdf)
        block = int(pdf[BLOCK].iloc[0])
        values = reduce_block(emissions(x, parameters), block == 0, parameters)
        return pd.DataFrame({"_series": [pdf["_series"].iloc[0]], BLOCK: [block], "_table": [values.ravel()]})

    return blocks.groupBy("_series", BLOCK).applyInPandas(table, f"_series string, {BLOCK} long, _table array<double>")


def _sum_product(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _logsumexp(first[:, :, None] + second[None], axis=1)


def _best_product(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first[:, :, None] + second[None]).max(axis=1)


def _ordered_tables(pdf: pd.DataFrame, k: int) -> tuple[pd.DataFrame, list[np.ndarray]]:
    ordered = pdf.sort_values(BLOCK)
    return ordered, [np.asarray(t).reshape(k, k) for t in ordered["_table"]]


def _is_long(df: DataFrame, position: str = "_p", block_rows: int | None = None) -> bool:
    """Whether some series has too many blocks for one chain."""
    block = F.col(BLOCK) if block_rows is None else block_of(F.col(position), block_rows)
    top = df.agg(F.max(block)).first()[0]
    return top is not None and top >= CHAIN_TABLES


def _resolve(tables: DataFrame, k: int, product, walk, edge_schema: str, long_series: bool) -> DataFrame:
    """What enters and leaves every block: ``_series, _block`` and the columns of ``edge_schema``.

    ``walk(tables, starts_series, edge)`` goes through consecutive tables; ``edge`` is None for a
    whole series, else the columns found for the run of tables as one.
    """
    names = [part.split()[0] for part in edge_schema.split(", ")]
    schema = f"_series string, {BLOCK} long, {edge_schema}"

    def through(pdf: pd.DataFrame, edge: dict | None) -> pd.DataFrame:
        ordered, parts = _ordered_tables(pdf, k)
        found = walk(parts, int(ordered[BLOCK].iloc[0]) == 0, edge)
        return pd.DataFrame({"_series": ordered["_series"].to_numpy(), BLOCK: ordered[BLOCK].to_numpy(), **found})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return through(pdf, None)

    if not long_series:
        return tables.groupBy("_series").applyInPandas(whole, schema)

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered, parts = _ordered_tables(pdf, k)
        total = parts[0]
        for part in parts[1:]:
            total = product(total, part)
        run = int(ordered["_run"].iloc[0])
        return pd.DataFrame({"_series": [ordered["_series"].iloc[0]], BLOCK: [run], "_table": [total.ravel()]})

    def inside(pdf: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or edge.empty:
            return pd.DataFrame({c: [] for c in ("_series", BLOCK, *names)})
        return through(pdf, {n: edge[n].iloc[0] for n in names})

    runs = tables.withColumn("_run", block_of(F.col(BLOCK), CHAIN_TABLES))
    products = runs.groupBy("_series", "_run").applyInPandas(
        multiply, f"_series string, {BLOCK} long, _table array<double>"
    )
    edges = products.groupBy("_series").applyInPandas(whole, schema).withColumnRenamed(BLOCK, "_run")
    return runs.groupBy("_series", "_run").cogroup(edges.groupBy("_series", "_run")).applyInPandas(inside, schema)


def _evidence(blocks: DataFrame, parameters: HmmParameters, long_series: bool = False) -> DataFrame:
    """Per block: log weight of each state before it and after it, and the log-likelihood of its series."""
    k = parameters.states

    def walk(tables, starts_series, edge):
        before = [np.zeros(k) if edge is None else np.asarray(edge["_before"])]
        after = [np.zeros(k) if edge is None else np.asarray(edge["_after"])]
        for n, t in enumerate(tables):
            # Before the first block there is no state; all rows of its table are alike.
            starting = starts_series and n == 0
            before.append(t[0] if starting else _logsumexp(before[-1][:, None] + t, axis=0))
        for t in reversed(tables[1:]):
            after.append(_logsumexp(t + after[-1][None], axis=1))
        total = float(_logsumexp(before[-1], axis=0)) if edge is None else float(edge["_evidence"])
        return {"_before": before[:-1], "_after": after[::-1], "_evidence": total}

    tables = _block_tables(blocks, parameters, _likelihood_table)
    return _resolve(
        tables, k, _sum_product, walk, "_before array<double>, _after array<double>, _evidence double", long_series
    )


def log_likelihood(blocks: DataFrame, parameters: HmmParameters, long_series: bool = False) -> float:
    return float(
        _evidence(blocks, parameters, long_series).where(F.col(BLOCK) == 0).agg(F.coalesce(F.sum("_evidence"), F.lit(0.0))).first()[0]
    )


def _expectation(blocks: DataFrame, parameters: HmmParameters, long_series: bool = False) -> np.ndarray:
    def finish(rows: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or edge.empty:
            return pd.DataFrame({"_stats": []})
        _, x = _matrix(rows)
        stats = _expected_counts(
            x,
            emissions(x, parameters),
            int(edge[BLOCK].iloc[0]) == 0,
            np.asarray(edge["_before"].iloc[0]),
            np.asarray(edge["_after"].iloc[0]),
            float(edge["_evidence"].iloc[0]),
            parameters,
        )
        return pd.DataFrame({"_stats": [stats]})

    per_block = (
        blocks.groupBy("_series", BLOCK)
        .cogroup(_evidence(blocks, parameters, long_series).groupBy("_series", BLOCK))
        .applyInPandas(finish, "_stats array<double>")
    )
    # A fixed number of sums: 1 + k + k*k + k + 2*k*d.
    sums = per_block.select(F.posexplode("_stats").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    return np.array([r["v"] for r in sums.orderBy("i").collect()])


def _maximise(stats: np.ndarray, k: int, d: int) -> tuple[HmmParameters, float]:
    evidence, rest = float(stats[0]), stats[1:]
    start, rest = rest[:k], rest[k:]
    pairs, rest = rest[: k * k].reshape(k, k), rest[k * k :]
    held, rest = rest[:k], rest[k:]
    sums, squares = rest[: k * d].reshape(k, d), rest[k * d :].reshape(k, d)
    share = np.maximum(held, DENOMINATOR_FLOOR)[:, None]
    means = sums / share
    spread = np.maximum(squares - 2 * means * sums + means**2 * held[:, None], 0.0)
    variances = (VARIANCE_PRIOR + spread) / share
    totals = pairs.sum(axis=1, keepdims=True)
    transitions = np.where(totals > 0, pairs / np.where(totals > 0, totals, 1.0), 1.0 / k)
    return HmmParameters(start / start.sum(), transitions, means, variances), evidence


def initial_parameters(df: DataFrame, vector: str, states: int, seed: int) -> HmmParameters:
    """Cluster centres as means, the overall variance for every state, uniform probabilities."""
    fit = kmeans_fit(df, vector, states, seed, restarts=1)
    centers = np.array([np.asarray(c) for c in fit.model.clusterCenters()])
    if len(centers) < states:
        raise ValueError(f"only {len(centers)} distinct starting points for {states} states")
    spread = (
        df.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.var_samp(F.col("x").cast("double")).alias("v"))
    )
    variance = np.array([r["v"] or 0.0 for r in spread.orderBy("i").collect()]) + START_VARIANCE
    return HmmParameters(
        np.full(states, 1.0 / states), np.full((states, states), 1.0 / states), centers, np.tile(variance, (states, 1))
    )


def _fit_arranged(blocks: DataFrame, states: int, seed: int, iterations: int, tolerance: float) -> HmmFit:
    parameters = initial_parameters(blocks, "_x", states, seed)
    dimensions = parameters.means.shape[1]
    long_series = _is_long(blocks)
    previous = -math.inf
    done = 0
    for done in range(1, iterations + 1):
        parameters, evidence = _maximise(_expectation(blocks, parameters, long_series), states, dimensions)
        if evidence - previous < tolerance:
            break
        previous = evidence
    return HmmFit(parameters, log_likelihood(blocks, parameters, long_series), iterations=done)


def hmm_fit(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    states: int,
    seed: int = 42,
    iterations: int = 300,
    tolerance: float = 1e-2,
    block_rows: int = HMM_BLOCK_ROWS,
) -> HmmFit:
    """Expectation-maximisation; only the fixed-size sums of a pass reach the driver."""
    with arranged(df, keys, position, vector, block_rows) as blocks:
        return _fit_arranged(blocks, states, seed, iterations, tolerance)


def hmm_select_states(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    candidates: Iterable[int],
    seed: int = 42,
    iterations: int = 300,
    tolerance: float = 1e-2,
    block_rows: int = HMM_BLOCK_ROWS,
) -> HmmFit | None:
    """The candidate with the smallest BIC. A candidate that cannot be started is skipped."""
    best, scores = None, {}
    with arranged(df, keys, position, vector, block_rows) as blocks:
        rows = blocks.count()
        for states in candidate_states(candidates):
            try:
                fit = _fit_arranged(blocks, states, seed, iterations, tolerance)
            except ValueError:
                continue
            fit.bic = hmm_bic(fit.log_likelihood, states, fit.parameters.means.shape[1], rows)
            scores[states] = fit.bic
            if best is None or fit.bic < best.bic:
                best = fit
    if best is not None:
        best.bic_by_states = scores
    return best


def hmm_decode(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    parameters: HmmParameters,
    name: str = "state",
    block_rows: int = HMM_BLOCK_ROWS,
    causal: bool = False,
) -> DataFrame:
    """Adds the most likely state path of each series.

    With ``causal`` each row gets the state in which the best path up to it ends, which later rows do not change; this is
    what a stream can promise.
    """
    blocks = arrange_blocks(df, keys, position, vector, block_rows)
    k = parameters.states

    def walk(tables, starts_series, edge):
        scores = [np.zeros(k) if edge is None else np.asarray(edge["_scores"])]
        for n, t in enumerate(tables):
            starting = starts_series and n == 0
            scores.append(t[0] if starting else (scores[-1][:, None] + t).max(axis=0))
        leave = [int(scores[-1].argmax()) if edge is None else int(edge["_leave"])]
        for n in range(len(tables) - 1, 0, -1):
            leave.append(int((scores[n] + tables[n][:, leave[-1]]).argmax()))
        leave = leave[::-1]
        entry = 0 if edge is None else int(edge["_entry"])
        return {"_scores": scores[:-1], "_entry": [entry, *leave[:-1]], "_leave": leave}

    edges = _resolve(
        _block_tables(blocks, parameters, _best_table), k, _best_product, walk,
        "_scores array<double>, _entry int, _leave int", _is_long(df, position, block_rows),
    )

    def finish(rows: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or edge.empty:
            return pd.DataFrame({"_series": [], "_p": [], name: []})
        ordered, x = _matrix(rows)
        log_b, first = emissions(x, parameters), int(edge[BLOCK].iloc[0]) == 0
        if causal:
            path, _ = causal_path(log_b, None if first else np.asarray(edge["_scores"].iloc[0]), parameters)
        else:
            path = _best_path(log_b, first, int(edge["_entry"].iloc[0]), int(edge["_leave"].iloc[0]), parameters)
        return pd.DataFrame({"_series": ordered["_series"], "_p": ordered["_p"], name: path})

    paths = (
        blocks.groupBy("_series", BLOCK)
        .cogroup(edges.groupBy("_series", BLOCK))
        .applyInPandas(finish, f"_series string, _p long, {name} int")
    )
    series = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in keys]) if keys else F.lit("")
    tagged = df.withColumns({"_series": series, "_p": F.col(position)})
    return tagged.join(paths, ["_series", "_p"]).select(*df.columns, name)


def hmm_seed_stability(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    states: int,
    seeds: Iterable[int],
    iterations: int = 300,
    tolerance: float = 1e-2,
    block_rows: int = HMM_BLOCK_ROWS,
) -> DataFrame | None:
    """``seed_a, seed_b, ari, states_a, states_b`` for every pair of seeds; None with fewer than two fits."""
    fits = {}
    with arranged(df, keys, position, vector, block_rows) as blocks:
        for seed in sorted({int(s) for s in seeds}):
            try:
                fits[seed] = _fit_arranged(blocks, states, seed, iterations, tolerance).parameters
            except ValueError:
                continue
    if len(fits) < 2:
        return None
    # Every seed is decoded from the base rows and written, so the work grows with the number of seeds.
    base, labelled = df.select(*keys, position, vector), None
    for seed, parameters in fits.items():
        one = hmm_decode(base, keys, position, vector, parameters, f"seed_{seed}", block_rows)
        one = stage(one.select(*keys, position, f"seed_{seed}"), "seed")
        labelled = one if labelled is None else labelled.join(one, [*keys, position])
    labelled = stage(labelled.select(*[f"seed_{s}" for s in fits]), "seeds")
    used = {s: labelled.agg(F.count_distinct(f"seed_{s}").alias("n")) for s in fits}
    pairs = None
    for a, b in combinations(sorted(fits), 2):
        row = adjusted_rand(labelled, f"seed_{a}", f"seed_{b}").select(
            F.lit(a).alias("seed_a"),
            F.lit(b).alias("seed_b"),
            "ari",
            used[a].scalar().alias("states_a"),
            used[b].scalar().alias("states_b"),
        )
        pairs = row if pairs is None else pairs.unionByName(row)
    return pairs


def stability_summary(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.avg("ari").alias("ari_mean"), F.min("ari").alias("ari_min"))
