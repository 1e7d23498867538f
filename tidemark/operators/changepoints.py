"""Change points under a Gaussian-kernel cost with a penalty per break.

``changepoints`` compares the rows that are searched together pair by pair, ``landmark_changepoints`` compares rows with landmarks and
searches series of any length in linear work.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import BLOCK, block_of
from tidemark.session import stage

OVERLAP_ROWS = 128
TILE_ROWS = 512  # rows of a series that are compared with as many others at a time for its bandwidth
DIGIT_BITS = 16  # a distance is found by so many of its bits at a time
# Candidate breaks lie on multiples of this step and segments have at least this many rows.
STEP, SHORTEST = 5, 2
# Limits of the scaled squared distance inside the kernel.
NEAREST, FARTHEST = 1e-2, 1e2


def _distances(x: np.ndarray, y: np.ndarray | None = None) -> np.ndarray:
    y = x if y is None else y
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * x @ y.T, 0.0)


def bandwidth(x: np.ndarray) -> float:
    """The median squared distance of two rows."""
    upper = _distances(x)[np.triu_indices(len(x), 1)]
    return float(np.median(upper)) if len(upper) else 0.0


def _kernel(x: np.ndarray, middle: float | None = None) -> np.ndarray:
    """exp(-d) of squared distances scaled by ``middle``, by default their median."""
    d = _distances(x)
    middle = bandwidth(x) if middle is None else middle
    if middle != 0:
        d = d / middle
    kernel = np.exp(-np.clip(d, NEAREST, FARTHEST))
    np.fill_diagonal(kernel, 1.0)
    return kernel


def find_breaks(x: np.ndarray, penalty: float, middle: float | None = None) -> list[int]:
    """Optimal break positions of the rows given, by pruned dynamic programming."""
    n = len(x)
    if n < 2 * SHORTEST:
        return []
    kernel = _kernel(x, middle)
    area = np.zeros((n + 1, n + 1))
    area[1:, 1:] = kernel.cumsum(axis=0).cumsum(axis=1)
    trace = np.concatenate([[0.0], np.diag(kernel).cumsum()])

    def cost(a: np.ndarray, b: int) -> np.ndarray:
        inside = area[b, b] - area[a, b] - area[b, a] + area[a, a]
        return trace[b] - trace[a] - inside / (b - a)

    ends = [e for e in range(0, n, STEP) if e >= SHORTEST] + [n]
    best, previous = {0: 0.0}, {}
    open_starts: list[int] = []
    for end in ends:
        fresh = (end - SHORTEST) // STEP * STEP
        if fresh in best:
            open_starts.append(fresh)
        starts = np.array(open_starts)
        totals = np.array([best[s] for s in open_starts]) + cost(starts, end) + penalty
        pick = int(totals.argmin())
        best[end], previous[end] = float(totals[pick]), open_starts[pick]
        open_starts = [s for s, t in zip(open_starts, totals) if t <= best[end] + penalty]
    breaks, at = [], n
    while at > 0:
        at = previous[at]
        if at > 0:
            breaks.append(at)
    return sorted(breaks)


def _tiles(rows: DataFrame, keys: Sequence[str], top: DataFrame) -> DataFrame:
    """``rows`` in tiles (_a, _b): every two blocks of ``TILE_ROWS`` rows of a series meet in one, a block meets itself."""
    block = block_of(F.col("_p"), TILE_ROWS)
    placed = (rows.join(top, list(keys)) if keys else rows.crossJoin(F.broadcast(top))).withColumn("_own", block)
    others = F.explode(F.sequence(F.lit(0).cast("long"), block_of(F.col("_top"), TILE_ROWS))).alias("_other")
    met = placed.select(*keys, "_p", "_x", "_own", others)
    return met.select(*keys, "_p", "_x", F.least("_own", "_other").alias("_a"), F.greatest("_own", "_other").alias("_b"), (F.col("_own") > F.col("_other")).alias("_second"))


def exact_bandwidths(rows: DataFrame, keys: Sequence[str], top: DataFrame) -> DataFrame:
    """``keys, _middle``: the median squared distance of two rows of each series, over all its pairs.

    Only counts leave the tiles. Distances of at least 0 are in the order of their bits, so the two middle ones are found by ``DIGIT_BITS``
    bits at a time, from counts of the distances that agree in the bits before. A series of one row has 0.
    """
    kinds = "".join(f"`{k}` {rows.schema[k].dataType.simpleString()}, " for k in keys)
    n = F.col("_top").cast("long") + 1
    # _rank: how many of the distances with the bits found so far lie before the one wanted
    ranks = ("((_top + 1) * _top div 2 - 1) div 2", "(_top + 1) * _top div 2 div 2")
    both = F.explode(F.array(*(F.struct(F.lit(i).alias("which"), F.expr(r).alias("rank")) for i, r in enumerate(ranks))))
    found = top.where(n > 1).select(*keys, both.alias("_w"))
    found = found.select(*keys, F.col("_w.which").alias("_which"), F.col("_w.rank").cast("long").alias("_rank"), F.lit(0).cast("long").alias("_bits"))
    tiles = _tiles(rows, keys, top)
    digits = 1 << DIGIT_BITS
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        above = found.groupBy(*keys).pivot("_which", [0, 1]).agg(F.first("_bits")).withColumnsRenamed({"0": "_low", "1": "_high"})

        def count(pdf: pd.DataFrame) -> pd.DataFrame:
            second = pdf["_second"].to_numpy()
            ordered = [pdf[second == side].sort_values("_p") for side in (False, True)]
            x, y = (np.stack(o["_x"].to_numpy()) if len(o) else None for o in ordered)
            d = _distances(x)[np.triu_indices(len(x), 1)] if y is None else _distances(x, y).ravel()
            bits = np.abs(d).view(np.int64) >> shift  # read while this pass is staged
            out = []
            for which, c in enumerate(("_low", "_high")):
                mine = bits[bits >> DIGIT_BITS == int(pdf[c].iloc[0])]
                digit, number = np.unique(mine & (digits - 1), return_counts=True)
                out.append(pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "_which": which, "_digit": digit, "_n": number}, index=range(len(digit))))
            return pd.concat(out)

        with_bits = tiles.join(F.broadcast(above), list(keys)) if keys else tiles.crossJoin(F.broadcast(above))
        counts = with_bits.groupBy(*keys, "_a", "_b").applyInPandas(count, f"{kinds}_which int, _digit long, _n long")
        counts = counts.groupBy(*keys, "_which", "_digit").agg(F.sum("_n").alias("_n"))
        up_to = Window.partitionBy(*keys, "_which").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_sum", F.sum("_n").over(up_to)).join(found, [*keys, "_which"])
        counts = counts.where((F.col("_sum") > F.col("_rank")) & (F.col("_sum") - F.col("_n") <= F.col("_rank")))
        found = stage(counts.select(*keys, "_which", (F.col("_rank") - F.col("_sum") + F.col("_n")).alias("_rank"), (F.col("_bits") * digits + F.col("_digit")).alias("_bits")), "bandwidth")

    def middle(pdf: pd.DataFrame) -> pd.DataFrame:
        value = float(pdf["_bits"].to_numpy(np.int64).view(np.float64).mean())
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "_middle": [value]})

    middles = found.groupBy(*keys).applyInPandas(middle, f"{kinds}_middle double")
    return middles.unionByName(top.where(n == 1).select(*keys, F.lit(0.0).alias("_middle")))


def changepoints(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    penalty: float = 8.0,
    segment_rows: int | None = None,
    overlap: int = OVERLAP_ROWS,
    bandwidth: float | None = None,
) -> DataFrame:
    """``keys, boundary``: change points per series. ``position`` counts from 0 without gaps.

    The kernel cost compares every two rows that are searched together, so memory and work of a search are quadratic. The
    caller says what is searched together, and it does not depend on the data:

    * ``segment_rows=None``: whole series, each in one task; the exact optimum.
    * ``segment_rows=n``: every ``n`` rows, a multiple of ``STEP``, with ``overlap`` rows of context (rounded up to a multiple of
      ``STEP``) on both sides; a segment reports the breaks in its own rows. Candidates lie on the same lattice of the series
      as in a whole search, and all segments of a series share one bandwidth, the median over all pairs of its rows as in a whole search.

    A ``bandwidth`` given is used for all series, and no pairs are compared to find one. ``landmark_changepoints`` searches series of any length.
    """
    p = F.col(position)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds + ', ' if kinds else ''}boundary long"
    rows = df.select(*keys, p.cast("long").alias("_p"), F.col(vector).cast("array<double>").alias("_x"))

    def table(ordered: pd.DataFrame, found: list[int]) -> pd.DataFrame:
        return pd.DataFrame({**{k: ordered[k].iloc[0] for k in keys}, "boundary": found}, index=range(len(found)))

    if segment_rows is None:

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            ordered = pdf.sort_values("_p")
            base = int(ordered["_p"].iloc[0])
            return table(ordered, [base + b for b in find_breaks(np.stack(ordered["_x"].to_numpy()), penalty, bandwidth)])

        return rows.groupBy(*keys).applyInPandas(whole, schema)
    if segment_rows <= 0 or segment_rows % STEP:
        raise ValueError(f"segment_rows must be a multiple of {STEP}")
    overlap = -(-overlap // STEP) * STEP
    last_position = F.max("_p").alias("_top")
    top = stage(rows.groupBy(*keys).agg(last_position) if keys else rows.agg(last_position), "tops")
    middles = stage(exact_bandwidths(rows, keys, top), "bandwidths") if bandwidth is None else top.select(*keys, F.lit(float(bandwidth)).alias("_middle"))
    first = block_of(F.greatest(F.col("_p") - overlap, F.lit(0)), segment_rows)
    last = block_of(F.col("_p") + overlap, segment_rows)
    copies = rows.withColumn(BLOCK, F.explode(F.sequence(first, last)))
    # A copy ahead of the end of a series opens no segment of its own.
    real = top.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), block_of(F.col("_top"), segment_rows))).alias(BLOCK))
    real = real.join(middles, keys) if keys else real.crossJoin(middles)
    copies = copies.join(real, [*keys, BLOCK])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("_p")
        block, base = int(ordered[BLOCK].iloc[0]), int(ordered["_p"].iloc[0])
        found = find_breaks(np.stack(ordered["_x"].to_numpy()), penalty, float(ordered["_middle"].iloc[0]))
        return table(ordered, [base + b for b in found if (base + b) // segment_rows == block])

    return copies.groupBy(*keys, BLOCK).applyInPandas(search, schema)


# ---- landmarks: linear in the rows of a series ------------------------------------------------

LANDMARKS = 64  # rows that the others are compared with
SAMPLE_ROWS = 512  # rows of a series from which bandwidth and landmarks are taken
SAMPLE_SALTS = 16
PATIENCE_ROWS = 4_096  # after so many rows a start must have shown that a break there is worth half its penalty
LATTICE_ROWS = 16_000  # rows of a block; a multiple of STEP
RUN_BLOCKS = 16  # blocks of a series that one task searches at a time


def _landmarks(x: np.ndarray, n: int, middle: float | None) -> tuple[np.ndarray, np.ndarray, float]:
    """Landmarks among the rows of a sample, what makes features of kernels with them, and the bandwidth.

    Each landmark is the row farthest from those before it, so that regimes of few rows are covered too.
    """
    middle = bandwidth(x) if middle is None else middle
    near, chosen = np.full(len(x), np.inf), [0]
    while len(chosen) < min(n, len(x)):
        near = np.minimum(near, _distances(x[chosen[-1:]], x)[0])
        if near.max() <= 1e-12 * max(middle, 1e-300):
            break
        chosen.append(int(near.argmax()))
    marks = x[chosen]
    values, vectors = np.linalg.eigh(np.exp(-_distances(marks) / (middle or 1.0)))
    used = values > 1e-10 * values[-1]
    return marks, vectors[:, used] / np.sqrt(values[used]), middle


def _features(x: np.ndarray, marks: np.ndarray, turn: np.ndarray, middle: float) -> np.ndarray:
    return np.exp(-_distances(x, marks) / (middle or 1.0)) @ turn


class _Search:
    """The penalised search over a series, fed with sums of features at its lattice points and its end.

    ``starts, best, sums`` are the open starts: their positions, the least cost up to them and their sums, relative to the
    last lattice point. ``previous`` leads back from them as far as their paths differ.
    """

    def __init__(self, width: int, penalty: float, patience: int):
        self.penalty, self.patience = penalty, patience
        self.starts, self.best, self.sums = np.zeros(0, np.int64), np.zeros(0), np.zeros((0, width))
        self.previous: dict[int, int] = {}
        # the last lattice point reached: position, cost up to it, sums since the origin of ``sums``
        self.at, self.cost, self.total = 0, 0.0, np.zeros(width)

    def step(self, end: int, added: np.ndarray) -> None:
        """Go on to ``end``, ``added`` being the sums of the rows since the last point."""
        total = self.total + added
        if end - self.at >= SHORTEST and (not len(self.starts) or self.starts[-1] != self.at):
            self.starts, self.best, self.sums = np.append(self.starts, self.at), np.append(self.best, self.cost), np.vstack([self.sums, self.total])
        if not len(self.starts):  # fewer rows than a segment has
            self.total = total
            return
        rows = end - self.starts
        apart = total - self.sums
        totals = self.best + rows - np.einsum("ij,ij->i", apart, apart) / rows + self.penalty
        pick = int(totals.argmin())
        self.cost, self.total, self.at = float(totals[pick]), total, end
        self.previous[end] = int(self.starts[pick])
        # A start that cannot win any more, or that has had time to show a gain and has shown too little.
        kept = (totals <= self.cost + self.penalty) & ((rows <= self.patience) | (totals <= self.cost + self.penalty / 2))
        self.starts, self.best, self.sums = self.starts[kept], self.best[kept], self.sums[kept]

    def settled(self, end: bool = False) -> list[int]:
        """Breaks that all open paths share, or at the ``end`` the breaks of the best one; they are forgotten."""
        tops = [-self.at] if end else [-p for p in {self.at, *self.starts.tolist()}]
        heapq.heapify(tops)
        paths = {}
        while len(tops) > 1:  # the latest point steps back, until one is left
            p = -heapq.heappop(tops)
            if -p in tops:
                continue
            if p not in self.previous:  # the origin of what is remembered
                heapq.heappush(tops, -p)
                break
            paths[p] = self.previous[p]
            if -paths[p] not in tops:
                heapq.heappush(tops, -paths[p])
        common = -max(tops) if tops else 0
        found, at = [], common if not end else self.previous.get(self.at, 0)
        while at in self.previous:
            found.append(at)
            at = self.previous[at]
        self.previous = paths
        return sorted(b for b in found if b > 0)

    def pack(self) -> bytes:
        out = io.BytesIO()
        pointers = np.array(sorted(self.previous.items()), np.int64).reshape(-1, 2)
        # sums are kept relative to the last point, so that they stay small in series of any length
        np.savez(out, starts=self.starts, best=self.best - self.cost, sums=self.sums - self.total, pointers=pointers, at=self.at)
        return out.getvalue()

    @classmethod
    def unpack(cls, packed: bytes, penalty: float, patience: int) -> _Search:
        with np.load(io.BytesIO(packed)) as held:
            search = cls(held["sums"].shape[1], penalty, patience)
            search.starts, search.best, search.sums = held["starts"], held["best"], held["sums"]
            search.previous = {int(p): int(q) for p, q in held["pointers"]}
            search.at = int(held["at"])
        return search


def landmark_changepoints(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    vector: str,
    penalty: float = 8.0,
    *,
    bandwidth: float | None = None,
    landmarks: int = LANDMARKS,
    sample_rows: int = SAMPLE_ROWS,
    patience: int = PATIENCE_ROWS,
    block_rows: int = LATTICE_ROWS,
    run_blocks: int = RUN_BLOCKS,
) -> DataFrame:
    """``keys, boundary``: change points per series, in work linear in its rows. ``position`` counts from 0 without gaps.

    The Gaussian kernel is taken through ``landmarks`` of the series (Nystroem features), so that the cost of a segment comes from two
    sums of features instead of its pairs of rows. Landmarks and, unless given, the ``bandwidth`` (the median squared distance) come from a sample of
    ``sample_rows`` rows, chosen by a hash of the position. A series of at most that many rows and landmarks has the exact kernel and, while it has at
    most ``patience`` rows, the exact optimum; else a start of a segment is given up when ``patience`` rows after it show a gain of less
    than half the penalty. All rows are searched, in blocks: their sums are made in parallel, then the search goes through the blocks of all
    series, ``run_blocks`` at a time, and hands its open starts from run to run. Neither changes the result. Without rows the result is empty.
    """
    if block_rows <= 0 or block_rows % STEP:
        raise ValueError(f"block_rows must be a multiple of {STEP}")
    own = list(keys) or ["_series"]
    p = F.col(position).cast("long").alias("_p")
    rows = df.select(*([F.col(k) for k in keys] or [F.lit(0).alias("_series")]), p, F.col(vector).cast("array<double>").alias("_x"))
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in own)
    names = {k: k for k in own}
    hashed = F.xxhash64("_p")
    sample = rows
    for salt in (F.pmod(F.xxhash64("_p"), F.lit(SAMPLE_SALTS)), F.lit(0)):
        by = Window.partitionBy(*own, salt).orderBy(hashed, "_p")
        sample = sample.withColumn("_place", F.row_number().over(by)).where(F.col("_place") <= sample_rows).drop("_place")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf.sort_values("_p")["_x"].to_numpy())
        marks, turn, middle = _landmarks(x, landmarks, bandwidth)
        packed = io.BytesIO()
        np.savez(packed, marks=marks, turn=turn, middle=middle)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in names}, "_map": [packed.getvalue()]})

    maps = stage(sample.groupBy(*own).applyInPandas(choose, f"{kinds}, _map binary"), "landmark-maps")
    placed = rows.withColumn(BLOCK, block_of(F.col("_p"), block_rows))
    sizes = stage(placed.groupBy(*own, BLOCK).agg(F.count("*").alias("_n")), "landmark-blocks")

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Sums of features from each lattice point to the next, the last of them possibly shorter."""
        ordered = left.sort_values("_p")
        with np.load(io.BytesIO(right["_map"].iloc[0])) as held:
            found = _features(np.stack(ordered["_x"].to_numpy()), held["marks"], held["turn"], float(held["middle"]))
        added = np.add.reduceat(found, np.arange(0, len(found), STEP), axis=0)
        return pd.DataFrame({**{k: [left[k].iloc[0]] for k in names}, BLOCK: [left[BLOCK].iloc[0]], "_n": [len(found)], "_sums": [added.tobytes()]})

    with_maps = sizes.select(*own, BLOCK).join(maps, own)  # a copy of its map for each block of a series
    lattice = placed.groupBy(*own, BLOCK).cogroup(with_maps.groupBy(*own, BLOCK)).applyInPandas(sums, f"{kinds}, {BLOCK} long, _n long, _sums binary")
    last = sizes.groupBy(*own).agg(F.max(BLOCK).alias("_last"))
    lattice = stage(lattice.join(last, own).withColumn("_run", F.floor(F.col(BLOCK) / run_blocks).cast("long")), "landmark-sums")
    runs = lattice.agg(F.max("_run")).first()[0]
    none = df.sparkSession.createDataFrame([], f"{kinds}, _state binary")
    states, found = none, None

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):  # the series has ended
            return pd.DataFrame({**{k: [] for k in names}, "boundary": [], "_state": []})
        state = _Search.unpack(right["_state"].iloc[0], penalty, patience) if len(right) else None
        breaks: list[int] = []
        ordered = left.sort_values(BLOCK)
        for block, n, packed in zip(ordered[BLOCK], ordered["_n"], ordered["_sums"], strict=True):
            points = -(-n // STEP)
            added = np.frombuffer(packed).reshape(points, -1)
            state = state or _Search(added.shape[1], penalty, patience)
            for i in range(points):
                end = int(block) * block_rows + min((i + 1) * STEP, int(n))
                state.step(end, added[i])
        done = int(ordered[BLOCK].iloc[-1]) == int(ordered["_last"].iloc[0])
        breaks += state.settled(done)
        out = {**{k: left[k].iloc[0] for k in names}, "boundary": [*breaks, None], "_state": [*[None] * len(breaks), None if done else state.pack()]}
        return pd.DataFrame(out).astype({"boundary": "Int64"})

    for run in range(0 if runs is None else int(runs) + 1):
        met = lattice.where(F.col("_run") == run).groupBy(*own).cogroup(states.groupBy(*own))
        step = stage(met.applyInPandas(search, f"{kinds}, boundary long, _state binary"), "landmark-run")
        states = step.where("_state IS NOT NULL").select(*own, "_state")
        here = step.where("boundary IS NOT NULL").select(*keys, "boundary")
        found = here if found is None else found.unionByName(here)
    return found if found is not None else none.select(*keys, F.lit(None).cast("long").alias("boundary"))
