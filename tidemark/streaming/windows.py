"""Readings to scored windows as a stream.

Two queries, joined by a folder. The first closes bins: a windowed aggregation that combines before its shuffle, so a
busy station's readings are spread over all tasks. The second keeps a bounded state per station (rows whose fill is
still open, the tail of filled rows that later windows need, the decoder's scores) and emits windows as rows settle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.scalars import sentinel_to_null
from tidemark.functions.times import is_zoneless, width_micros
from tidemark.operators.hmm import HmmParameters, causal_path, emissions
from tidemark.operators.windows import META, STATS, clean_scales, feature_names
from tidemark.params import Params
from tidemark.plans.scoring import score_states, score_vectors
from tidemark.sources.model_store import LATENT_MODE, StoredModels
from tidemark.sources.readers import align_schema, ingest_clean, normalize_headers
from tidemark.streaming.live import stream_resample

# Grid rows of a station that are turned into windows at a time.
SLICE_ROWS = 4_096
NEVER, UNSEEN = -(2**60), 2**60
STATE = (
    "first long, base long, raw array<double>, known_at array<long>, known array<double>, "
    "rows long, tail array<double>, tail_times array<long>, scores array<double>"
)


@dataclass(frozen=True)
class Layout:
    """What a task needs to know; its size depends on the number of columns only."""

    step: int
    numeric: tuple[str, ...]
    directional: tuple[str, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    small: int
    medium: int
    drop_gaps: bool
    scales: tuple[int, ...]
    stride: int
    stats: tuple[str, ...]
    patience: int

    @property
    def parts(self) -> list[str]:
        """Filled quantities: numeric columns, then the two sides of every angle."""
        return [*self.numeric, *[f"{c}__{side}" for c in self.directional for side in ("sin", "cos")]]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *[f"{c}_SIN" for c in self.directional], *[f"{c}_COS" for c in self.directional]]

    @property
    def window_features(self) -> list[str]:
        return feature_names(self.features, self.scales, self.stats)


@dataclass
class Scorer:
    """The sequence model with the scaling, and the projection if windows are embedded, of its input."""

    columns: list[int]
    mean: np.ndarray
    scale: np.ndarray
    hmm: HmmParameters
    centre: np.ndarray | None = None
    components: np.ndarray | None = None

    def vectors(self, windows: np.ndarray) -> np.ndarray:
        x = (windows[:, self.columns] - self.mean) / self.scale
        return x if self.components is None else (x - self.centre) @ self.components.T


@dataclass
class Series:
    """The state of one station.

    ``raw`` are grid rows from position ``base`` on whose fill is open; ``known`` and ``known_at`` the last known value
    of each part before them; ``tail`` the last settled feature rows, of which the last has index ``rows - 1``.
    """

    first: int
    base: int
    raw: np.ndarray
    known_at: np.ndarray
    known: np.ndarray
    rows: int
    tail: np.ndarray
    tail_times: np.ndarray
    scores: np.ndarray | None = field(default=None)

    @classmethod
    def new(cls, first: int, layout: Layout) -> "Series":
        parts, features = len(layout.parts), len(layout.features)
        return cls(
            first, 0, np.empty((0, parts)), np.full(parts, NEVER), np.full(parts, np.nan), 0,
            np.empty((0, features)), np.empty(0, dtype=np.int64),
        )

    @classmethod
    def load(cls, value: tuple, layout: Layout) -> "Series":
        first, base, raw, known_at, known, rows, tail, times, scores = value
        return cls(
            int(first), int(base), np.array(raw, dtype=float).reshape(-1, len(layout.parts)), np.array(known_at, dtype=np.int64),
            np.array(known, dtype=float), int(rows), np.array(tail, dtype=float).reshape(-1, len(layout.features)),
            np.array(times, dtype=np.int64), np.array(scores, dtype=float) if len(scores) else None,
        )

    def dump(self) -> tuple:
        return (
            self.first, self.base, self.raw.ravel().tolist(), self.known_at.tolist(), self.known.tolist(), self.rows,
            self.tail.ravel().tolist(), self.tail_times.tolist(), [] if self.scores is None else self.scores.tolist(),
        )

    @property
    def seen(self) -> int:
        """Position of the last row that has come in."""
        return self.base + len(self.raw) - 1

    def settle(self, layout: Layout, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Takes out the leading rows whose fill cannot change any more: filled parts and positions.

        The closed form of the batch fill. A gap of more than ``patience`` rows counts as one without an end.
        """
        n, small, reach = len(self.raw), layout.small, layout.small + layout.medium
        if not n:
            return self.raw, np.empty(0, dtype=np.int64)
        i = self.base + np.arange(n)[:, None]
        known = ~np.isnan(self.raw)
        before = np.maximum.accumulate(np.vstack([self.known_at, np.where(known, i, NEVER)]))[1:]
        after = np.minimum.accumulate(np.where(known, i, UNSEEN)[::-1])[::-1]
        here = np.take_along_axis(self.raw, np.maximum(before - self.base, 0), 0)
        left = np.where(before >= self.base, here, self.known)
        right = np.take_along_axis(self.raw, np.minimum(after - self.base, n - 1), 0)
        recent, ended = i - before <= reach, (after != UNSEEN) & (after - before <= layout.patience)
        span = np.where(ended & (after - before > 2 * small), after - before - 2 * small, 1)
        line = left + (right - left) / span * (i - before - small)
        filled = np.select(
            [known, i - before <= small, after - i <= small, ~recent, ~ended], [self.raw, left, right, np.nan, left], line
        )
        done = known | (i - before <= small) | (after != UNSEEN) | last
        done |= np.where(recent, self.seen - before >= layout.patience, i + small <= self.seen)
        whole = done.all(axis=1)
        count = n if whole.all() else int(whole.argmin())
        if count:
            self.known_at, self.known = before[count - 1], left[count - 1]
            self.raw, self.base = self.raw[count:], self.base + count
        return filled[:count], i[:count, 0]

    def windows(self, filled: np.ndarray, positions: np.ndarray, layout: Layout) -> dict | None:
        """Windows that end in the settled rows, as columns; the rows join the tail."""
        n = len(layout.numeric)
        angles = np.degrees(np.arctan2(filled[:, n::2], filled[:, n + 1::2])) + 360.0
        angles = np.radians(angles % 360.0)
        fresh = np.hstack([np.clip(filled[:, :n], layout.low, layout.high), np.sin(angles), np.cos(angles)])
        times = self.first + positions * layout.step
        if layout.drop_gaps:
            whole = ~np.isnan(fresh).any(axis=1)
            fresh, times = fresh[whole], times[whole]
        held, held_times = np.vstack([self.tail, fresh]), np.concatenate([self.tail_times, times])
        first, size = self.rows - len(self.tail), layout.scales[-1]
        ends = np.arange(self.rows, self.rows + len(fresh))
        ends = ends[(ends >= size - 1) & ((ends - (size - 1)) % layout.stride == 0)]
        keep = max(len(held) - (size - 1), 0)
        self.rows, self.tail, self.tail_times = self.rows + len(fresh), held[keep:], held_times[keep:]
        if not len(ends):
            return None
        at, values = ends - first, []
        for scale in layout.scales:
            rows = np.lib.stride_tricks.sliding_window_view(held, scale, axis=0)[at - scale + 1]
            forms = {
                "mean": lambda r: r.mean(axis=2),
                "std": lambda r: r.std(axis=2),
                "trend": lambda r: r[:, :, -1] - r[:, :, 0],
                "energy": lambda r: (r * r).mean(axis=2),
                "max": lambda r: r.max(axis=2),
                "min": lambda r: r.min(axis=2),
            }
            values += [forms[stat](rows) for stat in STATS if stat in layout.stats]
        features = np.hstack(values)
        return {
            "start_idx": ends - (size - 1), "end_idx": ends, "start_time": held_times[at - (size - 1)], "end_time": held_times[at],
            "features": np.where(np.isnan(features), 0.0, features),
        }

    def advance(self, micros: np.ndarray, values: np.ndarray, layout: Layout, last: bool = False) -> Iterator[dict]:
        """Takes in bins (ascending, all after ``seen``) slice by slice and gives the windows of each slice."""
        positions = (micros - self.first) // layout.step
        end = int(positions[-1]) if len(positions) else self.seen
        while True:
            low, high = self.seen + 1, min(self.seen + SLICE_ROWS, end)
            a, b = np.searchsorted(positions, [low, high + 1])
            rows = np.full((max(high + 1 - low, 0), len(layout.parts)), np.nan)
            rows[positions[a:b] - low] = values[a:b]
            self.raw = np.vstack([self.raw, rows])
            found = self.windows(*self.settle(layout, last and high >= end), layout)
            if found is not None:
                yield found
            if high >= end:
                return


def layout_of(params: Params, numeric: Sequence[str], directional: Sequence[str], bounds: DataFrame | None, patience: int) -> Layout:
    """The settings of a run as one small object; ``bounds`` has one row per numeric column."""
    q, w = params.quality, params.windows
    if patience < 2 * q.small_gap + q.medium_gap:
        raise ValueError("patience must cover the fill limits on both sides of a gap")
    scales = clean_scales(w.scales if w.multiscale else [w.size])
    if not scales:
        raise ValueError("at least one positive window size is needed")
    stats = STATS if w.multiscale else tuple(s for s in STATS if s in w.stats) or STATS
    clip = {r["column"]: (r["clip_low"], r["clip_high"]) for r in bounds.collect()} if bounds is not None else {}

    def side(which: int, open_end: float) -> tuple[float, ...]:
        values = [clip.get(c, (None, None))[which] for c in numeric]
        return tuple(open_end if v is None else float(v) for v in values)

    return Layout(
        width_micros(params.columns.width), tuple(numeric), tuple(directional), side(0, -np.inf), side(1, np.inf), q.small_gap,
        q.medium_gap, q.drop_large_gap_rows, tuple(scales), w.stride if w.multiscale else w.step, stats, patience,
    )


def scorer_of(models: StoredModels, layout: Layout) -> Scorer:
    """The stored scaler holds one row per feature, so collecting it is bounded."""
    scaling = {r["column"]: (r["mean"], r["scale"]) for r in models.scaler.collect()}
    names, have = models.settings["window_features"], layout.window_features
    mean, scale = (np.array([scaling[c][i] for c in names], dtype=float) for i in (0, 1))
    scorer = Scorer([have.index(c) for c in names], mean, scale, models.hmm)
    if models.mode == LATENT_MODE:
        scorer.centre, scorer.components = np.array(models.basis.mean), np.array(models.basis.components)
    return scorer


def stream_bins(raw: DataFrame, params: Params, numeric: Sequence[str], directional: Sequence[str], lateness: str) -> DataFrame:
    """A stream of readings in any accepted shape to closed bins.

    A reading that comes more than ``lateness`` behind the newest one no longer counts; Spark reports the number of
    such rows with each batch (``numRowsDroppedByWatermark``).
    """
    c, wanted = params.columns, [*numeric, *directional]
    named = align_schema(normalize_headers(raw, c.station, c.timestamp), wanted)
    rows = sentinel_to_null(ingest_clean(named, c.timestamp, c.station, wanted, check_rows=False), wanted, params.quality.sentinels)
    if is_zoneless(rows, c.timestamp):
        rows = rows.withColumn(c.timestamp, F.col(c.timestamp).cast("timestamp"))
    return stream_resample(rows, c.station, c.timestamp, numeric, directional, c.width, lateness)


def stream_windows(
    bins: DataFrame,
    params: Params,
    numeric: Sequence[str],
    directional: Sequence[str],
    bounds: DataFrame | None = None,
    models: StoredModels | None = None,
    patience: int = 168,
    idle: str = "30d",
) -> DataFrame:
    """Closed bins of a stream to windows, with states and, if embedded, the error where ``models`` are given.

    Rows are those of the batch plan over the same bins, as far as they are settled: a row is settled once its value is
    known, lies within a fill limit, or its gap has an end. A gap of more than ``patience`` rows counts as one without an
    end, which bounds the state to ``patience`` rows and the largest window. A station without a bin for ``idle`` of event
    time is closed: its open rows are settled as those of a series that ends, and its state is dropped; should it
    come back, it starts as a new series from index 0. Bins of a station must arrive by ascending time from batch to
    batch, as ``stream_bins`` writes them; one that comes after a later one is not used. NaN counts as missing.
    """
    c = params.columns
    layout = layout_of(params, numeric, directional, bounds, patience)
    scorer = scorer_of(models, layout) if models is not None else None
    idle_ms, step = width_micros(idle) // 1000, layout.step
    sides = [f(F.radians(d)).alias(f"{d}__{side}") for d in directional for side, f in (("sin", F.sin), ("cos", F.cos))]
    rows = bins.withWatermark(c.timestamp, "0 seconds").select(
        F.col(c.station).alias("station"), c.timestamp, F.unix_micros(c.timestamp).alias("_micros"),
        *[F.col(n).cast("double").alias(n) for n in numeric], *sides,
    )
    fields = [T.StructField("station", T.StringType()), T.StructField("window_scale", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in META[2:]]
    fields += [T.StructField(n, T.DoubleType()) for n in layout.window_features]
    fields += [T.StructField("micro_state", T.IntegerType())] if scorer else []

    def frame(station: str, series: Series, found: dict) -> pd.DataFrame:
        features = found.pop("features")
        out = pd.DataFrame({"station": station, "window_scale": layout.scales[-1], **found})
        out = pd.concat([out, pd.DataFrame(features, columns=layout.window_features)], axis=1)
        if scorer:
            path, series.scores = causal_path(emissions(scorer.vectors(features), scorer.hmm), series.scores, scorer.hmm)
            out["micro_state"] = path.astype(np.int32)
        return out

    def take(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        series = Series.load(state.get, layout) if state.exists else None
        if state.hasTimedOut:
            for found in series.advance(np.empty(0, dtype=np.int64), np.empty((0, len(layout.parts))), layout, last=True):
                yield frame(key[0], series, found)
            state.remove()
            return
        # Only closed bins come here, as plain numbers: one row per bin, however many readings it had.
        held = [(p["_micros"].to_numpy(), p[layout.parts].to_numpy(dtype=float)) for p in chunks]
        micros, order = np.unique(np.concatenate([m for m, _ in held]), return_index=True)
        values = np.concatenate([v for _, v in held])[order]
        if series is None:
            series = Series.new(int(micros[0]), layout)
        fresh = micros > series.first + series.seen * step
        if fresh.any():
            for found in series.advance(micros[fresh], values[fresh], layout):
                yield frame(key[0], series, found)
        state.update(series.dump())
        expiry = (series.first + (series.seen + 1) * step) // 1000 + idle_ms
        state.setTimeoutTimestamp(max(expiry, state.getCurrentWatermarkMs() + 1))

    found = rows.groupBy("station").applyInPandasWithState(
        take, T.StructType(fields), STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    found = found.withColumns({n: F.timestamp_micros(n) for n in ("start_time", "end_time")})
    if models is None:
        return found
    kept = found.columns
    scored, added = score_states(score_vectors(found, models)[0] if models.mode == LATENT_MODE else found, models)
    return scored.select(*kept, *[n for n in added if n not in kept])


def append_to(df: DataFrame, path: str, checkpoint: str, every: str | None) -> DataStreamWriter:
    """A Parquet sink that takes what has come in, or with ``every`` keeps running at that interval."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def score_stream(
    raw: DataFrame,
    params: Params,
    models: StoredModels,
    folder: str,
    lateness: str,
    patience: int = 168,
    idle: str = "30d",
) -> str:
    """Takes in all readings that have come since the last call, and appends scored windows; returns their path.

    ``folder`` must be shared by all executors. It holds closed bins, windows and the progress of both queries, so a
    call that fails is simply repeated. To keep both running, start ``stream_bins`` and ``stream_windows`` with
    ``append_to(..., every="1 minute")``.
    """
    numeric, directional = models.settings["numeric"], models.settings["directional"]
    bins = stream_bins(raw, params, numeric, directional, lateness)
    append_to(bins, f"{folder}/bins", f"{folder}/progress/bins", None).start().awaitTermination()
    closed = raw.sparkSession.readStream.schema(bins.schema).parquet(f"{folder}/bins")
    windows = stream_windows(closed, params, numeric, directional, models.bounds, models, patience, idle)
    append_to(windows, f"{folder}/windows", f"{folder}/progress/windows", None).start().awaitTermination()
    return f"{folder}/windows"
