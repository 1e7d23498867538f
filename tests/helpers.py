"""Plain-Python models of the operators, for comparison on small random data."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

START = dt.datetime(2023, 1, 1)


def hours(n: int) -> list[dt.datetime]:
    return [START + dt.timedelta(hours=i) for i in range(n)]


def fill(values: list[float | None], small: int, medium: int) -> list[float | None]:
    series = pd.Series(values, dtype=float)
    if small:
        series = series.ffill(limit=small).bfill(limit=small)
    if medium:
        series = series.interpolate(method="linear", limit=medium)
    return [None if np.isnan(v) else v for v in series]


def runs(labels: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, label) of each maximal run."""
    out = []
    for i, label in enumerate(labels):
        if out and out[-1][2] == label:
            out[-1] = (out[-1][0], i + 1, label)
        else:
            out.append((i, i + 1, label))
    return out


def smooth(labels: list[int], shortest: int) -> list[int]:
    out: list[int] = []
    found = runs(labels)
    for n, (start, end, label) in enumerate(found):
        if end - start < shortest:
            label = out[-1] if out else (found[1][2] if len(found) > 1 else label)
        out += [label] * (end - start)
    return out


def greedy_matches(truth: list[int], predicted: list[int], tolerance: int) -> int:
    free, matched = sorted(truth), 0
    for p in sorted(predicted):
        near = [t for t in free if abs(t - p) <= tolerance]
        if near:
            free.remove(near[0])
            matched += 1
    return matched


def window_row(values: np.ndarray, stat: str) -> float:
    if stat == "trend":
        value = values[-1] - values[0]
    else:
        value = {
            "mean": values.mean, "std": values.std, "max": values.max, "min": values.min,
            "energy": lambda: (values**2).mean(),
        }[stat]()
    return 0.0 if np.isnan(value) else float(value)
