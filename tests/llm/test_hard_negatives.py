import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from samples import CLASHES

from tidemark.llm.hard_negatives import _choose, bounds, hilbert_keys, mine_hard_negatives, products

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every):
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out, key = [], lambda s: (-s[0], math.inf if s[1] is None else s[1])
    for n, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=False)), j, other) for m, (j, w, other) in enumerate(kept) if m != n]
        for ps, j, _ in sorted((s for s in scores if s[2] == label), key=key)[:5]:
            found = sorted((s for s in scores if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps), key=key)[:10]
            out += [(i, j, rank + 1, k, ps, s) for rank, (s, k, _) in enumerate(found)]
    return sorted(out, key=str)


def sample(n=700, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(10, 9))
    rows = []
    for i in range(n):
        label = int(r.integers(10))
        rows.append((i, (centres[label] + 0.7 * r.normal(size=9)).astype(np.float32).tolist(), label))
    rows += [(n + i, [0.5] * 9, 3 if i % 2 else 4) for i in range(200)]  # ties
    rows += [(2000, None, 1), (2001, [1.0] * 9, None), (2002, [1.0, None], 1), (2003, [float("nan")] * 9, 1), (2004, [float("inf")] * 9, 2), (2005, [], 2), (2006, [2.0, 1.0], 5), (None, [0.9] * 9, 3)]
    return rows + [rows[20], rows[20], rows[40]]


def result(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"block": 8, "seeds": 2, "group": 5}])
def test_against_brute_force(spark, settings):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES}).repartition(3)
    assert result(mine_hard_negatives(df, every=20, **settings)) == brute(rows, 20)


def test_curve_steps_to_neighbours():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_products_are_exact():
    r = np.random.default_rng(3)
    a, b = r.integers(-500, 500, (40, 6)), r.integers(-500, 500, (300, 6))
    least, most = bounds(a, b.reshape(30, 10, 6).min(axis=1), b.reshape(30, 10, 6).max(axis=1))
    score = (a @ b.T).reshape(40, 30, 10)
    assert (least[:, :, None] <= score).all() and (score <= most[:, :, None]).all()
    huge = r.integers(-(2**29), 2**29, (3, 4))
    assert products(huge, huge).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in huge] for p in huge]


def test_zone_maps_leave_blocks_unread():
    r = np.random.default_rng(4)
    centres = 4_000 * np.eye(8, dtype=np.int64)
    boxes = [(c - 50).astype("<i4").tobytes() for c in centres], [(c + 50).astype("<i4").tobytes() for c in centres]
    zones = pd.DataFrame({"block": range(8), "low": boxes[0], "high": boxes[1], "label_low": range(8), "label_high": range(8), "id_low": 0})
    anchors = (centres + r.integers(-50, 50, (8, 8))).astype("<i4")
    own = int((anchors[0].astype(np.int64) ** 2).sum())
    left = pd.DataFrame({"group": 0, "rid": [0], "label": [0], "vector": [anchors[0].tobytes()], "floors": [[own // 2]], "ceilings": [[2**63 - 1]], "lasts": [[0]]})
    assert _choose(True, 0)(left, zones)["block"].tolist() == [0]
    assert _choose(False, 0)(left, zones)["block"].tolist() == []
    left["floors"] = [[-own]]
    assert _choose(False, 0)(left, zones)["block"].tolist() == list(range(1, 8))
    assert len(_choose(False, 3)(left, zones)) == 3


def test_empty(spark):
    df = spark.createDataFrame(sample(30), SCHEMA)
    assert mine_hard_negatives(df.where("false")).collect() == []
    assert mine_hard_negatives(df.where("label IS NULL")).collect() == []
    assert mine_hard_negatives(df.where("vec_id % 100 = 50")).collect() == []
