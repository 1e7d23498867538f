import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import hours, window_row
from tidemark.operators.windows import (
    META, STATS, feature_names, filter_stats, multiscale_windows, sequence_stack, sliding_windows,
    window_median_raw_energy,
)


def frame(spark, columns, station="A"):
    n = len(next(iter(columns.values())))
    rows = [(station, t, i, *[None if v[i] is None else float(v[i]) for v in columns.values()]) for i, t in enumerate(hours(n))]
    return spark.createDataFrame(rows, "STATION string, DATE timestamp, pos long, " + ", ".join(f"{c} double" for c in columns))


def test_single_scale(spark):
    df = frame(spark, {"WIND_SPEED": range(1, 7), "SEA_LVL_PRES": range(1000, 1006)})
    out = sliding_windows(df, "STATION", "DATE", "pos", ["WIND_SPEED", "SEA_LVL_PRES"], 3, 2)
    rows = out.orderBy("end_idx").collect()
    assert [r.end_idx for r in rows] == [2, 4] and len(out.columns) == len(META) + 8
    assert [r.WIND_SPEED_s3_mean for r in rows] == [2.0, 4.0]
    assert rows[0].WIND_SPEED_s3_std == pytest.approx(0.816497, abs=1e-6)
    assert [r.SEA_LVL_PRES_s3_max for r in rows] == [1002.0, 1004.0]


def test_two_scales(spark):
    df = frame(spark, {"WIND_SPEED": range(10), "WAVE_HGT": [0.5 + 0.1 * i for i in range(10)]})
    for stride, ends in ((2, [5, 7, 9]), (1, [5, 6, 7, 8, 9])):
        out = multiscale_windows(df, "STATION", "DATE", "pos", ["WIND_SPEED", "WAVE_HGT"], [6, 3, 3, 0], stride)
        rows = out.orderBy("end_idx").collect()
        assert [r.end_idx for r in rows] == ends and len(out.columns) == len(META) + 24
        assert out.columns[6:8] == ["WIND_SPEED_s3_mean", "WAVE_HGT_s3_mean"]
        first = rows[0]
        assert (first.window_scale, first.start_idx, first.start_time, first.end_time) == (6, 0, hours(1)[0], hours(6)[5])
        assert (first.WIND_SPEED_s3_mean, first.WIND_SPEED_s6_mean, first.WIND_SPEED_s6_trend) == (4.0, 2.5, 5.0)
        assert first.WIND_SPEED_s3_energy == pytest.approx(50 / 3)


@pytest.mark.parametrize("scales,stride,block", [([3, 8], 1, 5), ([3, 8], 1, 16_384), ([4, 6], 3, 1), ([5], 7, 4), ([6], 6, 4)])
def test_windows_against_numpy(spark, scales, stride, block):
    rng = random.Random(stride)
    series = {f"s{s}": [None if rng.random() < 0.1 else rng.uniform(0, 5) for _ in range(rng.choice([2, 8, 41]))] for s in range(5)}
    df = None
    for s, values in series.items():
        part = frame(spark, {"x": values}, s)
        df = part if df is None else df.unionByName(part)
    got = {(r.station, r.end_idx): r for r in multiscale_windows(df, "STATION", "DATE", "pos", ["x"], scales, stride, block_rows=block).collect()}
    wanted = {(s, e) for s, v in series.items() for e in range(max(scales) - 1, len(v), stride)}
    assert set(got) == wanted
    for (s, e), row in got.items():
        values = np.array([np.nan if v is None else v for v in series[s]])
        for scale in scales:
            for stat in STATS:
                assert row[f"x_s{scale}_{stat}"] == pytest.approx(window_row(values[e - scale + 1 : e + 1], stat), abs=1e-9)


def test_skip_policy_uses_known_values(spark):
    out = multiscale_windows(frame(spark, {"x": [1, None, 5]}), "STATION", "DATE", "pos", ["x"], [3], 1, ("mean", "max"), "skip")
    assert tuple(out.select("x_s3_mean", "x_s3_max").first()) == (3.0, 5.0)


def test_bad_settings(spark):
    df = frame(spark, {"x": [1.0]})
    for arguments in (([0], 1), ([3], 0)):
        with pytest.raises(ValueError):
            multiscale_windows(df, "STATION", "DATE", "pos", ["x"], *arguments)


def test_names():
    assert feature_names(["a", "b"], [6, 3], ("std", "mean")) == [f"{c}_s{s}_{t}" for s in (3, 6) for t in ("mean", "std") for c in "ab"]
    assert filter_stats(["a_s3_mean", "a_s3_std"], ["mean"]) == ["a_s3_mean"]
    assert filter_stats(["a_s3_mean"], ["p90"]) == ["a_s3_mean"]


def test_sequences(spark):
    df = frame(spark, {"x": range(7)}).withColumn("v", F.array("x"))
    for block in (2, 100):
        rows = sequence_stack(df, ["STATION"], "pos", "v", 3, block).orderBy("pos").collect()
        assert [r.pos for r in rows] == [2, 3, 4, 5, 6]
        assert rows[0].sequence == [[0.0], [1.0], [2.0]] and rows[-1].sequence == [[4.0], [5.0], [6.0]]
    assert sequence_stack(df, ["STATION"], "pos", "v", 1).count() == 7


def test_median_and_raw_energy(spark):
    row = window_median_raw_energy(frame(spark, {"x": [1, 2, 4, 8]}), "STATION", "pos", ["x"], 3, 1).orderBy("end_idx").collect()
    assert [(r.end_idx, r.x_median, r.x_energy) for r in row] == [(2, 2.0, 21.0), (3, 4.0, 84.0)]
