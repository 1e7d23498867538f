import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import START, fill, hours
from tidemark.functions.quantiles import exact_quantiles
from tidemark.operators import resample, series
from tidemark.operators.gaps import gap_fill
from tidemark.operators.quality import clip_outliers, quality_preprocess
from tidemark.operators.resample import densify_grid, resample_mean
from tidemark.operators.series import number_rows
from tidemark.params import Quality


def test_resample_half_hours(spark):
    stamps = [START + dt.timedelta(minutes=30 * i) for i in range(4)]
    raw = spark.createDataFrame(list(zip("AAAA", stamps, [2.0, 4.0, 6.0, 8.0])), ["STATION", "DATE", "WIND_SPEED"])
    rows = resample_mean(raw, "STATION", "DATE", ["WIND_SPEED"], (), "1H").orderBy("pos").collect()
    assert [(r.DATE, r.WIND_SPEED) for r in rows] == [(stamps[0], 3.0), (stamps[2], 7.0)]
    with pytest.raises(ValueError):
        resample_mean(raw, "STATION", "DATE", [], (), "1h")


def test_grid_spans_each_station_and_bins_start_at_its_first_midnight(spark, monkeypatch):
    raw = spark.createDataFrame(
        [("A", dt.datetime(2023, 1, 1, 8), 1.0), ("A", dt.datetime(2023, 1, 3, 1), 2.0), ("B", dt.datetime(2023, 1, 2, 5), 3.0), (None, START, 9.0)],
        ["STATION", "DATE", "X"],
    )
    for stations in (200_000, 0):  # broadcast first days, then the pre-combined way
        monkeypatch.setattr(resample, "BROADCAST_STATIONS", stations)
        rows = resample_mean(raw, "STATION", "DATE", ["X"], (), "7h").orderBy("STATION", "pos").collect()
        a = [(r.DATE, r.X) for r in rows if r.STATION == "A"]
        assert a[0] == (dt.datetime(2023, 1, 1, 7), 1.0) and a[-1] == (dt.datetime(2023, 1, 3, 1), 2.0)
        assert len(a) == 7 and all(x is None for _, x in a[1:-1])
        assert [(r.DATE, r.X) for r in rows if r.STATION == "B"] == [(dt.datetime(2023, 1, 2), 3.0)]


def test_zoneless_timestamps_stay_zoneless(spark):
    raw = spark.createDataFrame([("A", "2023-01-01 00:10:00", 1.0)], ["STATION", "DATE", "X"]).withColumn(
        "DATE", F.col("DATE").cast("timestamp_ntz")
    )
    out = resample_mean(raw, "STATION", "DATE", ["X"], (), "1h")
    assert out.schema["DATE"].dataType.typeName() == "timestamp_ntz"
    assert out.first().DATE == START


def test_circular_mean_around_north(spark):
    raw = spark.createDataFrame([("A", START, 1.0, 350.0), ("A", START + dt.timedelta(minutes=5), 1.0, 20.0)], ["STATION", "DATE", "X", "D"])
    assert resample_mean(raw, "STATION", "DATE", ["X"], ["D"], "1h").first().D == pytest.approx(5.0)


def test_grid_is_the_same_for_any_block_size(spark):
    raw = spark.createDataFrame([("A", START), ("A", START + dt.timedelta(hours=99))], ["STATION", "DATE"])
    for block in (1, 7, 100, 16_384):
        assert [r.pos for r in densify_grid(raw, "STATION", "DATE", "1h", block).orderBy("pos").collect()] == list(range(100))


def test_quality_of_a_short_series(spark):
    raw = spark.createDataFrame(
        list(zip("AAAA", hours(4), range(4), [1.0, None, 3.0, 4.0], [0.0, 90.0, 180.0, 270.0])),
        "STATION string, DATE timestamp, pos long, WIND_SPEED double, WIND_DIR double",
    )
    clean, report = quality_preprocess(raw, "STATION", "pos", ["WIND_SPEED"], ["WIND_DIR"], Quality(2, 2, False, 0.0, 1.0))
    rows = clean.orderBy("pos").collect()
    assert [r.WIND_SPEED for r in rows] == [1.0, 1.0, 3.0, 4.0]
    assert [r.WIND_DIR_SIN for r in rows] == pytest.approx([0, 1, 0, -1], abs=1e-12)
    assert [r.WIND_DIR_COS for r in rows] == pytest.approx([1, 0, -1, 0], abs=1e-12)
    found = report.first()
    assert (found.missing_before, found.missing_after, found.clip_low, found.clip_high) == (0.25, 0.0, 1.0, 4.0)


@pytest.mark.parametrize("small,medium", [(2, 6), (1, 3), (3, 1), (0, 4)])
def test_gap_fill_against_pandas(spark, small, medium, monkeypatch):
    rng = random.Random(small * 10 + medium)
    rows, expected = [], {}
    for s in range(12):
        n = rng.randint(1, 60)
        p = rng.choice([0.2, 0.6, 0.9, 1.0])
        values = [None if rng.random() < p else round(rng.uniform(0, 9), 2) for _ in range(n)]
        rows += [(f"s{s}", i, v) for i, v in enumerate(values)]
        expected[f"s{s}"] = fill(values, small, medium)
    df = spark.createDataFrame(rows, "STATION string, pos long, x double")
    for block, run in ((1, 4), (5, 2), (16_384, series.RUN_BLOCKS)):
        monkeypatch.setattr(series, "RUN_BLOCKS", run)
        got = {}
        for r in gap_fill(df, ["STATION"], "pos", ["x"], (), small, medium, block_rows=block).orderBy("pos").collect():
            got.setdefault(r.STATION, []).append(r.x)
        for s, wanted in expected.items():
            assert [v is None for v in got[s]] == [v is None for v in wanted]
            assert [v or 0.0 for v in got[s]] == pytest.approx([v or 0.0 for v in wanted])


def test_drop_large_gap_rows_looks_at_directions_too(spark):
    df = spark.createDataFrame([("A", 0, 1.0, None), ("A", 1, 2.0, 10.0)], "STATION string, pos long, x double, d double")
    kept = gap_fill(df, ["STATION"], "pos", ["x"], ["d"], 0, 1, drop_large_gap_rows=True)
    assert [(r.pos, round(r.d, 6)) for r in kept.collect()] == [(1, 10.0)]


@pytest.mark.parametrize("in_memory_rows", [0, 100_000])
def test_exact_quantiles_against_numpy(spark, in_memory_rows):
    rng = np.random.default_rng(3)
    groups = {"normal": rng.normal(size=4001), "ties": rng.integers(0, 4, 1500) * 1.0, "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "tail": np.exp(rng.normal(size=777) * 9)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("ties", None), ("empty", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = [0.0, 0.005, 0.1, 0.5, 0.995, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", wanted, accuracy=500, in_memory_rows=in_memory_rows).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g].n == len(values)
        assert got[g].q == pytest.approx(list(np.quantile(values, wanted)), rel=1e-12)
    whole = exact_quantiles(df.where("g = 'normal'"), [], "v", [0.5], accuracy=500, in_memory_rows=in_memory_rows).first()
    assert whole.q[0] == pytest.approx(float(np.median(groups["normal"])))


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(float(i), None if i == 3 else 1.0) for i in range(101)], "x double, y double")
    clipped, bounds = clip_outliers(df, ["x", "y"], 0.05, 0.95)
    assert {r.column: (r.clip_low, r.clip_high) for r in bounds.collect()} == {"x": (5.0, 95.0), "y": (1.0, 1.0)}
    found = clipped.agg(F.min("x"), F.max("x"), F.count("y")).first()
    assert tuple(found) == (5.0, 95.0, 100)


def test_rows_are_numbered_across_buckets(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"s{rng.randint(0, 3)}", rng.randint(0, 500), i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    got = {r.id: r.pos for r in number_rows(df, ["k"], ["t", "id"], {"part": F.floor(F.col("t") / 50)}).collect()}
    for k in {r[0] for r in rows}:
        ordered = sorted((t, i) for kk, t, i in rows if kk == k)
        assert [got[i] for _, i in ordered] == list(range(len(ordered)))
