import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import START
from tidemark.operators.hmm import HmmParameters
from tidemark.operators.scaling import scaler_params
from tidemark.params import Columns, Params, Quality, Windows
from tidemark.plans.scoring import clean_grid, score_windows, window_features
from tidemark.session import cut_lineage
from tidemark.sources.model_store import StoredModels
from tidemark.sources.readers import model_features
from tidemark.streaming import windows as live
from tidemark.streaming.windows import layout_of, score_stream

PARAMS = Params(
    columns=Columns(numeric=("WIND_SPEED", "AIR_TEMP"), directional=("WIND_DIR",), width="1h"),
    windows=Windows(multiscale=True, scales=(3, 8), stride=2),
    quality=Quality(small_gap=1, medium_gap=3),
)
NUMERIC, DIRECTIONS = ["WIND_SPEED", "AIR_TEMP"], ["WIND_DIR"]
SCHEMA = "STATION string, DATE timestamp, WIND_SPEED double, AIR_TEMP double, WIND_DIR double"


def readings(hours=120):
    rng, rows = random.Random(7), []
    for s in range(3):
        for h in range(hours):
            # Holes in the series, holes in one column, and readings that come in twice an hour.
            if rng.random() < 0.2 or (s == 1 and 40 <= h < 60) or (s == 2 and h > 50):
                continue
            for _ in range(rng.choice([1, 1, 2])):
                air = None if 70 <= h < 84 or rng.random() < 0.2 else 15 + rng.random() + h % 5
                rows.append((f"S{s}", START + dt.timedelta(hours=h, minutes=rng.randint(0, 59)), 5 + 9 * rng.random(), air, float(rng.randint(100, 359))))
    return sorted(rows, key=lambda r: r[1])


def plain_windows(spark, rows, params, bounds):
    grid, _ = clean_grid(spark.createDataFrame(rows, SCHEMA), params, NUMERIC, DIRECTIONS, bounds)
    return window_features(grid, params, model_features(NUMERIC, DIRECTIONS, grid.columns))


def models(spark, params=PARAMS):
    rng = np.random.default_rng(3)
    names = layout_of(params, NUMERIC, DIRECTIONS, None, 50).window_features
    hmm = HmmParameters(np.array([0.5, 0.5]), np.array([[0.9, 0.1], [0.1, 0.9]]), rng.normal(size=(2, len(names))) / 4, np.ones((2, len(names))))
    bounds = spark.createDataFrame([("WIND_SPEED", 6.0, 13.0)], "column string, clip_low double, clip_high double")
    scaler = cut_lineage(scaler_params(plain_windows(spark, readings(), params, bounds), names))
    return StoredModels(scaler, hmm, {"window_features": names, "numeric": NUMERIC, "directional": DIRECTIONS}, bounds)


def plain(row):
    return {n: v.isoformat() if isinstance(v, dt.datetime) else v for n, v in row.asDict().items()}


def batch(spark, rows, params, stored):
    windows = plain_windows(spark, rows, params, stored.bounds)
    states = score_windows(windows, stored, causal=True).select("station", "end_idx", "micro_state", "macro_state")
    return {(r.station, r.end_idx): plain(r) for r in windows.join(states, ["station", "end_idx"]).collect()}


def stream(spark, folder, rows, cuts, params, stored, **settings):
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(rows[low:high], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        path = score_stream(source, params, stored, folder, "2 hours", **settings)
    got = spark.read.parquet(path).collect()
    found = {(r.station, r.end_idx): plain(r) for r in got}
    assert len(found) == len(got)
    return found


def same(got, wanted):
    assert got.keys() == wanted.keys()
    for key, row in got.items():
        assert row == pytest.approx(wanted[key], abs=1e-9), key


def closed_rows(rows):
    limit = max(r[1] for r in rows) - dt.timedelta(hours=2)
    return [r for r in rows if r[1].replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1) <= limit]


@pytest.mark.parametrize("drop", [False, True])
def test_stream_of_readings_equals_the_batch_plan(spark, tmp_path, monkeypatch, drop):
    params = Params(PARAMS.columns, Quality(1, 3, drop), PARAMS.windows)
    monkeypatch.setattr(live, "SLICE_ROWS", 5)
    rows, stored = readings(), models(spark, params)
    wanted = batch(spark, closed_rows(rows), params, stored)
    # Without a next reading the last rows of a gap stay open, so the stream may lack a station's last windows.
    n = len(rows)
    one = stream(spark, str(tmp_path / "one"), rows, [0, n], params, stored)
    assert one.keys() <= wanted.keys() and len(one) > 60 and len({r["micro_state"] for r in one.values()}) == 2
    lacking = [k for k in wanted if k not in one]
    assert len(lacking) <= 9 and all(e > max(x for t, x in one if t == s) for s, e in lacking)
    for r in one.values():
        assert r == pytest.approx({k: wanted[(r["station"], r["end_idx"])][k] for k in r}, abs=1e-9)
    for parts in (5,) if drop else (2, 5):
        cuts = [n * i // parts for i in range(parts + 1)]
        same(stream(spark, str(tmp_path / f"parts{parts}"), rows, cuts, params, stored), one)


def test_an_idle_station_is_closed_and_may_come_back(spark, tmp_path):
    rows, stored = readings(), models(spark)
    end = (START + dt.timedelta(hours=50)).isoformat()
    wanted = batch(spark, [r for r in closed_rows(rows) if r[0] == "S2"], PARAMS, stored)
    again = [("S2", START + dt.timedelta(hours=150 + h), 7.0, 16.0, 200.0) for h in range(12)]
    tail = [("S0", START + dt.timedelta(hours=160 + h), 7.0, 16.0, 200.0) for h in range(8)]
    folder, n = str(tmp_path), len(rows)
    for part in (rows, [*again, *tail]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        path = score_stream(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), PARAMS, stored, folder, "2 hours", idle="24h")
    got = [plain(r) for r in spark.read.parquet(path).where("station = 'S2'").collect()]
    old = {(r["station"], r["end_idx"]): r for r in got if r["end_time"] <= end}
    same(old, {k: {n: v for n, v in r.items() if n in old[k]} for k, r in wanted.items()})
    new = [r for r in got if r["end_time"] > end]
    assert sorted(r["end_idx"] for r in new) == [7, 9, 11] and min(r["start_time"] for r in new) == again[0][1].isoformat()


def test_a_gap_beyond_patience_has_no_end(spark):
    layout = layout_of(PARAMS, ["WIND_SPEED"], [], None, 6)
    series = live.Series.new(0, layout)
    series.raw = np.array([[1.0], *[[np.nan]] * 6])
    filled, at = series.settle(layout, False)
    # Six rows after the known value the gap is open no longer; rows that a value to come may still fill stay.
    assert filled[:, 0].tolist()[:5] == [1.0] * 5 and at.tolist() == [0, 1, 2, 3, 4, 5] and np.isnan(filled[5, 0])
    series.raw = np.vstack([series.raw, [[9.0]]])
    filled, _ = series.settle(layout, False)
    assert filled[:, 0].tolist() == [9.0, 9.0]
    short = live.Series.new(0, layout)
    short.raw = np.array([[1.0], *[[np.nan]] * 4, [7.0]])
    assert short.settle(layout, False)[0][:, 0] == pytest.approx([1.0, 1.0, 3.0, 5.0, 7.0, 7.0])
    with pytest.raises(ValueError):
        layout_of(PARAMS, ["WIND_SPEED"], [], None, 4)


def test_state_stays_bounded(spark):
    layout = layout_of(PARAMS, ["WIND_SPEED"], [], None, 20)
    series = live.Series.new(0, layout)
    step = layout.step
    micros = np.array([0, 50_000]) * step  # a silence of 50,000 rows between two readings
    ends = [f["end_idx"] for f in series.advance(micros, np.array([[1.0], [2.0]]), layout)]
    assert np.concatenate(ends).tolist() == list(range(7, 50_001, 2))
    assert len(series.raw) == 0 and len(series.tail) == 7 and series.rows == 50_001
    again = live.Series.load(series.dump(), layout)
    assert repr(again.dump()) == repr(series.dump())


def test_streams_without_closed_bins_give_no_windows(spark, tmp_path):
    stored, folder = models(spark), str(tmp_path)
    nothing = spark.createDataFrame([], SCHEMA)
    for part in (nothing, spark.createDataFrame(readings()[:3], SCHEMA)):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        assert score_stream(source, PARAMS, stored, folder, "2 hours") == f"{folder}/windows"
    assert spark.read.parquet(f"{folder}/bins").count() <= 3
