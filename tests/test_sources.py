import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import encode_direction, lookup_default, sentinel_to_null, two_decimals
from tidemark.params import Params
from tidemark.sources.readers import (
    IngestError, align_schema, ingest_clean, model_features, normalize_headers, scan_dataset, scan_pruned_capped,
    select_features,
)
from tidemark.sources.writers import write_processed, write_window_regimes


def test_ingest_drops_rows_without_a_timestamp(spark):
    raw = spark.createDataFrame(
        [("A", "2023-01-01 00:00:00", 1.0, 1000.0), ("A", "bad", 2.0, 1002.0), ("A", "2023-01-01 02:00:00", 3.0, 1004.0)],
        "STATION string, DATE string, WIND_SPEED double, SEA_LVL_PRES double",
    )
    clean = ingest_clean(raw, "DATE", "STATION", ["WIND_SPEED", "SEA_LVL_PRES"], strict=True)
    assert clean.schema["DATE"].dataType.typeName() == "timestamp"
    assert sorted((r.WIND_SPEED, r.SEA_LVL_PRES) for r in clean.collect()) == [(1.0, 1000.0), (3.0, 1004.0)]


def test_ingest_errors(spark):
    raw = spark.createDataFrame([("A", "bad")], "STATION string, DATE string")
    with pytest.raises(IngestError):
        ingest_clean(raw, "DATE", "STATION")
    with pytest.raises(IngestError):
        ingest_clean(raw, "DATE", "STATION", ["WIND_SPEED"], strict=True)
    with pytest.raises(IngestError):
        scan_dataset(spark, "/nowhere/data.csv")
    with pytest.raises(IngestError):
        scan_dataset(spark, "/nowhere/data.json")


def test_csv_keeps_station_codes_as_text(spark, tmp_path):
    rows = spark.createDataFrame([("0042", "2023-01-01 00:00:00", "1.5"), ("ZSW", "2023-01-01 01:00:00", "x")], "STATION string, DATE string, WIND_SPEED string")
    path = str(tmp_path / "raw.csv")
    rows.write.option("header", True).csv(path)
    clean = ingest_clean(scan_dataset(spark, path), "DATE", "STATION", ["WIND_SPEED"])
    assert {(r.STATION, r.WIND_SPEED) for r in clean.collect()} == {("0042", 1.5), ("ZSW", None)}


def test_headers(spark):
    odd = spark.createDataFrame([("A", "x", 1.0)], ["﻿Station ", "da_te", "W"])
    assert normalize_headers(odd, "STATION", "DATE").columns == ["STATION", "DATE", "W"]
    bare = normalize_headers(odd.select("da_te"), "STATION", "DATE")
    assert bare.first().STATION == "STATION_0"
    assert align_schema(bare, ["W"]).first().W is None


def test_capped_scan(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert sorted(r.id for r in scan_pruned_capped(df, ["id", "absent"], 3, ["id"]).collect()) == [7, 8, 9]
    assert sorted(r.id for r in scan_pruned_capped(df, ["id"], 2, ["id"], last=False).collect()) == [0, 1]


def test_features(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, 3.0, 4.0)], ["STATION", "a", "b", "c", "d"])
    assert select_features(df, ["a", "b", "c", "d", "e"], "STATION") == ["a", "b", "c", "d"]
    assert select_features(df, [], "STATION") == ["a", "b", "c", "d"]
    with pytest.raises(IngestError):
        select_features(df, ["a", "b", "c", "e"], "STATION")
    assert model_features(["a"], ["D", "E"], ["D_SIN", "E_SIN", "D_COS", "E_COS"]) == ["a", "D_SIN", "E_SIN", "D_COS", "E_COS"]


def test_scalars(spark):
    df = spark.createDataFrame([(99.0, 90.0, 0.125), (98.0, None, 21.625)], ["x", "deg", "t"])
    rows = sentinel_to_null(encode_direction(df, ["deg"]), ["x", "absent"]).select("*", two_decimals(F.col("t")).alias("s")).collect()
    assert [r.x for r in rows] == [None, 98.0]
    assert rows[0].deg_SIN == pytest.approx(1.0) and rows[0].deg_COS == pytest.approx(0.0, abs=1e-12)
    assert rows[1].deg_SIN is None
    assert [r.s for r in rows] == ["0.12", "21.62"] == [f"{v:.2f}" for v in (0.125, 21.625)]
    ids = spark.createDataFrame([(1,), (2,)], "m int").select(lookup_default(F.col("m"), {1: 5}).alias("x"))
    assert [r.x for r in ids.collect()] == [5, 2]


def test_params_round_trip():
    params = Params.from_dict({"columns": {"numeric": ["a", "b"]}, "models": {"seed": 7}})
    assert params.columns.numeric == ("a", "b") and params.models.seed == 7 and params.quality.small_gap == 2
    assert Params.from_dict(params.to_dict()) == params
    with pytest.raises(ValueError):
        Params.from_dict({"models": {"sed": 7}})


def test_writers(spark, tmp_path):
    grid = spark.createDataFrame([("A", 1.0), ("B", 2.0)], ["STATION", "x"])
    write_processed(grid, str(tmp_path / "grid"), "parquet", "STATION", 2)
    assert spark.read.parquet(str(tmp_path / "grid")).count() == 2
    t = dt.datetime(2023, 1, 1)
    windows = spark.createDataFrame(
        [("A", 12, 0, 11, t, t, 1.0, 3)],
        ["station", "window_scale", "start_idx", "end_idx", "start_time", "end_time", "WIND_SPEED_s12_mean", "regime_kmeans"],
    )
    write_window_regimes(windows, str(tmp_path / "regimes"))
    out = spark.read.csv(str(tmp_path / "regimes"), header=True)
    assert out.columns[-1] == "regime_kmeans" and "WIND_SPEED_s12_mean" not in out.columns
