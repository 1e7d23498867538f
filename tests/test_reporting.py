import pytest
from pyspark.sql import functions as F

from test_stream_windows import NUMERIC, PARAMS, SCHEMA, batch, models, readings
from tidemark.operators import reports
from tidemark.plans.reporting import run_reports
from tidemark.session import stage

EXPORTS = {"regime_labels", "early_warning", "seasonal_summary", "operational_planning", "sensor_health"}


def test_report_run_writes_all_named_files(spark, tmp_path):
    rows, stored = readings(), models(spark)
    folder = str(tmp_path)
    found = run_reports(spark.createDataFrame(rows, SCHEMA), PARAMS, stored, folder)
    assert set(found.exports) == EXPORTS
    back = {n: spark.read.schema(t.schema).csv(f"{folder}/{n}.csv", header=True) for n, t in found.exports.items()}
    wanted = batch(spark, rows, PARAMS, stored)
    labels = {(r.station, r.end_idx): r for r in back["regime_labels"].collect()}
    assert labels.keys() == wanted.keys() and {r.micro_state for r in labels.values()} == {0, 1}
    stations = sorted({s for s, _ in labels})
    assert sorted(r.station for r in back["early_warning"].collect()) == stations
    latest = {s: max(e for t, e in labels if t == s) for s in stations}
    for r in back["early_warning"].collect():
        assert r.macro_state == labels[(r.station, latest[r.station])].macro_state and 0 <= r.risk_score <= 1
    assert [r.windows for r in back["operational_planning"].collect()] == [len(labels)]
    assert back["seasonal_summary"].first().month == "2023-01"
    assert sorted(r.STATION for r in back["sensor_health"].collect()) == stations
    kpis = spark.read.json(f"{folder}/tables/kpis").first()
    assert kpis.windows == len(labels) and kpis.micro_states == 2
    shares = spark.read.json(f"{folder}/tables/monthly_shares").first().asDict()
    assert sum(v for n, v in shares.items() if n != "month") == pytest.approx(100.0, abs=0.05)
    assert {"severity", "regime_notes", "risk_snapshot", "station_seasons", "station_planning"} <= set(found.tables)
    assert "anomalies" not in found.tables

    # The severities that are handed on give what each table computes for itself.
    view = stage(found.exports["regime_labels"], "view")
    moves = stored.hmm.transition_table(spark)
    assert reports.early_warning(view, moves, None).exceptAll(found.exports["early_warning"]).isEmpty()
    assert reports.planning_station(view).exceptAll(found.tables["station_planning"]).isEmpty()


def test_a_report_run_over_the_last_windows(spark, tmp_path):
    rows, stored = readings(60), models(spark)
    found = run_reports(spark.createDataFrame(rows, SCHEMA), PARAMS, stored, str(tmp_path), last_n=10)
    kept = found.exports["regime_labels"].select("station", "end_idx").collect()
    every = sorted((s, e) for s, e in batch(spark, rows, PARAMS, stored))
    assert sorted((r.station, r.end_idx) for r in kept) == every[-10:]
    assert found.exports["operational_planning"].agg(F.sum("windows")).first()[0] == 10
    assert found.exports["sensor_health"].count() == 3  # sensors are judged on all rows
