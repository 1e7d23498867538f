import datetime as dt

import pytest

from helpers import START
from tidemark.operators import experiments, profiles, reports


def scored(spark, rows):
    """rows: station, end_idx, end_time, micro, macro, wave, wind, pressure."""
    full = [
        (s, 12, i - 11, i, t - dt.timedelta(hours=11) if t else None, t, micro, macro, f"Regime {macro}", wave, wind, pres, 11.0)
        for s, i, t, micro, macro, wave, wind, pres in rows
    ]
    return spark.createDataFrame(
        full,
        "station string, window_scale int, start_idx long, end_idx long, start_time timestamp, end_time timestamp, micro_state int, "
        "macro_state int, macro_state_name string, WAVE_HGT_s12_mean double, WIND_SPEED_s12_mean double, SEA_LVL_PRES_s12_mean double, duration_hours double",
    )


def day(month, d=1):
    return dt.datetime(2023, month, d)


@pytest.fixture(scope="module")
def windows(spark):
    return scored(
        spark,
        [
            ("A", 11, day(1, 1), 0, 0, 1.0, 10.0, 1010.0),
            ("A", 23, day(1, 2), 1, 1, 5.0, 30.0, 990.0),
            ("A", 35, day(2, 3), 2, 2, 2.0, 40.0, 1000.0),
            ("B", 11, day(1, 1), 0, 0, 1.0, 10.0, 1010.0),
            ("B", 23, day(1, 5), 0, 0, 1.0, 10.0, 1010.0),
            ("B", 35, None, 0, 0, 1.0, 10.0, 1010.0),
        ],
    )


def test_severity(windows):
    rows = {r.macro_state: r for r in reports.severity_map(windows).collect()}
    assert rows[0].severity_score == 0.0 and rows[0].severity_level == "Low"
    assert rows[1].severity_score == pytest.approx(0.7 + 0.3 * 20 / 30) and rows[1].severity_level == "High"
    assert rows[2].severity_score == pytest.approx(0.7 * 0.25 + 0.3) and rows[2].severity_level == "Medium"
    flat = reports.severity_map(windows.where("macro_state = 0")).collect()
    assert [(r.severity_score, r.severity_level) for r in flat] == [(0.0, "Low")]
    with pytest.raises(ValueError):
        reports.severity_map(windows.drop("WAVE_HGT_s12_mean", "WIND_SPEED_s12_mean"))


def test_names_and_notes(windows):
    assert {r.macro_state: r.macro_state_name for r in reports.macro_names(windows).collect()} == {0: "Regime 0", 1: "Storm-like", 2: "Windy"}
    notes = {r.macro_state: r.profile_hint for r in reports.regime_notes(windows).collect()}
    assert notes[1] == "WIND_SPEED_s12_mean: 30.00 | WAVE_HGT_s12_mean: 5.00 | SEA_LVL_PRES_s12_mean: 990.00"
    named = profiles.semantic_regime_names(profiles.regime_frame(windows, "macro_state"))
    assert {r.regime_id: r.regime_name for r in named.collect()} == {1: "rough sea regime", 0: "calm regime", 2: "storm regime"}


def test_early_warning(spark, windows):
    moves = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5), (2, 1, 0.25), (2, 2, 0.75)], "from_state int, to_state int, p double")
    mapping = spark.createDataFrame([(0, 0), (1, 1)], "micro_state int, macro_state int")
    rows = reports.early_warning(windows, moves, mapping).collect()
    assert [(r.station, r.end_time) for r in rows] == [("A", day(2, 3)), ("B", day(1, 5))]
    a, b = rows
    assert a.prob_high_next == 0.25 and a.risk_score == pytest.approx(0.7 * 0.475 + 0.3 * 0.25) and a.risk_level == "Medium"
    assert a.explanation == "regime=2 (Medium) | wave=2.00 | wind=40.00 | next-high-prob=0.25"
    assert b.prob_high_next == 0.5 and b.risk_level == "Low"
    direct = {r.macro_state: r.probability for r in reports.next_macro_probs(moves, None, 2).collect()}
    assert direct == {1: 0.25, 2: 0.75}


def test_months(windows):
    shares = {(r.month, r.macro_state_name): r.share for r in reports.monthly_regime_shares(windows).collect()}
    assert shares == {("2023-01", "Regime 0"): 0.75, ("2023-01", "Regime 1"): 0.25, ("2023-02", "Regime 2"): 1.0}
    pivot = reports.monthly_share_pivot(windows, ["Regime 0", "Regime 1", "Regime 2"]).collect()
    assert [tuple(r) for r in pivot] == [("2023-01", 75.0, 25.0, 0.0), ("2023-02", 0.0, 0.0, 100.0)]
    best = reports.dominant_regime_month(windows).collect()
    assert [(r.month, r.macro_state_name, r.dominant_share, r.avg_wave) for r in best] == [("2023-01", "Regime 0", 0.75, 2.0), ("2023-02", "Regime 2", 1.0, 2.0)]
    tied = {(r.station, r.month): r.macro_state_name for r in reports.dominant_regime_station_month(windows).collect()}
    assert tied[("A", "2023-01")] == "Regime 0"


def test_planning(windows):
    overall = {r.month: r for r in reports.planning_overall(windows).collect()}
    assert (overall["2023-01"].low_share, overall["2023-01"].high_share, overall["2023-01"].recommended) == (75.0, 25.0, "Yes")
    assert overall["2023-02"].med_share == 100.0 and overall["2023-02"].recommended == "No"
    stations = {(r.station, r.month): r.recommended for r in reports.planning_station(windows).collect()}
    assert stations == {("A", "2023-01"): "No", ("A", "2023-02"): "No", ("B", "2023-01"): "Yes"}


def test_snapshot_and_kpis(windows):
    row = reports.risk_snapshot(windows).first()
    assert row.wave == pytest.approx(11 / 6) and row.level == "Medium"
    assert row.note.startswith("Moderate marine variability (wave=1.83, wind=18.33)")
    kpis = reports.dashboard_kpis(windows).first()
    assert tuple(kpis) == (6, 3, 3, 11.0)
    assert [r.end_idx for r in reports.last_n_windows(windows, 2).collect()] == [35, 23]
    assert [r.end_idx for r in reports.anomaly_topk(windows, "WAVE_HGT_s12_mean", 2).collect()] == [23, 35]


def test_argmax_takes_the_first_of_equal_rows(spark):
    df = spark.createDataFrame([("g", "b", 1.0), ("g", "a", 1.0), ("g", "c", 0.5)], "g string, k string, v double")
    assert profiles.argmax_per_group(df, ["g"], "v", ["k"]).first().k == "a"


@pytest.mark.parametrize("block", [2, 100])
def test_sensor_health(spark, block):
    start = dt.datetime(2023, 1, 1)
    ok = [("ok", i, start + dt.timedelta(hours=i), float(i % 5), float(i)) for i in range(20)]
    spike = [("spike", i, start + dt.timedelta(hours=i + 10 * (i > 9)), 1000.0 if i == 5 else float(i % 4), float(i)) for i in range(20)]
    flat = [("flat", i, start + dt.timedelta(hours=i), None if i % 2 else 3.0, 1.0) for i in range(20)]
    df = spark.createDataFrame(ok + spike + flat, "STATION string, pos long, DATE timestamp, x double, y double")
    rows = {r.STATION: r for r in reports.sensor_health(df, "STATION", "DATE", "pos", ["x", "y", "absent"], block).collect()}
    assert rows["ok"].status == "Good" and rows["ok"].health_score == 1.0
    assert rows["spike"].spike_rate == 0.025 and rows["spike"].gap_rate == round(1 / 19, 4)
    # x: half missing and no two neighbours known; y: always the same value.
    assert (rows["flat"].missing_rate, rows["flat"].flatline_rate, rows["flat"].spike_rate) == (0.25, 0.5, 0.0)
    assert rows["flat"].health_score == round(1 - 0.45 * 0.25 - 0.25 * 0.5, 4)


def metrics(spark, rows):
    return spark.createDataFrame(rows, "experiment_id string, model string, metric string, value double")


def test_comparison_tables(spark, tmp_path):
    values = metrics(
        spark,
        [("e", "kmeans", "silhouette", 0.9), ("e", "kmeans", "silhouette_post", 0.5), ("e", "hmm", "silhouette_embed", 0.7),
         ("e", "hmm", "bic", 10.0), ("e", "changepoint", "n_breaks", 3.0), ("f", "gmm", "bic", 1.0)],
    )
    entropies = spark.createDataFrame([("e", "gmm", 0.1)], "experiment_id string, model string, transition_entropy double")
    rows = {(r.experiment_id, r.model): r for r in experiments.comparative_rows(values, entropies).collect()}
    assert rows[("e", "kmeans")].silhouette == 0.5 and rows[("e", "hmm")].bic == 10.0
    assert rows[("e", "gmm")].transition_entropy == 0.1 and rows[("e", "gmm")].silhouette is None
    assert {r.experiment_id: r.model for r in experiments.best_model(values).collect()} == {"e": "hmm", "f": "gmm"}
    table = {(r.experiment_id, r.model): r for r in experiments.metrics_table(values, ["silhouette", "bic"]).collect()}
    assert table[("e", "kmeans")].silhouette == 0.9 and table[("e", "changepoint")].bic is None
    for name in ("one", "two"):
        experiments.comparative_rows(values, entropies).write.option("header", True).csv(str(tmp_path / name / "comparative_rows.csv"))
    both = experiments.union_experiments(spark, str(tmp_path))
    assert both.count() == 2 * len(rows)
    means = {r.model: r.bic for r in experiments.comparative_mean_by_model(both).collect()}
    assert means["hmm"] == 10.0 and means["kmeans"] is None
    with pytest.raises(FileNotFoundError):
        experiments.union_experiments(spark, str(tmp_path / "nowhere"))
    record = experiments.experiment_record(values, "e", {"k": 1}, "note", {"rows": both})
    experiments.append_record(record, str(tmp_path / "records"))
    experiments.append_record(record, str(tmp_path / "records"))
    saved = spark.read.json(str(tmp_path / "records"))
    assert saved.count() == 2 and saved.first().selected_model == "hmm"


def test_shares_and_counts_keep_unlisted_regimes(spark):
    rows = spark.createDataFrame([(START, n, m, 0) for n, m in (("A", 0), ("B", 1), ("C", 2))], "end_time timestamp, macro_state_name string, macro int, micro int")
    month = reports.monthly_share_pivot(rows, ["A", "B"]).first()
    assert (month["A"], month["B"]) == (33.33, 33.33)
    assert profiles.crosstab_micro_macro(rows, "micro", "macro", range(3)).first()["macro_2"] == 1
    with pytest.raises(Exception, match="without a column"):
        profiles.crosstab_micro_macro(rows, "micro", "macro", range(2)).collect()


def odd_sensors(spark):
    """Rows with null stations, positions, timestamps and readings, NaN, a sole row, constant readings and spikes."""
    start, rows = dt.datetime(2023, 1, 1), []
    for k, name in enumerate(["a", "b", "c", "d", None]):
        for i in range(1 if name == "d" else 30 + k):
            x = 500.0 if i == 7 else float("nan") if i == 9 and name == "b" else float((i * 7 + k) % 11)
            y = None if (i + k) % 6 == 0 and name != "c" else 2.0 if name == "a" else float(i % 3)
            t = None if i == 11 else start + dt.timedelta(hours=i + 20 * (i > 15))
            rows.append((name, None if i == 0 and name == "c" else i, t, x, y))
    return spark.createDataFrame(rows, "STATION string, pos long, DATE timestamp, x double, y double")


def test_sensor_health_of_whole_and_cut_stations(spark):
    df = odd_sensors(spark)
    whole, cut = (reports.sensor_health(df, "STATION", "DATE", "pos", ["x", "y"], 4, n).collect() for n in (1000, 5))
    assert len(whole) == 5 and any(r.spike_rate > 0 for r in whole) and any(r.gap_rate > 0 for r in whole)
    assert sorted(map(str, whole)) == sorted(map(str, cut))


def test_sensor_health_shuffles_readings_once(spark, monkeypatch):
    plans, write = [], getattr(reports, "stage", None)

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(reports, "stage", noted, raising=False)
    out = reports.sensor_health(odd_sensors(spark), "STATION", "DATE", "pos", ["x", "y"], 4)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("Exchange hashpartitioning") for p in plans) == 1 and len(out.collect()) == 5
