"""One report run: every operational table from one scored table, and the named exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators.reports import (
    anomaly_topk, dashboard_kpis, dominant_regime_month, dominant_regime_station_month, early_warning, error_summary, last_n_windows,
    monthly_share_pivot, planning_overall, planning_station, regime_notes, risk_snapshot, sensor_health, severity_map,
)
from tidemark.operators.series import BLOCK_ROWS
from tidemark.params import Params
from tidemark.plans.scoring import same, score_run
from tidemark.session import stage
from tidemark.sources.model_store import LATENT_MODE, StoredModels
from tidemark.sources.writers import export_report, write_reports_json

ERROR = "reconstruction_error"


@dataclass
class Reports:
    """``exports`` are the named files of a run, ``tables`` what else it shows."""

    exports: dict[str, DataFrame]
    tables: dict[str, DataFrame]


def compose_reports(
    scored: DataFrame,
    cleaned: DataFrame,
    transitions: DataFrame,
    mapping: DataFrame | None,
    params: Params,
    sensors: Sequence[str],
    last_n: int | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = same,
    block_rows: int = BLOCK_ROWS,
) -> Reports:
    """All tables over ``scored``, or over its last ``last_n`` windows; sensors are judged on the whole ``cleaned`` grid.

    ``transitions`` is the long matrix of micro states, ``mapping`` their macro states where windows are embedded.
    ``keep`` writes what several tables read: the windows, their severities (one row per macro state) and the grid.
    Windows without an end time are in ``regime_labels`` but in no monthly table and in no early warning.
    """
    c = params.columns
    view = keep(scored if last_n is None else last_n_windows(scored, last_n), "view")
    severity = keep(severity_map(view), "severity")
    grid = keep(cleaned.select(c.station, c.timestamp, "pos", *sensors), "sensors")
    # One name per macro state.
    names = sorted(r[0] for r in view.select("macro_state_name").where("macro_state_name IS NOT NULL").distinct().collect())
    exports = {
        "regime_labels": view,
        "early_warning": early_warning(view, transitions, mapping, severity=severity),
        "seasonal_summary": dominant_regime_month(view),
        "operational_planning": planning_overall(view, severity),
        "sensor_health": sensor_health(grid, c.station, c.timestamp, "pos", sensors, block_rows),
    }
    tables = {
        "kpis": dashboard_kpis(view),
        "risk_snapshot": risk_snapshot(view),
        "severity": severity,
        "regime_notes": regime_notes(view),
        "monthly_shares": monthly_share_pivot(view, names),
        "station_seasons": dominant_regime_station_month(view),
        "station_planning": planning_station(view, severity=severity),
    }
    if ERROR in view.columns:
        tables["error_summary"] = error_summary(view, ERROR)
        tables["anomalies"] = anomaly_topk(view, ERROR)
    return Reports(exports, tables)


def write_exports(reports: Reports, folder: str) -> None:
    """The exports as ``<name>.csv`` and the tables as JSON below ``tables``; each is a folder of part files."""
    for name, table in reports.exports.items():
        export_report(table, f"{folder}/{name}.csv")
    write_reports_json(reports.tables, f"{folder}/tables")


def run_reports(raw: DataFrame, params: Params, models: StoredModels, folder: str, last_n: int | None = None) -> Reports:
    """Score ``raw`` with stored models, compose all reports and write them below ``folder``."""
    cleaned, scored = score_run(raw, params, models, keep=stage)
    mapping = models.mapping if models.mode == LATENT_MODE else None
    transitions = models.hmm.transition_table(raw.sparkSession)
    reports = compose_reports(scored, cleaned, transitions, mapping, params, models.settings["numeric"], last_n, stage)
    write_exports(reports, folder)
    return reports
