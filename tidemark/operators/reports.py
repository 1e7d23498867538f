"""Operational tables from scored windows.

The input carries ``station, start_time, end_time, end_idx, micro_state, macro_state`` (and
``macro_state_name`` where a name is reported), ``duration_hours`` and ``<feature>_..._mean`` columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.quantiles import IN_MEMORY_ROWS, exact_quantiles
from tidemark.functions.scalars import explain_parts, first_mean_column, present, severity_level, two_decimals
from tidemark.functions.times import is_zoneless, month_key, to_micros
from tidemark.operators.profiles import argmax_per_group, mean_columns, share_of_group
from tidemark.operators.series import BLOCK_ROWS, previous_values, spread_join
from tidemark.session import stage

# Measures shown in regime notes, in order of preference.
NOTE_PREFIXES = ("WIND_SPEED", "WAVE_HGT", "SEA_LVL_PRES", "AIR_TEMP", "SWELL_HGT", "WAVE_PERIOD")
# Weights and limits of the scores below.
WAVE_WEIGHT, WIND_WEIGHT = 0.7, 0.3
SEVERITY_WEIGHT, NEXT_HIGH_WEIGHT = 0.7, 0.3
WIND_SCALE = 15.0
SNAPSHOT_MEDIUM, SNAPSHOT_HIGH = 2.5, 4.5
LOW_SHARE_NEEDED, LOW_PERCENT_NEEDED, HIGH_PERCENT_ALLOWED = 0.6, 60.0, 15.0
HEALTH_WEIGHTS = {"missing_rate": 0.45, "flatline_rate": 0.25, "spike_rate": 0.2, "gap_rate": 0.1}
HEALTH_GOOD, HEALTH_WARNING = 0.75, 0.5
SPIKE_Z, MAD_SCALE, GAP_FACTOR = 6.0, 1.4826, 2.5


def _wave_wind(df: DataFrame) -> dict[str, str]:
    found = {"wave": first_mean_column(df.columns, "WAVE_HGT"), "wind": first_mean_column(df.columns, "WIND_SPEED")}
    found = {k: v for k, v in found.items() if v}
    if not found:
        raise ValueError("neither a WAVE_HGT nor a WIND_SPEED mean column is present")
    return found


def _min_max(name: str) -> Column:
    everything = Window.partitionBy()
    low, high = F.min(name).over(everything), F.max(name).over(everything)
    return F.when(high - low <= 1e-9, F.lit(0.0)).when(low.isNull(), F.lit(0.0)).otherwise((F.col(name) - low) / (high - low))


def severity_map(df: DataFrame) -> DataFrame:
    """Per macro state: wave and wind means, their weighted min-max score and its level."""
    measures = _wave_wind(df)
    means = df.groupBy("macro_state").agg(*[F.avg(c).alias(f"{k}_mean") for k, c in measures.items()])
    weights = {"wave": WAVE_WEIGHT, "wind": WIND_WEIGHT}
    score = sum((F.lit(weights[k]) * _min_max(f"{k}_mean") for k in measures), F.lit(0.0))
    scored = means.withColumn("severity_score", score)
    return scored.withColumn("severity_level", severity_level(F.col("severity_score"))).orderBy(
        F.desc("severity_score"), "macro_state"
    )


def last_n_windows(df: DataFrame, n: int | None = None, order_by: Sequence[str] = ("station", "end_idx")) -> DataFrame:
    """The last ``n`` windows (300 if not given) in ``order_by`` order.

    ``('station', 'end_idx')`` is the order of a concatenated table; pass ``('end_time', ...)`` for the
    latest in time.
    """
    return df.orderBy(*[F.desc(c) for c in order_by]).limit(300 if n is None else n)


def risk_snapshot(df: DataFrame, order_by: Sequence[str] = ("station", "end_idx")) -> DataFrame:
    """One row: wave and wind over the last 120 windows, the score, its level and a note."""
    measures = _wave_wind(df)
    recent = last_n_windows(df, 120, order_by).agg(*[F.avg(c).alias(k) for k, c in measures.items()])
    score = F.lit(0.0)
    if "wave" in measures:
        score = score + F.col("wave")
    if "wind" in measures:
        score = score + F.col("wind") / WIND_SCALE
    detail = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), two_decimals(F.col(k))) for k in measures])
    level = F.when(F.col("score") >= SNAPSHOT_HIGH, "High").when(F.col("score") >= SNAPSHOT_MEDIUM, "Medium").otherwise("Low")
    text = (
        F.when(F.col("level") == "High", "Rough/storm tendency in recent windows")
        .when(F.col("level") == "Medium", "Moderate marine variability")
        .otherwise("Relatively calm marine behavior")
    )
    return (
        recent.withColumn("score", score)
        .withColumn("level", level)
        .withColumn("note", F.concat(text, F.lit(" ("), detail, F.lit(").")))
    )


def macro_names(df: DataFrame) -> DataFrame:
    """``macro_state, macro_state_name`` after the extreme of wave, wind, then pressure."""
    found = {
        "wave": first_mean_column(df.columns, "WAVE_HGT"),
        "wind": first_mean_column(df.columns, "WIND_SPEED"),
        "pres": first_mean_column(df.columns, "SEA_LVL_PRES"),
    }
    found = {k: c for k, c in found.items() if c}
    means = df.where(F.col("macro_state").isNotNull()).groupBy("macro_state").agg(
        *([F.avg(c).alias(k) for k, c in found.items()] or [F.count(F.lit(1)).alias("_n")])
    )
    everything = Window.partitionBy()
    name = F.concat(F.lit("Regime "), F.col("macro_state").cast("string"))
    rules = [("pres", F.min, "Low-pressure"), ("wind", F.max, "Windy"), ("wave", F.max, "Storm-like")]
    for measure, extreme, title in rules:
        if measure in found:
            name = F.when(F.col(measure) == extreme(measure).over(everything), title).otherwise(name)
    return means.select("macro_state", name.alias("macro_state_name"))


def name_macro_states(df: DataFrame, names: DataFrame) -> DataFrame:
    """Adds ``macro_state_name``; a state without a name is called ``Regime <id>``."""
    pairs = names.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("macro_state").cast("int"), "macro_state_name")))
    ).scalar()
    default = F.concat(F.lit("Regime "), F.col("macro_state").cast("string"))
    return df.withColumn("macro_state_name", F.coalesce(F.element_at(pairs, F.col("macro_state").cast("int")), default))


def regime_notes(df: DataFrame) -> DataFrame:
    """Per macro state: mean window length and a hint from the first three measures."""
    shown = mean_columns(df.columns, NOTE_PREFIXES)
    if not shown:
        raise ValueError("no measure to describe regimes by")
    means = df.groupBy("macro_state").agg(
        F.avg("duration_hours").alias("avg_duration_hr"), *[F.avg(c).alias(c) for c in shown]
    )
    hints = [F.concat(F.lit(f"{c}: "), two_decimals(F.col(c))) for c in shown[:3]]
    return means.select(
        F.col("macro_state").cast("int").alias("macro_state"),
        "avg_duration_hr",
        explain_parts(*hints).alias("profile_hint"),
        F.concat(F.lit("Marine regime "), F.col("macro_state").cast("string")).alias("interpretation"),
    ).orderBy("macro_state")


def next_macro_probs(transitions: DataFrame, mapping: DataFrame | None, current_micro: int | None = None) -> DataFrame:
    """Probability of each macro state after a micro state.

    ``transitions`` is a long micro matrix ``from_state, to_state, p``; ``mapping`` has ``micro_state,
    macro_state`` and may leave states out, which then stand for themselves. Without
    ``current_micro`` every micro state gets its rows: ``micro_state, macro_state, probability``.
    """
    if current_micro is not None:
        transitions = transitions.where(F.col("from_state") == current_micro)
    macro = F.col("to_state")
    if mapping is not None:
        targets = mapping.select(F.col("micro_state").alias("to_state"), F.col("macro_state").alias("_macro"))
        transitions = transitions.join(targets, "to_state", "left")
        macro = F.coalesce("_macro", "to_state")
    return transitions.groupBy(
        F.col("from_state").cast("int").alias("micro_state"), macro.cast("int").alias("macro_state")
    ).agg(F.sum("p").alias("probability"))


def latest_window(df: DataFrame, station: str = "station") -> DataFrame:
    """The window with the greatest end time per station, the first one on ties."""
    return argmax_per_group(df.where(F.col("end_time").isNotNull()), [station], "end_time", ["end_idx"])


def early_warning(
    df: DataFrame,
    transitions: DataFrame,
    mapping: DataFrame | None,
    station: str = "station",
    severity: DataFrame | None = None,
) -> DataFrame:
    """Latest state per station with the risk of being, or moving into, a severe macro state.

    ``severity`` is ``severity_map(df)``, where the caller has it already.
    """
    measures = _wave_wind(df)
    severity = (severity_map(df) if severity is None else severity).select(
        "macro_state", F.col("severity_score").alias("_score"), F.col("severity_level").alias("_level")
    )
    high = severity.where(F.col("_level") == "High").select("macro_state")
    to_high = (
        next_macro_probs(transitions, mapping)
        .join(high, "macro_state", "left_semi")
        .groupBy("micro_state")
        .agg(F.sum("probability").alias("_to_high"))
    )
    # Model states are few; the tables joined here hold one row per state.
    rows = (
        latest_window(df, station)
        .join(severity, "macro_state", "left")
        .join(to_high, "micro_state", "left")
        .withColumn("prob_high_next", F.coalesce("_to_high", F.lit(0.0)))
        .withColumn("current_level", F.coalesce("_level", F.lit("Unknown")))
        .withColumn(
            "risk_score",
            SEVERITY_WEIGHT * F.coalesce("_score", F.lit(0.0)) + NEXT_HIGH_WEIGHT * F.col("prob_high_next"),
        )
    )
    parts = [F.concat(F.lit("regime="), F.col("macro_state").cast("string"), F.lit(" ("), F.col("current_level"), F.lit(")"))]
    parts += [F.concat(F.lit(f"{k}="), two_decimals(F.col(c))) for k, c in measures.items()]
    parts.append(F.concat(F.lit("next-high-prob="), two_decimals(F.col("prob_high_next"))))
    return rows.select(
        station,
        "end_time",
        F.col("macro_state").cast("int").alias("macro_state"),
        severity_level(F.col("risk_score")).alias("risk_level"),
        *[F.col(c).alias(f"{k}_mean") for k, c in measures.items()],
        "risk_score",
        "prob_high_next",
        explain_parts(*parts).alias("explanation"),
    ).orderBy(F.desc("risk_score"), F.desc("prob_high_next"), station)


def monthly_regime_shares(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by, month, macro_state_name, count, share``; windows without an end time are left out."""
    counts = (
        df.withColumn("month", month_key(F.col("end_time")))
        .where(F.col("month").isNotNull())
        .groupBy(*by, "month", "macro_state_name")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return share_of_group(counts, [*by, "month"])


def monthly_share_pivot(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per month, one percent column per regime name, 0 where a regime is absent.

    Shares are of all windows of the month, those of regimes that are not in ``names`` included.
    """
    rows = df.withColumn("month", month_key(F.col("end_time"))).where(F.col("month").isNotNull())
    part = [F.count(F.when(F.col("macro_state_name") == n, 1)) / F.count(F.lit(1)) * 100.0 for n in names]
    return rows.groupBy("month").agg(*[F.round(p, 2).alias(n) for n, p in zip(names, part, strict=True)])


def dominant_regime_month(df: DataFrame) -> DataFrame:
    """The most frequent regime of each month with the month's mean wave and wind."""
    best = argmax_per_group(monthly_regime_shares(df), ["month"], "share", ["macro_state_name"])
    measures = _wave_wind(df)
    means = (
        df.withColumn("month", month_key(F.col("end_time")))
        .where(F.col("month").isNotNull())
        .groupBy("month")
        .agg(*[F.avg(c).alias(f"avg_{k}") for k, c in measures.items()])
    )
    return best.withColumnRenamed("share", "dominant_share").join(means, "month")


def dominant_regime_station_month(df: DataFrame, station: str = "station") -> DataFrame:
    best = argmax_per_group(
        monthly_regime_shares(df, [station]), [station, "month"], "share", ["macro_state_name"]
    )
    return best.withColumnRenamed("share", "dominant_share")


def _planning_rows(df: DataFrame, severity: DataFrame | None) -> DataFrame:
    severity = (severity_map(df) if severity is None else severity).select("macro_state", "severity_score", "severity_level")
    levels = severity.agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("macro_state").cast("int"), F.struct("severity_score", "severity_level")))
        )
    ).scalar()
    found = F.element_at(levels, F.col("macro_state").cast("int"))
    return (
        df.withColumn("month", month_key(F.col("end_time")))
        .where(F.col("month").isNotNull())
        .withColumn("_level", F.coalesce(found["severity_level"], F.lit("Unknown")))
        .withColumn("_score", F.coalesce(found["severity_score"], F.lit(0.0)))
    )


def _share(level: str) -> Column:
    return F.avg((F.col("_level") == level).cast("int"))


def planning_overall(df: DataFrame, severity: DataFrame | None = None) -> DataFrame:
    """Per month: severity shares in percent; recommended when at least 60 % of windows are Low."""
    months = _planning_rows(df, severity).groupBy("month").agg(
        _share("Low").alias("low"), _share("Medium").alias("med"), _share("High").alias("high"),
        F.avg("_score").alias("score"), F.count(F.lit(1)).alias("windows"),
    )
    return months.select(
        "month",
        F.round(F.col("low") * 100.0, 2).alias("low_share"),
        F.round(F.col("med") * 100.0, 2).alias("med_share"),
        F.round(F.col("high") * 100.0, 2).alias("high_share"),
        F.round("score", 3).alias("avg_severity"),
        "windows",
        F.when(F.col("low") >= LOW_SHARE_NEEDED, "Yes").otherwise("No").alias("recommended"),
    ).orderBy("month")


def planning_station(df: DataFrame, station: str = "station", severity: DataFrame | None = None) -> DataFrame:
    """Per station and month; recommended by both the rounded Low and High percentages."""
    months = _planning_rows(df, severity).groupBy(station, "month").agg(
        F.round(_share("Low") * 100.0, 2).alias("low_share"),
        F.round(_share("High") * 100.0, 2).alias("high_share"),
        F.round(F.avg("_score"), 3).alias("avg_severity"),
        F.count(F.lit(1)).alias("windows"),
    )
    good = (F.col("low_share") >= LOW_PERCENT_NEEDED) & (F.col("high_share") <= HIGH_PERCENT_ALLOWED)
    return months.withColumn("recommended", F.when(good, "Yes").otherwise("No")).orderBy(station, "month")


def sensor_health(
    df: DataFrame,
    station: str,
    timestamp: str,
    position: str,
    columns: Sequence[str],
    block_rows: int = BLOCK_ROWS,
    in_memory_rows: int = IN_MEMORY_ROWS,
) -> DataFrame:
    """Per station: missing, flat-line, spike and time-gap rates, a weighted score and a status.

    Medians are exact. While the largest station has at most ``in_memory_rows`` rows, stations are kept whole and one shuffle serves all
    rates; else medians are computed from rank brackets, so no long station is ordered in one task. ``df`` is read twice.
    """
    columns = present(df, columns)
    if not columns:
        raise ValueError("none of the columns to check is present")
    micros = to_micros(F.col(timestamp), is_zoneless(df, timestamp))
    base = df.select(station, position, micros.alias("_t"), *[F.col(c).cast("double").alias(c) for c in columns])
    largest = base.groupBy(station).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= in_memory_rows:
        rates = _health_whole(base, station, position, columns)
    else:
        rates = _health_blocks(base, station, position, columns, block_rows)
    # The order of the result is found by a pass of its own, over one row per station.
    scored = stage(rates, "health").na.fill(0.0, ["gap_rate"])
    penalty = sum((F.lit(w) * F.col(c) for c, w in HEALTH_WEIGHTS.items()), F.lit(0.0))
    scored = scored.withColumn("_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - penalty)))
    status = F.when(F.col("_score") >= HEALTH_GOOD, "Good").when(F.col("_score") >= HEALTH_WARNING, "Warning").otherwise("Critical")
    return scored.select(
        station,
        "rows",
        *[F.round(c, 4).alias(c) for c in HEALTH_WEIGHTS],
        F.round("_score", 4).alias("health_score"),
        status.alias("status"),
    ).orderBy("health_score", F.desc("missing_rate"), station)


def _is_spike(off: Column, mad: Column) -> Column:
    return F.try_divide(off, MAD_SCALE * mad) > SPIKE_Z


def _gap_rate(wide: Column, steps: Column, usual: Column) -> Column:
    # Three timestamps are needed, which is two steps.
    return F.when((steps >= 2) & (usual > 0), wide / steps).otherwise(0.0)


def _health_whole(base: DataFrame, station: str, position: str, columns: Sequence[str]) -> DataFrame:
    """The rates of stations that are whole in one task; a row without a position counts for the medians and spikes only."""
    placed = F.col("_placed")
    series, whole = Window.partitionBy(station, "_placed").orderBy(position), Window.partitionBy(station)
    at = {c: f"_c{i}" for i, c in enumerate(columns)}
    rows = base.repartition(F.col(station)).withColumn("_placed", F.col(position).isNotNull())

    def step(c: str) -> Column:
        return F.when(placed, F.col(c) - F.lag(c).over(series))

    def median(x: Column) -> Column:
        return F.percentile(F.when(~F.isnan(x), x), F.lit(0.5)).over(whole)

    rows = rows.withColumns({"_gap": step("_t"), **{f"{n}_step": step(c) for c, n in at.items()}})
    rows = rows.withColumns({"_usual": median(F.col("_gap").cast("double")), **{f"{n}_off": F.abs(F.col(c) - median(F.col(c))) for c, n in at.items()}})
    rows = rows.withColumns({f"{n}_mad": median(F.col(f"{n}_off")) for n in at.values()})
    counted = rows.groupBy(station).agg(
        F.count_if(placed).alias("rows"),
        F.count("_gap").alias("_steps"),
        F.first("_usual").alias("_usual"),
        F.count_if(F.col("_gap") > GAP_FACTOR * F.col("_usual")).alias("_wide"),
        *[F.count_if(placed & F.col(c).isNull()).alias(f"{n}_nulls") for c, n in at.items()],
        *[F.count(f"{n}_step").alias(f"{n}_steps") for n in at.values()],
        *[F.count_if(F.col(f"{n}_step") == 0).alias(f"{n}_flat") for n in at.values()],
        *[F.first(f"{n}_mad").alias(f"{n}_mad") for n in at.values()],
        *[F.count_if(_is_spike(F.col(f"{n}_off"), F.col(f"{n}_mad"))).alias(f"{n}_spikes") for n in at.values()],
    )
    known = F.col(station).isNotNull()

    def mean(rate: Callable[[str], Column]) -> Column:
        return sum((rate(n) for n in at.values()), F.lit(0.0)) / len(at)

    def spikes(n: str) -> Column:
        return F.when(known & (F.col(f"{n}_nulls") == 0) & (F.col(f"{n}_mad") > 1e-9), F.col(f"{n}_spikes") / F.col("rows")).otherwise(0.0)

    return counted.where("rows > 0").select(
        station,
        "rows",
        mean(lambda n: F.col(f"{n}_nulls") / F.col("rows")).alias("missing_rate"),
        mean(lambda n: F.when(F.col(f"{n}_steps") > 0, F.col(f"{n}_flat") / F.col(f"{n}_steps")).otherwise(0.0)).alias("flatline_rate"),
        mean(spikes).alias("spike_rate"),
        F.when(known, _gap_rate(F.col("_wide"), F.col("_steps"), F.col("_usual"))).alias("gap_rate"),
    )


def _health_blocks(base: DataFrame, station: str, position: str, columns: Sequence[str], block_rows: int) -> DataFrame:
    """The rates of stations of any length, cut into blocks; no station is ordered in one task."""
    stepped = stage(previous_values(base, [station], position, ["_t", *columns], block_rows), "stepped")

    def pairs(*values):
        return F.array(*[F.struct(F.lit(c).alias("column"), *[v(c) for v in values]) for c in columns])

    values = base.select(
        station, F.inline(pairs(lambda c: F.col(c).alias("value")))
    )
    middle = exact_quantiles(values, [station, "column"], "value", [0.5]).select(
        station, "column", F.col("q")[0].alias("_med"), F.col("n").alias("_known")
    )
    off = spread_join(values, middle, [station, "column"], ["value"]).select(
        station, "column", "_known", F.abs(F.col("value") - F.col("_med")).alias("_off")
    )
    # A column with a missing reading has no spike score, so its spread is not needed.
    spread = exact_quantiles(off, [station, "column"], "_off", [0.5]).select(
        station, "column", F.col("q")[0].alias("_mad")
    )
    spikes = (
        spread_join(off, spread, [station, "column"], ["_off"])
        .groupBy(station, "column")
        .agg(
            F.first("_known").alias("_known"),
            F.first("_mad").alias("_mad"),
            F.sum(_is_spike(F.col("_off"), F.col("_mad")).cast("int")).alias("_spikes"),
        )
    )
    shape = stepped.groupBy(station).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.col(c).isNull().cast("int")).alias(f"{c}__null") for c in columns],
        *[F.count(F.col(c) - F.col(f"prev_{c}")).alias(f"{c}__steps") for c in columns],
        *[F.sum((F.col(c) - F.col(f"prev_{c}") == 0).cast("int")).alias(f"{c}__flat") for c in columns],
    )
    per_column = shape.select(
        station,
        "rows",
        F.inline(pairs(
            lambda c: F.col(f"{c}__null").alias("nulls"),
            lambda c: F.col(f"{c}__steps").alias("steps"),
            lambda c: F.col(f"{c}__flat").alias("flat"),
        )),
    ).join(spikes, [station, "column"], "left")
    usable = (F.col("nulls") == 0) & (F.col("_mad") > 1e-9)
    rates = per_column.groupBy(station, "rows").agg(
        F.avg(F.col("nulls") / F.col("rows")).alias("missing_rate"),
        F.avg(F.when(F.col("steps") > 0, F.col("flat") / F.col("steps")).otherwise(0.0)).alias("flatline_rate"),
        F.avg(F.when(usable, F.col("_spikes") / F.col("rows")).otherwise(0.0)).alias("spike_rate"),
    )
    steps = stepped.where(F.col("prev__t").isNotNull()).select(station, (F.col("_t") - F.col("prev__t")).alias("_gap"))
    usual = exact_quantiles(steps, [station], "_gap", [0.5]).select(
        station, F.col("q")[0].alias("_usual"), F.col("n").alias("_steps")
    )
    gaps = (
        steps.groupBy(station, "_gap").agg(F.count(F.lit(1)).alias("_c"))
        .join(usual, station)
        .groupBy(station)
        .agg(
            F.sum(F.when(F.col("_gap") > GAP_FACTOR * F.col("_usual"), F.col("_c")).otherwise(0)).alias("_wide"),
            F.first("_steps").alias("_steps"),
            F.first("_usual").alias("_usual"),
        )
        .select(station, _gap_rate(F.col("_wide"), F.col("_steps"), F.col("_usual")).alias("gap_rate"))
    )
    return rates.join(gaps, station, "left")


def dashboard_kpis(df: DataFrame) -> DataFrame:
    """One row: windows, distinct micro states and macro names, mean window length in hours."""
    return df.agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_distinct("micro_state").alias("micro_states"),
        F.count_distinct("macro_state_name").alias("macro_regimes"),
        F.avg("duration_hours").alias("avg_duration_hr"),
    )


def anomaly_topk(df: DataFrame, error: str, k: int = 10, tie: Sequence[str] = ("station", "end_idx")) -> DataFrame:
    return df.orderBy(F.desc(error), *tie).limit(k)


def error_summary(df: DataFrame, error: str) -> DataFrame:
    """Mean, median and 95th percentile."""
    middle = exact_quantiles(df, [], error, [0.5, 0.95]).select("q").scalar()
    return df.agg(F.avg(error).alias("mean")).select("mean", middle[0].alias("median"), middle[1].alias("p95"))
