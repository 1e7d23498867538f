"""Sources, sinks and row-level expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import (
    DIRECTIONS, GRID_12H, NUMERIC, chain, query, rounded, scratch, settle, table, telemetry, telemetry_sql,
)
from tidemark.functions.scalars import (
    encode_direction, explain_parts, first_mean_column, lookup_default, sentinel_to_null, severity_level, two_decimals,
)
from tidemark.functions.times import duration_hours, month_key
from tidemark.operators.resample import resample_mean
from tidemark.sources.readers import (
    align_schema, ingest_clean, model_features, normalize_headers, scan_dataset, scan_pruned_capped, select_features,
)
from tidemark.sources.writers import export_report, write_processed

ALL = [*NUMERIC, *DIRECTIONS]
SENTINEL_SQL = "CASE WHEN {c} IN (99, 999, 9999, 99999) THEN NULL ELSE {c} END AS {c}"


@query("scan_csv_parquet", f"SELECT o_orderkey, o_orderpriority, {rounded('o_totalprice')}, o_orderdate FROM orders")
def scan_csv_parquet(spark, sf_dir):
    path = scratch(spark, "orders") + ".csv"
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"]
    source = scan_dataset(spark, f"{sf_dir}/orders.parquet").select(*columns)
    source.write.option("header", True).csv(path)
    return scan_dataset(spark, path, source.schema)


@query("ingest_clean", f"""SELECT CAST(o_custkey AS VARCHAR) AS STATION, o_orderdate AS DATE, {rounded("o_totalprice AS PRICE")}
FROM orders WHERE o_orderstatus <> 'P'""")
def ingest_clean_query(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("STATION"), text.alias("DATE"), F.col("o_totalprice").cast("string").alias("PRICE")
    )
    return ingest_clean(raw, "DATE", "STATION", ["PRICE"])


@query("scan_pruned_capped", f"""SELECT event_id, ts, {rounded("value")} FROM events
ORDER BY ts DESC, event_id DESC LIMIT 500""")
def scan_pruned_capped_query(spark, sf_dir):
    return scan_pruned_capped(
        table(spark, sf_dir, "events"), ["event_id", "ts", "value", "absent"], 500, ["ts", "event_id"]
    )


@query("normalize_headers", f"SELECT 'STATION_0' AS STATION, o_orderdate AS DATE, {rounded('o_totalprice AS Price')} FROM orders")
def normalize_headers_query(spark, sf_dir):
    odd = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("﻿ date_ "), F.col("o_totalprice").alias(" Price")
    )
    return normalize_headers(odd, "STATION", "DATE")


@query("align_schema", f"""SELECT o_orderkey, {rounded("o_totalprice AS WIND_SPEED")}, CAST(NULL AS DOUBLE) AS WAVE_HGT
FROM orders""")
def align_schema_query(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("WIND_SPEED"))
    return align_schema(raw, ["WIND_SPEED", "WAVE_HGT"])


@query("select_features", chain(telemetry_sql()) + f"""SELECT event_id, {rounded(*NUMERIC,
    "sin(radians(WIND_DIR)) AS WIND_DIR_SIN", "cos(radians(WIND_DIR)) AS WIND_DIR_COS")} FROM telemetry""")
def select_features_query(spark, sf_dir):
    raw = telemetry(spark, sf_dir)
    numeric = select_features(raw, [*NUMERIC, "DEW_PT_TEMP"], "STATION")
    encoded = encode_direction(raw, DIRECTIONS)
    return encoded.select("event_id", *model_features(numeric, DIRECTIONS, encoded.columns))


@query("write_processed", chain(*GRID_12H) + f"SELECT STATION, DATE, pos, {rounded(*NUMERIC)} FROM aligned")
def write_processed_query(spark, sf_dir):
    rows = sentinel_to_null(telemetry(spark, sf_dir), ALL)
    path = scratch(spark, "processed")
    write_processed(resample_mean(rows, "STATION", "DATE", NUMERIC, (), "12h"), path, "parquet", "STATION", 4)
    return spark.read.parquet(path).select("STATION", "DATE", "pos", *NUMERIC)


@query("export_report", f"SELECT event_type, count(*) AS n, {rounded('avg(value) AS mean_value')} FROM events GROUP BY 1")
def export_report_query(spark, sf_dir):
    report = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    )
    path = scratch(spark, "report")
    export_report(settle(report), path)
    return spark.read.schema("event_type string, n long, mean_value double").csv(path, header=True)


@query("sentinel_to_null", chain(telemetry_sql()) + "SELECT event_id, " + rounded(*[SENTINEL_SQL.format(c=c) for c in ALL]) + " FROM telemetry")
def sentinel_query(spark, sf_dir):
    return sentinel_to_null(telemetry(spark, sf_dir), [*ALL, "absent"]).select("event_id", *ALL)


@query("encode_direction", chain(telemetry_sql()) + f"""SELECT event_id,
  {rounded("sin(radians(WIND_DIR)) AS WIND_DIR_SIN", "cos(radians(WIND_DIR)) AS WIND_DIR_COS")} FROM telemetry""")
def encode_direction_query(spark, sf_dir):
    return encode_direction(telemetry(spark, sf_dir), DIRECTIONS).select("event_id", "WIND_DIR_SIN", "WIND_DIR_COS")


@query("duration_hours", f"""SELECT l_orderkey, l_linenumber, l_partkey,
  {rounded("(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 AS duration_hours")}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def duration_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        duration_hours(F.col("o_orderdate"), F.col("l_shipdate")).alias("duration_hours"),
    )


@query("month_key", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def month_query(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(month_key(F.col("o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("severity_level", """SELECT event_id, CASE WHEN value / 150 >= 0.66 THEN 'High' WHEN value / 150 >= 0.33 THEN 'Medium'
  ELSE 'Low' END AS severity_level FROM events""")
def severity_query(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", severity_level(F.col("value") / 150).alias("severity_level"))


@query("first_mean_column", f"SELECT event_id, {rounded('value * 2 AS wind')} FROM events")
def first_mean_query(spark, sf_dir):
    named = table(spark, sf_dir, "events").select(
        "event_id", F.col("value").alias("WIND_SPEED_s6_mean"), (F.col("value") * 2).alias("WIND_SPEED_s24_mean"),
        (F.col("value") * 3).alias("WIND_SPEED_s24_std"),
    )
    return named.select("event_id", F.col(first_mean_column(named.columns, "WIND_SPEED")).alias("wind"))


@query("station_filter", f"SELECT event_id, ts, {rounded('value')} FROM events WHERE event_type = 'purchase'")
def station_filter_query(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.where(F.col("event_type") == "purchase").select("event_id", "ts", "value")


@query("format_explanation", """SELECT event_id, 'regime=' || (event_id % 3) || ' | wind=' || printf('%.2f', value) || ' | p=' ||
  printf('%.2f', CAST(event_id % 97 AS DOUBLE) / 100) AS explanation FROM events""")
def explanation_query(spark, sf_dir):
    text = explain_parts(
        F.concat(F.lit("regime="), (F.col("event_id") % 3).cast("string")),
        F.concat(F.lit("wind="), two_decimals(F.col("value"))),
        F.concat(F.lit("p="), two_decimals((F.col("event_id") % 97) / 100.0)),
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("explanation"))


@query("lookup_default", """SELECT vec_id, CAST(CASE label WHEN 0 THEN 10 WHEN 3 THEN 11 ELSE label END AS INTEGER) AS macro,
  CASE label WHEN 0 THEN 'calm' ELSE 'Regime ' || label END AS name FROM embeddings""")
def lookup_query(spark, sf_dir):
    name = F.when(F.col("label") == 0, "calm").otherwise(F.concat(F.lit("Regime "), F.col("label").cast("string")))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", lookup_default(F.col("label"), {0: 10, 3: 11}).alias("macro"), name.alias("name")
    )
