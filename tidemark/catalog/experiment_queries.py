"""Comparison tables. An experiment is a customer segment's order priority, a model an order status."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import chain, query, rounded, scratch, settle, table
from tidemark.operators import experiments
from tidemark.session import stage

# The metric each order status lacks, so that fallbacks and outer joins are exercised.
METRICS = ["silhouette_post", "silhouette", "silhouette_embed", "bic", "mean_regime_duration"]


def metrics(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderpriority": "experiment_id", "o_orderstatus": "model"})
    means = orders.groupBy("experiment_id", "model").agg(
        F.avg(F.col("o_totalprice") / 1000).alias("price"), F.avg("o_custkey").alias("customer"), F.count(F.lit(1)).alias("n")
    )
    present = F.when(F.col("model") == "F", "silhouette_post").when(F.col("model") == "O", "silhouette").otherwise("silhouette_embed")
    rows = F.array(
        F.struct(present.alias("metric"), F.col("price").alias("value")),
        F.struct(F.lit("bic").alias("metric"), F.col("customer").alias("value")),
        F.struct(F.lit("mean_regime_duration").alias("metric"), F.col("n").cast("double").alias("value")),
    )
    return means.select("experiment_id", "model", F.inline(rows))


def entropies(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    other = F.when(F.col("o_orderstatus") == "O", "hmm").otherwise(F.col("o_orderstatus"))
    return orders.groupBy(F.col("o_orderpriority").alias("experiment_id"), other.alias("model")).agg(
        F.avg(F.col("o_custkey") / 100).alias("transition_entropy")
    )


def names_of(rows) -> list[str]:
    """The experiments of a comparison, one row each."""
    return [r["experiment_id"] for r in rows.select("experiment_id").distinct().orderBy("experiment_id").collect()]


BASE = (
    """means AS (SELECT o_orderpriority AS experiment_id, o_orderstatus AS model, avg(o_totalprice / 1000) AS price, avg(o_custkey) AS customer,
  count(*) AS n FROM orders GROUP BY 1, 2)""",
    """entropies AS (SELECT o_orderpriority AS experiment_id, CASE o_orderstatus WHEN 'O' THEN 'hmm' ELSE o_orderstatus END AS model,
  avg(o_custkey / 100) AS transition_entropy FROM orders GROUP BY 1, 2)""",
    """comparative AS (SELECT experiment_id, model, price AS silhouette, customer AS bic, CAST(n AS DOUBLE) AS avg_duration, transition_entropy
  FROM means FULL JOIN entropies USING (experiment_id, model))""",
)
VALUES = rounded("silhouette", "bic", "avg_duration", "transition_entropy")


@query("comparative_rows", chain(*BASE) + f"SELECT experiment_id, model, {VALUES} FROM comparative")
def comparative_query(spark, sf_dir):
    return experiments.comparative_rows(metrics(spark, sf_dir), entropies(spark, sf_dir))


@query("comparative_mean_by_model", chain(*BASE) + "SELECT model, " + rounded(
    *[f"avg({c}) AS {c}" for c in ("silhouette", "bic", "avg_duration", "transition_entropy")]) + " FROM comparative GROUP BY 1")
def mean_query(spark, sf_dir):
    return experiments.comparative_mean_by_model(comparative_query(spark, sf_dir))


@query("best_model", chain(*BASE) + """SELECT experiment_id, model FROM
(SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY price DESC, model) AS r FROM means) WHERE r = 1""")
def best_query(spark, sf_dir):
    return experiments.best_model(metrics(spark, sf_dir))


@query("metrics_table", chain(*BASE) + "SELECT experiment_id, model, " + rounded(
    "CASE WHEN model = 'F' THEN price END AS silhouette_post", "CASE WHEN model = 'O' THEN price END AS silhouette",
    "CASE WHEN model = 'P' THEN price END AS silhouette_embed", "customer AS bic", "n AS mean_regime_duration") + " FROM means")
def metrics_query(spark, sf_dir):
    return experiments.metrics_table(metrics(spark, sf_dir), METRICS)


@query("union_experiments", chain(*BASE) + f"SELECT experiment_id, model, {VALUES} FROM comparative")
def union_query(spark, sf_dir):
    root = scratch(spark, "experiments")
    rows = stage(settle(comparative_query(spark, sf_dir)), "comparative")
    for number, name in enumerate(names_of(rows)):
        mine = rows.where(F.col("experiment_id") == name)
        mine.write.option("header", True).csv(f"{root}/{number}/comparative_rows.csv")
    return experiments.union_experiments(spark, root)


@query("experiment_record", chain(*BASE) + """SELECT experiment_id, model AS selected_model, 'check' AS notes, '{"width": "1d"}' AS config FROM
(SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY price DESC, model) AS r FROM means)
WHERE r = 1""")
def record_query(spark, sf_dir):
    path = scratch(spark, "records")
    rows, compared = stage(metrics(spark, sf_dir), "metrics"), stage(comparative_query(spark, sf_dir), "comparative")
    for name in names_of(rows):
        record = experiments.experiment_record(rows, name, {"width": "1d"}, "check", {"comparison": compared})
        experiments.append_record(record, path)
    return spark.read.json(path).select("experiment_id", "selected_model", "notes", "config")
