"""Comparison tables over models and experiments.

Metrics are long: ``experiment_id, model, metric, value``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metrics of each silhouette in order of preference, and the compared columns.
SILHOUETTES = {
    "exact": ("silhouette_post", "silhouette", "silhouette_embed"),
    "squared": ("silhouette_squared_post", "silhouette_squared", "silhouette_squared_embed"),
    "sampled": ("silhouette_sampled_post", "silhouette_sampled", "silhouette_sampled_embed"),
}
COMPARED = ("silhouette", "bic", "avg_duration", "transition_entropy")
COMPARATIVE_SCHEMA = T.StructType(
    [T.StructField("experiment_id", T.StringType()), T.StructField("model", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in COMPARED]
)


def _metric(name: str) -> Column:
    return F.max(F.when(F.col("metric") == name, F.col("value")))


def comparative_rows(metrics: DataFrame, entropies: DataFrame, silhouette: str = "exact") -> DataFrame:
    """One row per experiment and model known to either input.

    ``entropies`` is ``experiment_id, model, transition_entropy``. Only metrics of the one kind of ``silhouette`` are
    compared; runs that measured the other kind have none.
    """
    wide = metrics.groupBy("experiment_id", "model").agg(
        F.coalesce(*[_metric(m) for m in SILHOUETTES[silhouette]]).alias("silhouette"),
        _metric("bic").alias("bic"),
        _metric("mean_regime_duration").alias("avg_duration"),
    )
    return wide.join(entropies, ["experiment_id", "model"], "full").select(
        "experiment_id", "model", *COMPARED
    )


def comparative_mean_by_model(rows: DataFrame) -> DataFrame:
    return rows.groupBy("model").agg(*[F.avg(c).alias(c) for c in COMPARED])


def best_model(metrics: DataFrame, order: str = "model", silhouette: str = "exact") -> DataFrame:
    """``experiment_id, model``: the highest preferred silhouette of one kind, the first by ``order`` on ties.

    An experiment without a silhouette of this kind names its first model.
    """
    scored = metrics.groupBy("experiment_id", "model", *([order] if order != "model" else [])).agg(
        F.coalesce(*[_metric(m) for m in SILHOUETTES[silhouette]]).alias("score")
    )
    rank = F.struct(F.col("score").isNull().alias("unscored"), (-F.col("score")).alias("score"), F.col(order).alias("at"), F.col("model").alias("model"))
    return scored.groupBy("experiment_id").agg(F.min(rank).alias("_r")).select("experiment_id", F.col("_r.model").alias("model"))


def metrics_table(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per experiment and model, one column per metric name; of repeated entries the largest."""
    return metrics.groupBy("experiment_id", "model").pivot("metric", list(names)).agg(F.max("value"))


def union_experiments(spark: SparkSession, root: str) -> DataFrame:
    """Every ``<root>/<experiment>/comparative_rows.csv`` as one table."""
    try:
        return spark.read.csv(f"{root}/*/comparative_rows.csv", header=True, schema=COMPARATIVE_SCHEMA)
    except AnalysisException as missing:
        raise FileNotFoundError(f"no comparative_rows.csv below {root}") from missing


def experiment_record(
    metrics: DataFrame, experiment_id: str, settings: dict, notes: str = "", extra: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row describing a run; reports given in ``extra`` become JSON columns.

    Reports are small tables (rows per model, state or column), never windows.
    """
    mine = metrics.where(F.col("experiment_id") == experiment_id)
    chosen = best_model(mine).select("model").scalar()
    entries = mine.agg(F.to_json(F.collect_list(F.struct("model", "metric", "value")))).scalar()
    columns = {
        "experiment_id": F.lit(experiment_id),
        "created_at_utc": F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"),
        "notes": F.lit(notes),
        "selected_model": F.coalesce(chosen, F.lit("unknown")),
        "config": F.lit(json.dumps(settings)),
        "model_metrics": entries,
    }
    for name, table in (extra or {}).items():
        columns[name] = table.agg(F.to_json(F.collect_list(F.struct(*table.columns)))).scalar()
    return metrics.sparkSession.range(1).select(*[c.alias(n) for n, c in columns.items()])


def append_record(record: DataFrame, path: str) -> None:
    record.write.mode("append").json(path)
