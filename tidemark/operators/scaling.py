"""Population standardisation with parameters kept as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scaler_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, mean, scale``; the scale of a constant column is 1."""
    moments = df.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
    )
    long = moments.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.mean").alias("mean"), F.col(f"`{c}`.std").alias("_std")) for c in columns]
            )
        )
    )
    tiny = F.greatest(F.lit(1.0), F.abs("mean")) * 1e-12
    return long.select("column", "mean", F.when(F.col("_std") <= tiny, 1.0).otherwise(F.col("_std")).alias("scale"))


def apply_scaler(df: DataFrame, columns: Sequence[str], params: DataFrame) -> DataFrame:
    """z-scores in place, from stored parameters (one row per column)."""
    table = params.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("mean", "scale")))).alias("m")
    ).scalar()
    return df.withColumns({c: (F.col(c) - table[c]["mean"]) / table[c]["scale"] for c in columns})


def standardize(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """z-scores and the parameters used."""
    params = scaler_params(df, columns)
    return apply_scaler(df, columns, params), params


def feature_array(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Columns packed, in the given order, into one ``array<double>``."""
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in columns]))
