"""Linear embeddings of windows and how well they reconstruct them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 3


@dataclass
class LinearBasis:
    """Mean and orthonormal components of a fitted projection; at most d x k numbers."""

    mean: list[float]
    components: list[list[float]]

    def as_table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(i, c) for i, c in enumerate(self.components)], "component int, weights array<double>"
        )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _centred(vector: str, mean: Column) -> Column:
    return F.zip_with(F.col(vector).cast("array<double>"), mean, lambda x, m: x - m)


def fit_basis(df: DataFrame, vector: str, k: int) -> LinearBasis:
    """Principal components; ``k`` is cut to the number of dimensions."""
    size = df.agg(F.max(F.size(vector))).first()[0]
    if size is None:
        raise ValueError("no rows to fit a projection on")
    averages = df.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i")
    mean = [float(r["m"]) for r in averages.collect()]
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    model = PCA(k=min(int(k), int(size)), inputCol="v", outputCol="z").fit(rows)
    return LinearBasis(mean, [[float(x) for x in column] for column in model.pc.toArray().T])


def _literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def project(df: DataFrame, vector: str, basis: LinearBasis, name: str = "latent") -> DataFrame:
    """Adds the coordinates of the centred vector along each component."""
    centred = df.withColumn("_c", _centred(vector, _literal(basis.mean)))
    return centred.withColumn(
        name, F.array(*[_dot(F.col("_c"), _literal(c)) for c in basis.components])
    ).drop("_c")


def pca_projection(df: DataFrame, vector: str, k: int = 2, prefix: str = "pc") -> DataFrame:
    """Adds ``pc1 .. pck``; needs at least three rows."""
    if df.limit(MIN_ROWS).count() < MIN_ROWS:
        raise ValueError(f"a projection needs at least {MIN_ROWS} rows")
    basis = fit_basis(df, vector, k)
    return project(df, vector, basis, "_z").withColumns(
        {f"{prefix}{i + 1}": F.col("_z")[i] for i in range(len(basis.components))}
    ).drop("_z")


def latent_embedding(df: DataFrame, vector: str, dimensions: int, name: str = "latent") -> tuple[DataFrame, LinearBasis]:
    """A low-dimensional embedding per window and the basis that gives it."""
    basis = fit_basis(df, vector, dimensions)
    return project(df, vector, basis, name), basis


def standardize_array(df: DataFrame, vector: str, name: str) -> DataFrame:
    """z-scores of every position of an array column."""
    parts = df.select(F.posexplode(vector).alias("i", "x"))
    moments = parts.groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    table = moments.agg(
        F.array_sort(F.collect_list(F.struct("i", "m", F.when(F.col("s") == 0, 1.0).otherwise(F.col("s")).alias("s"))))
    ).scalar()
    return (
        df.withColumn("_moments", table)
        .withColumn(name, F.zip_with(F.col(vector), "_moments", lambda x, t: (x - t["m"]) / t["s"]))
        .drop("_moments")
    )


def latent_projection(df: DataFrame, latent: str) -> DataFrame:
    """Adds ``latent_pc1, latent_pc2`` of the standardised embedding."""
    return pca_projection(standardize_array(df, latent, "_scaled"), "_scaled", 2, "latent_pc").drop("_scaled")


def reconstruction_error(
    df: DataFrame, vector: str, components: DataFrame, mean: Column | None = None, name: str = "reconstruction_error"
) -> DataFrame:
    """Adds the mean squared difference between a vector and its reconstruction.

    ``components`` is ``component, weights`` (orthonormal rows), one row per kept dimension.
    """
    table = components.agg(F.array_sort(F.collect_list(F.struct("component", "weights")))).scalar()
    x = _centred(vector, mean) if mean is not None else F.col(vector).cast("array<double>")
    back = F.aggregate(
        F.transform("_basis", lambda c: c["weights"]),
        F.transform(F.col("_x"), lambda v: F.lit(0.0)),
        lambda total, w: F.zip_with(total, w, lambda t, wi: t + _dot(F.col("_x"), w) * wi),
    )
    gap = F.zip_with(F.col("_x"), F.col("_back"), lambda a, b: (a - b) * (a - b))
    return (
        df.withColumns({"_x": x, "_basis": table})
        .withColumn("_back", back)
        .withColumn(name, F.aggregate(gap, F.lit(0.0), lambda t, g: t + g) / F.size("_x"))
        .drop("_x", "_basis", "_back")
    )


def reconstruction_mse(df: DataFrame, error: str = "reconstruction_error") -> DataFrame:
    return df.agg(F.avg(error).alias("reconstruction_mse"))
