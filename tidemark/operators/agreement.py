"""Cluster quality and agreement of labelings. Vectors are ``array<double>`` or ``array<float>``."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stage

TILE_POINTS = 512
JUDGED = 2_000  # points that a sampled silhouette judges
LEAST_JUDGED = 50  # of them in each cluster
SALTS = 16
OWN_POINTS = 4_096  # points that a task of the exact silhouette holds, about
HELD_CLUSTERS = 1_024  # clusters whose sums it holds
CANCELLED = 1e-6  # share of the squared lengths below which a squared distance is computed anew
DIFFERENCES = 32_768  # such pairs at a time


def squared_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``label, centroid, n``: mean vector per label."""
    parts = df.select(F.col(label).alias("label"), F.posexplode(vector).alias("_i", "_x"))
    means = parts.groupBy("label", "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"), F.count(F.lit(1)).alias("_n"))
    return means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias("centroid"),
        F.max("_n").alias("n"),
    )


def nearest_centroid(df: DataFrame, vector: str, centers: DataFrame, name: str = "nearest") -> DataFrame:
    """Adds the label of the closest centroid (the smaller label on ties).

    The centroids, one per cluster of a model, reach the rows as a scalar subquery.
    """
    table = centers.agg(F.array_sort(F.collect_list(F.struct("label", "centroid")))).scalar()
    distances = F.transform(
        "_centers", lambda c: F.struct(squared_distance(F.col(vector), c["centroid"]).alias("d"), c["label"].alias("label"))
    )
    return df.withColumn("_centers", table).withColumn(name, F.array_min(distances)["label"]).drop("_centers")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all of ``b``; close pairs, where products lose digits, by their differences."""
    with np.errstate(all="ignore"):
        shift = a.mean(axis=0)
        shift[~np.isfinite(shift)] = 0.0
        x, y = a - shift, b - shift
        scale = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)
        squares = scale - 2.0 * (x @ y.T)
        i, j = np.nonzero(~(squares > CANCELLED * scale) | ~np.isfinite(squares))
        for low in range(0, len(i), DIFFERENCES):
            p, q = i[low : low + DIFFERENCES], j[low : low + DIFFERENCES]
            squares[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1)
        return np.sqrt(squares)


def _packed(rows: DataFrame, tile_points: int) -> DataFrame:
    """``points, labels, vectors, width``: rows of up to ``tile_points`` points each, their vectors as bytes of the type they have."""
    kind = "<f4" if rows.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = rows.withColumn("v", F.col("v").cast("array<float>" if kind == "<f4" else "array<double>"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, tile_points):
                part = batch.slice(start, tile_points)
                points, labels, vectors = (part.column(i) for i in range(3))
                width = len(vectors[0]) if vectors[0].is_valid else -1
                if vectors.null_count or set(vectors.value_lengths().to_pylist()) != {width}:
                    raise ValueError("all vectors must have the same length")
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), c) for c in (points, labels)]
                columns = [*lists, pa.array([flat.tobytes()], pa.binary()), pa.array([width], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["points", "labels", "vectors", "width"])

    kinds = rows.schema["point"].dataType.simpleString()
    return rows.select("point", "label", "v").mapInArrow(pack, f"points array<{kinds}>, labels array<int>, vectors binary, width int")


def _summed_distances(rows: DataFrame, total: int, tile_points: int) -> DataFrame:
    """``point, label, cluster, total``: distances from each of ``rows`` (point, label, v) to the members of each cluster, summed up in parts.

    Tiles are stored once and dealt to tasks once. A task holds its own points and reads all stored tiles one after the other, so
    what is written grows with the points, not with their pairs, and what is held does not grow.
    """
    spark = rows.sparkSession
    kind = "<f4" if rows.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    tiles = stage(_packed(rows, tile_points), "tiles")
    parts = max(math.ceil(total / OWN_POINTS), min(math.ceil(total / tile_points), 2 * spark.sparkContext.defaultParallelism))
    mine, theirs = tiles.repartition(max(1, parts)).rdd.glom(), tiles.coalesce(1).rdd

    def matrix(tile) -> np.ndarray:
        return np.frombuffer(tile["vectors"], kind).astype(float).reshape(len(tile["labels"]), tile["width"])

    def sums(pairs: Iterator) -> Iterator[tuple]:
        known, vectors, totals = [], None, {}

        def result() -> Iterator[tuple]:
            for cluster, values in totals.items():
                for (point, label), value in zip(known, values.tolist(), strict=True):
                    yield point, label, cluster, value
            totals.clear()

        for own, tile in pairs:  # ``own`` is the same list of tiles all along
            if not own:
                return
            if vectors is None:
                known = [pair for t in own for pair in zip(t["points"], t["labels"], strict=True)]
                vectors = np.concatenate([matrix(t) for t in own])
            other = matrix(tile)
            clusters, member = np.unique(tile["labels"], return_inverse=True)
            onehot = np.zeros((len(other), len(clusters)))
            onehot[np.arange(len(other)), member] = 1.0
            found = np.concatenate([_distances(vectors[low : low + TILE_POINTS], other) @ onehot for low in range(0, len(vectors), TILE_POINTS)])
            for c, values in zip(clusters.tolist(), found.T, strict=True):
                totals[c] = totals[c] + values if c in totals else values.copy()
            if len(totals) > HELD_CLUSTERS:
                yield from result()
        yield from result()

    kinds = {"point": rows.schema["point"].dataType, "label": T.IntegerType(), "cluster": T.IntegerType(), "total": T.DoubleType()}
    schema = T.StructType([T.StructField(*field) for field in kinds.items()])
    return spark.createDataFrame(mine.cartesian(theirs).mapPartitions(sums), schema, verifySchema=False)


def silhouette_exact(df: DataFrame, point: str, label: str, vector: str, tile_points: int = TILE_POINTS) -> DataFrame:
    """One row ``silhouette``: mean Euclidean silhouette, -1 with fewer than two labels.

    Every point has to be compared with every other, so the work is quadratic by definition; what is stored,
    shuffled and held by a task is not. Points are compared in tiles of up to ``tile_points``. Rows with a null label
    count for nothing. Use ``silhouette_fast`` for tables where quadratic work is out of the question.
    """
    rows = df.select(F.col(point).alias("point"), F.col(label).cast("int").alias("label"), F.col(vector).alias("v")).where("label IS NOT NULL")
    sums = _summed_distances(rows, rows.count(), tile_points).groupBy("point", "label", "cluster").agg(F.sum("total").alias("total"))
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.col("label").alias("cluster"), "n")
    own = F.col("cluster") == F.col("label")
    per_point = (
        sums.join(sizes, "cluster")
        .groupBy("point", "label")
        .agg(
            F.max(F.when(own, F.col("n"))).alias("n"),
            F.max(F.when(own, F.col("total"))).alias("inside"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
        )
        .withColumn("a", F.try_divide("inside", F.col("n") - 1))
    )
    widest = F.greatest("a", "b")
    score = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), widest), F.lit(0.0)))
    return per_point.agg(F.coalesce(F.avg(F.when(F.col("b").isNotNull(), score)), F.lit(-1.0)).alias("silhouette"))


def silhouette_fast(df: DataFrame, label: str, vector: str) -> float:
    """Squared-Euclidean silhouette in linear work; a different number from ``silhouette_exact``."""
    if df.select(label).distinct().limit(2).count() < 2:
        return -1.0
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"), F.col(label).cast("int").alias("prediction"))
    return float(ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(rows))


def silhouette_sampled(df: DataFrame, point: str, label: str, vector: str, judged: int = JUDGED) -> DataFrame:
    """One row ``silhouette_sampled, standard_error, judged``: the Euclidean silhouette from judged points, in linear work.

    Every cluster has its share of ``judged`` points, at least ``LEAST_JUDGED`` or all it has, chosen by a hash of ``point``. They, a bounded number,
    are sent to all tasks and compared with all rows, so each judged point has its exact silhouette; the mean weighs clusters by
    their sizes, and the standard error comes from the spread inside clusters (0 where all points are judged). Rows with a null label or
    vector are ignored. -1 with fewer than two labels.
    """
    rows = df.select(F.col(point).alias("point"), F.col(label).cast("int").alias("label"), F.col(vector).cast("array<double>").alias("v")).dropna()
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row per cluster
    spark = df.sparkSession
    if len(sizes) < 2:
        return spark.range(1).select(F.lit(-1.0).alias("silhouette_sampled"), F.lit(0.0).alias("standard_error"), F.lit(0).cast("long").alias("judged"))
    clusters = sorted(sizes)
    total = sum(sizes.values())
    quota = {c: min(n, max(LEAST_JUDGED, math.ceil(judged * n / total))) for c, n in sizes.items()}
    limit = F.element_at(F.create_map(*(F.lit(x) for c in clusters for x in (c, quota[c]))), F.col("label"))
    chosen = rows
    for salt in (F.pmod(F.xxhash64(F.lit(1), "point"), F.lit(SALTS)), F.lit(0)):
        by = Window.partitionBy("label", salt).orderBy(F.xxhash64("point"), "point")
        chosen = chosen.withColumn("place", F.row_number().over(by)).where(F.col("place") <= limit)
    sample = chosen.select("label", "v").collect()  # at most ``judged`` and LEAST_JUDGED + 1 a cluster
    marks = np.array([r["v"] for r in sample])
    own = np.searchsorted(clusters, [r["label"] for r in sample])
    sent = spark.sparkContext.broadcast(marks)

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a task: summed distances from each judged point to each cluster, as one row."""
        marks, sums = sent.value, np.zeros((len(sent.value), len(clusters)))
        for batch in batches:
            theirs = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            member = np.searchsorted(clusters, batch.column("label").to_numpy(zero_copy_only=False))
            for start in range(0, len(theirs), 512):
                block, into = theirs[start : start + 512], member[start : start + 512]
                onehot = np.zeros((len(block), len(clusters)))
                onehot[np.arange(len(block)), into] = 1.0
                for low in range(0, len(marks), 512):
                    apart = np.sqrt(((marks[low : low + 512, None] - block[None]) ** 2).sum(axis=2))
                    sums[low : low + 512] += apart @ onehot
        i, c = np.meshgrid(np.arange(len(marks)), np.arange(len(clusters)), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(c.ravel()), pa.array(sums.ravel())], ["i", "c", "total"])

    summed = rows.select("label", "v").mapInArrow(distances, "i bigint, c bigint, total double").groupBy("i", "c").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros((len(marks), len(clusters)))
    for r in summed:
        sums[r["i"], r["c"]] = r["total"]
    n = np.array([sizes[c] for c in clusters], float)
    at = np.arange(len(marks))
    inside = sums[at, own] / np.maximum(n[own] - 1, 1)
    others = sums / n
    others[at, own] = np.inf
    apart = others.min(axis=1)
    widest = np.maximum(inside, apart)
    score = np.where((n[own] == 1) | (widest == 0), 0.0, (apart - inside) / np.where(widest == 0, 1.0, widest))
    share = n / n.sum()
    of = [score[own == c] for c in range(len(clusters))]
    mean = sum(w * x.mean() for w, x in zip(share, of, strict=True))
    error = math.sqrt(sum(w * w * (x.var(ddof=1) if len(x) > 1 else 0.0) / len(x) * (1 - len(x) / m) for w, x, m in zip(share, of, n, strict=True)))
    return spark.range(1).select(F.lit(float(mean)).alias("silhouette_sampled"), F.lit(error).alias("standard_error"), F.lit(len(marks)).cast("long").alias("judged"))


def davies_bouldin(df: DataFrame, label: str, vector: str) -> DataFrame:
    """One row ``davies_bouldin``; infinite with fewer than two labels."""
    centers = centroids(df, label, vector)
    table = centers.agg(F.map_from_entries(F.collect_list(F.struct("label", "centroid")))).scalar()
    placed = df.select(F.col(label).alias("label"), F.col(vector).alias("_x"), table[F.col(label)].alias("_c"))
    spread = placed.groupBy("label").agg(F.avg(F.sqrt(squared_distance(F.col("_x"), F.col("_c")))).alias("s"))
    clusters = spread.join(centers, "label").agg(F.collect_list(F.struct("label", "s", "centroid")).alias("c"))
    pairs = clusters.select(F.explode("c").alias("i"), "c").select("i", F.explode("c").alias("j")).where(
        F.col("i.label") != F.col("j.label")
    )
    apart = F.sqrt(squared_distance(F.col("i.centroid"), F.col("j.centroid")))
    ratio = F.when(apart > 0, (F.col("i.s") + F.col("j.s")) / apart).otherwise(F.lit(0.0))
    worst = pairs.groupBy(F.col("i.label").alias("label")).agg(F.max(ratio).alias("r"))
    return worst.agg(F.coalesce(F.avg("r"), F.lit(float("inf"))).alias("davies_bouldin"))


def adjusted_rand(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row ``ari`` for two labelings of the same rows."""

    def pairs(n: Column) -> Column:
        n = n.cast("double")
        return n * (n - 1) / 2

    cells = df.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    both = cells.agg(F.sum(pairs(F.col("n"))).alias("s"), F.sum("n").alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    columns = cells.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    placed = both.select("s", pairs(F.col("n")).alias("all"), rows.alias("r"), columns.alias("c"))
    expected = F.when(F.col("all") > 0, F.col("r") * F.col("c") / F.col("all")).otherwise(F.lit(0.0))
    limit = (F.col("r") + F.col("c")) / 2
    return placed.select(
        F.when(limit == expected, F.lit(1.0)).otherwise((F.col("s") - expected) / (limit - expected)).alias("ari")
    )


def state_sensitivity(scores: DataFrame) -> DataFrame:
    """``family, best_k, best_score`` from ``family, k, score``.

    Families ``gmm`` and ``hmm`` are scored by BIC, where less is better; others by silhouette.
    Equal scores go to the smaller k.
    """
    less_is_better = F.col("family").isin("gmm", "hmm")
    rank = F.when(less_is_better, F.col("score")).otherwise(-F.col("score"))
    best = F.min(F.struct(rank.alias("rank"), F.col("k").alias("k"), F.col("score").alias("score")))
    return scores.where(F.col("score").isNotNull()).groupBy("family").agg(best.alias("b")).select(
        "family", F.col("b.k").cast("double").alias("best_k"), F.col("b.score").alias("best_score")
    )
