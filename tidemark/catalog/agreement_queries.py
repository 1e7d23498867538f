"""Scaling, cluster quality and agreement on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.label_queries import hourly, sequences_sql
from tidemark.catalog.registry import chain, query, rounded, table
from tidemark.operators import agreement
from tidemark.operators.hierarchy import hierarchy_labels
from tidemark.operators.latent import reconstruction_error
from tidemark.operators.scaling import apply_scaler, scaler_params, standardize

LINE = ["l_quantity", "l_extendedprice", "l_tax", "flat"]


def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", *[F.col(c).cast("double").alias(c) for c in LINE[:-1]],
        F.lit(7.0).alias("flat"), "l_returnflag",
    )


def z_sql(source: str) -> str:
    return ", ".join(f"(l.{c} - (SELECT avg({c}) FROM {source})) / (SELECT stddev_pop({c}) FROM {source}) AS {c}" for c in LINE[:-1])


LINES_SQL = "lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_tax, l_returnflag FROM lineitem)"


@query("standardize", chain(LINES_SQL) + "SELECT l_orderkey, l_linenumber, l_partkey, " + rounded(
    *z_sql("lines").replace(", (l.", ",, (l.").split(",, ")) + ", 0.0 AS flat FROM lines l")
def standardize_query(spark, sf_dir):
    scaled, _ = standardize(lines(spark, sf_dir), LINE)
    return scaled.drop("l_returnflag")


@query("apply_scaler", chain(LINES_SQL, "stored AS (SELECT * FROM lines WHERE l_returnflag = 'R')") + "SELECT l_orderkey, l_linenumber, l_partkey, "
       + rounded(*z_sql("stored").replace(", (l.", ",, (l.").split(",, ")) + " FROM lines l")
def apply_scaler_query(spark, sf_dir):
    rows = lines(spark, sf_dir)
    stored = scaler_params(rows.where(F.col("l_returnflag") == "R"), LINE[:-1])
    return apply_scaler(rows, LINE[:-1], stored).drop("l_returnflag", "flat")


def points(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


POINTS = "points AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
CENTRES = """parts AS (SELECT vec_id, label, unnest(x) AS v, unnest(range(len(x))) AS i FROM points),
means AS (SELECT label, i, avg(v) AS m FROM parts GROUP BY 1, 2),
centres AS (SELECT label, list(m ORDER BY i) AS c FROM means GROUP BY 1)"""


@query("nearest_centroid", chain(POINTS, CENTRES) + """SELECT vec_id, p.label AS label, arg_min(c.label, list_distance(x, c)) AS nearest
FROM points p, centres c GROUP BY 1, 2""")
def nearest_query(spark, sf_dir):
    rows = points(spark, sf_dir)
    found = agreement.nearest_centroid(rows, "embedding", agreement.centroids(rows, "label", "embedding"))
    return found.drop("embedding")


@query("state_centroids", chain(POINTS, CENTRES) + f"SELECT label, CAST(i AS BIGINT) AS i, {rounded('m')} FROM means")
def centroids_query(spark, sf_dir):
    centers = agreement.centroids(points(spark, sf_dir), "label", "embedding")
    return centers.select("label", F.posexplode("centroid").alias("i", "m")).withColumn("i", F.col("i").cast("long"))


def silhouette_sql(distance: str, name: str) -> str:
    return chain(POINTS) + f"""SELECT {rounded(f"avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS {name}")} FROM
(SELECT id, max(n) FILTER (WHERE own) AS n, max(total / (n - 1)) FILTER (WHERE own AND n > 1) AS a, min(total / n) FILTER (WHERE NOT own) AS b FROM
  (SELECT p.vec_id AS id, q.label = p.label AS own, q.label AS l, count(*) AS n, sum({distance}) AS total
   FROM points p, points q GROUP BY 1, 2, 3) GROUP BY 1)"""


@query("silhouette_exact", silhouette_sql("list_distance(p.x, q.x)", "silhouette"))
def silhouette_query(spark, sf_dir):
    return agreement.silhouette_exact(points(spark, sf_dir), "vec_id", "label", "embedding", 128)


@query("silhouette_sampled", chain(POINTS, "exact AS (" + silhouette_sql("list_distance(p.x, q.x)", "silhouette_sampled").removeprefix(chain(POINTS)) + ")")
       + "SELECT silhouette_sampled, 0.0 AS standard_error, (SELECT count(*) FROM points) AS judged FROM exact")
def silhouette_sampled_query(spark, sf_dir):
    """Tables of at most 2,000 points have all of them judged."""
    return agreement.silhouette_sampled(points(spark, sf_dir), "vec_id", "label", "embedding")


@query("silhouette_fast", silhouette_sql("list_distance(p.x, q.x) * list_distance(p.x, q.x)", "silhouette_squared"))
def silhouette_fast_query(spark, sf_dir):
    value = agreement.silhouette_fast(points(spark, sf_dir), "label", "embedding")
    return spark.createDataFrame([(value,)], "silhouette_squared double")


@query("davies_bouldin", chain(POINTS, CENTRES, """spread AS (SELECT label, any_value(c) AS c, avg(list_distance(x, c)) AS s
  FROM points JOIN centres USING (label) GROUP BY 1)""") + f"""SELECT {rounded("avg(r) AS davies_bouldin")} FROM
(SELECT i.label, max((i.s + j.s) / list_distance(i.c, j.c)) AS r FROM spread i JOIN spread j ON i.label <> j.label GROUP BY 1)""")
def davies_query(spark, sf_dir):
    return agreement.davies_bouldin(points(spark, sf_dir), "label", "embedding")


@query("adjusted_rand", chain(sequences_sql(), """cells AS (SELECT label AS a, other AS b, count(*) AS n FROM labels GROUP BY 1, 2),
sums AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM cells) AS s, (SELECT sum(n) FROM cells) AS t,
  (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM cells GROUP BY a)) AS r,
  (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM cells GROUP BY b)) AS c)""")
    + f"""SELECT {rounded("(s - r * c / (t * (t - 1) / 2)) / ((r + c) / 2 - r * c / (t * (t - 1) / 2)) AS ari")} FROM sums""")
def rand_query(spark, sf_dir):
    return agreement.adjusted_rand(hourly(spark, sf_dir), "label", "other")


SCORES = """scores AS (SELECT CASE event_type WHEN 'click' THEN 'kmeans' WHEN 'error' THEN 'gmm' WHEN 'view' THEN 'hmm' ELSE event_type END AS family,
  CAST(floor(value / 25) AS INTEGER) + 2 AS k, avg(value * 1.5 - event_id % 50) AS score FROM events GROUP BY 1, 2)"""


@query("state_sensitivity", chain(SCORES) + f"""SELECT family, CAST(k AS DOUBLE) AS best_k, {rounded("score AS best_score")} FROM
(SELECT *, row_number() OVER (PARTITION BY family ORDER BY CASE WHEN family IN ('gmm', 'hmm') THEN score ELSE -score END, k) AS r FROM scores) WHERE r = 1""")
def sensitivity_query(spark, sf_dir):
    kind = F.col("event_type")
    family = F.when(kind == "click", "kmeans").when(kind == "error", "gmm").when(kind == "view", "hmm").otherwise(kind)
    scores = table(spark, sf_dir, "events").groupBy(
        family.alias("family"), (F.floor(F.col("value") / 25).cast("int") + 2).alias("k")
    ).agg(F.avg(F.col("value") * 1.5 - F.col("event_id") % 50).alias("score"))
    return agreement.state_sensitivity(scores)


@query("reconstruction_error", chain(POINTS, """parts AS (SELECT unnest(x) AS v, unnest(range(len(x))) AS i FROM points),
mean AS (SELECT i, avg(v) AS m FROM parts GROUP BY 1),
axis AS (SELECT list(m / (SELECT sqrt(sum(m * m)) FROM mean) ORDER BY i) AS u FROM mean)""")
    + f"""SELECT vec_id, {rounded("list_sum(list_transform(list_zip(x, u), lambda p: (p[1] - d * p[2]) * (p[1] - d * p[2]))) / len(x) AS reconstruction_error")}
FROM (SELECT vec_id, x, u, list_dot_product(x, u) AS d FROM points, axis)""")
def reconstruction_query(spark, sf_dir):
    rows = points(spark, sf_dir)
    mean = rows.select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    ordered = mean.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("m"))
    length = F.sqrt(F.aggregate("m", F.lit(0.0), lambda t, x: t + x * x))
    axis = ordered.select(F.lit(0).alias("component"), F.transform("m", lambda x: x / length).alias("weights"))
    return reconstruction_error(rows, "embedding", axis).select("vec_id", "reconstruction_error")


@query("hierarchy_source", chain(sequences_sql()) + """SELECT station, hour, CASE WHEN label < 2 THEN label ELSE other END AS hierarchy_label,
  CASE WHEN label < 2 THEN 'hmm' ELSE 'kmeans' END AS hierarchy_source FROM labels""")
def source_query(spark, sf_dir):
    rows = hourly(spark, sf_dir).withColumn("regime_hmm", F.when(F.col("label") < 2, F.col("label")))
    found = hierarchy_labels(rows, {"kmeans": "other", "hmm": "regime_hmm"})
    return found.select("station", "hour", "hierarchy_label", "hierarchy_source")
