import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import agreement, clusters, hierarchy, hmm, latent
from tidemark.operators import changepoints as changepoints_module
from tidemark.operators.changepoints import _kernel, bandwidth, changepoints, find_breaks, landmark_changepoints
from tidemark.operators.profiles import map_micro_to_macro
from tidemark.operators.scaling import apply_scaler, standardize
from tidemark.params import Models

KEYS = ["station"]


def cloud(spark, points, labels):
    rows = [(i, [float(x) for x in p], int(l)) for i, (p, l) in enumerate(zip(points, labels))]
    return spark.createDataFrame(rows, "id long, v array<double>, label int")


def plain_silhouette(points, labels):
    scores = []
    for i, p in enumerate(points):
        distance = np.sqrt(((points - p) ** 2).sum(axis=1))
        own = labels == labels[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = distance[own].sum() / (own.sum() - 1)
        b = min(distance[labels == k].mean() for k in set(labels) if k != labels[i])
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_silhouette(spark):
    four = cloud(spark, [[0.0], [0.1], [10.0], [10.2]], [0, 0, 1, 1])
    assert agreement.silhouette_exact(four, "id", "label", "v").first()[0] == pytest.approx(0.985074, abs=1e-6)
    assert agreement.silhouette_exact(four.withColumn("label", F.lit(1)), "id", "label", "v").first()[0] == -1.0
    rng = np.random.default_rng(1)
    points, labels = rng.normal(size=(60, 3)), np.array([9] + [i % 3 for i in range(59)])
    df = cloud(spark, points, labels)
    for tile in (7, 512):
        assert agreement.silhouette_exact(df, "id", "label", "v", tile).first()[0] == pytest.approx(plain_silhouette(points, labels))
    assert agreement.silhouette_fast(four, "label", "v") > 0.9
    assert agreement.silhouette_fast(four.where("label = 0"), "label", "v") == -1.0


def test_exact_silhouette_writes_no_pairs(spark):
    rng = np.random.default_rng(2)
    points, labels = 1e6 + rng.normal(size=(300, 4)).round(2), np.arange(300) % 3
    points[::7] = points[0]
    df = cloud(spark, points, labels).repartition(3)
    out = agreement.silhouette_exact(df, "id", "label", "v", 16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan.lower() and "CoGroup" not in plan
    assert out.first()[0] == pytest.approx(plain_silhouette(points, labels), abs=1e-9)
    floats = df.withColumn("v", F.col("v").cast("array<float>"))
    whole = np.array(points, np.float32).astype(float)
    assert agreement.silhouette_exact(floats, "id", "label", "v", 16).first()[0] == pytest.approx(plain_silhouette(whole, labels), abs=1e-9)
    assert agreement.silhouette_exact(df.where("id < 0"), "id", "label", "v").first()[0] == -1.0
    with pytest.raises(Exception, match="same"):
        agreement.silhouette_exact(df.withColumn("v", F.expr("if(id = 5, null, v)")), "id", "label", "v").first()


def test_many_clusters_in_exact_silhouette(spark, monkeypatch):
    monkeypatch.setattr(agreement, "HELD_CLUSTERS", 4)
    rng = np.random.default_rng(3)
    points, labels = rng.normal(size=(90, 3)), np.arange(90) // 5
    assert agreement.silhouette_exact(cloud(spark, points, labels), "id", "label", "v", 8).first()[0] == pytest.approx(plain_silhouette(points, labels))


def test_davies_bouldin(spark):
    four = cloud(spark, [[0.0], [2.0], [10.0], [14.0]], [0, 0, 1, 1])
    assert agreement.davies_bouldin(four, "label", "v").first()[0] == pytest.approx((1 + 2) / 11)
    assert math.isinf(agreement.davies_bouldin(four.withColumn("label", F.lit(1)), "label", "v").first()[0])


def test_adjusted_rand(spark):
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 3)], "a int, b int")
    assert agreement.adjusted_rand(same, "a", "b").first()[0] == 1.0
    mixed = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 2)], "a int, b int")
    assert agreement.adjusted_rand(mixed, "a", "b").first()[0] == pytest.approx(4 / 7)
    assert agreement.adjusted_rand(same.withColumns({"a": F.lit(1), "b": F.lit(1)}), "a", "b").first()[0] == 1.0


def test_sensitivity(spark):
    scores = {"kmeans": {2: 0.2, 3: 0.4}, "gmm": {2: 100.0, 3: 90.0}, "hmm": {2: 120.0, 3: 80.0}}
    rows = [(f, k, s) for f, by_k in scores.items() for k, s in by_k.items()]
    found = agreement.state_sensitivity(spark.createDataFrame(rows, "family string, k int, score double"))
    assert {r.family: r.best_k for r in found.collect()} == {"kmeans": 3.0, "gmm": 3.0, "hmm": 3.0}


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, flat double")
    scaled, params = standardize(df, ["x", "flat"])
    assert sorted(tuple(r) for r in scaled.collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(5.0, 6.0)], "x double, flat double")
    assert tuple(apply_scaler(other, ["x", "flat"], params).first()) == (3.0, 1.0)


def blobs(spark, seed=0):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0], [8, 0], [0, 8]])
    labels = np.repeat([0, 1, 2], 30)
    return cloud(spark, centers[labels] + rng.normal(scale=0.3, size=(90, 2)), labels)


def test_cluster_selection(spark):
    df = blobs(spark)
    fit = clusters.kmeans_select_k(df, "id", "v", [3, 2, 2, 1], restarts=2)
    assert fit.k == 3 and set(fit.scores) == {2, 3}
    assert agreement.adjusted_rand(fit.labels, "label", "regime").first()[0] == 1.0
    mixture = clusters.gmm_select_k(df, "v", [2, 3], max_iter=50)
    assert set(mixture.scores) == {2, 3} and mixture.score == min(mixture.scores.values())
    assert clusters.mixture_parameters(2, 2) == 4 + 6 + 1
    with pytest.raises(ValueError):
        clusters.candidate_states([0, 1])
    table = clusters.score_table(df, "kmeans", fit.scores)
    assert agreement.state_sensitivity(table).first().best_k == 3.0


def test_nearest_centroid(spark):
    df = blobs(spark)
    centers = agreement.centroids(df, "label", "v")
    assert agreement.nearest_centroid(df, "v", centers).where("nearest <> label").count() == 0


def test_projection_and_reconstruction(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 4)) @ np.diag([5, 2, 0.5, 0.1]) + 3
    df = cloud(spark, x, np.zeros(40))
    embedded, basis = latent.latent_embedding(df, "v", 2)
    centred = x - x.mean(axis=0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    got = np.array([r.latent for r in embedded.orderBy("id").collect()])
    assert np.abs(got) == pytest.approx(np.abs(centred @ vt[:2].T), abs=1e-6)
    errors = latent.reconstruction_error(df, "v", basis.as_table(spark), F.array(*[F.lit(m) for m in basis.mean]))
    back = centred @ vt[:2].T @ vt[:2]
    wanted = ((centred - back) ** 2).mean(axis=1)
    assert [r.reconstruction_error for r in errors.orderBy("id").collect()] == pytest.approx(list(wanted), abs=1e-9)
    assert {"latent_pc1", "latent_pc2"} <= set(latent.latent_projection(embedded, "latent").columns)
    with pytest.raises(ValueError):
        latent.pca_projection(df.limit(2), "v")


def test_hierarchy(spark):
    df = cloud(spark, [[0, 0], [1, 0], [10, 0], [11, 0], [30, 0]], [0, 1, 2, 3, 4])
    merged, mapping = hierarchy.super_regimes(df, "label", "v", 3)
    assert {r.label: r.super_regime for r in merged.collect()} == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}
    assert mapping.count() == 5
    assert hierarchy.super_regimes(df.where("label = 0"), "label", "v") is None
    assert hierarchy.hierarchy_source(["kmeans", "hmm"]) == "hmm" and hierarchy.hierarchy_source([]) is None
    with pytest.raises(Exception, match="no macro state"):
        map_micro_to_macro(df, "label", mapping.where("micro_state < 4")).collect()
    labels = spark.createDataFrame([("a", i, i % 5) for i in range(10)], "station string, seq long, label int")
    means = df.select(F.col("label").alias("state"), F.col("v").alias("mean"))
    macro, pairs, matrix = hierarchy.macro_from_state_means(labels, means, KEYS, "seq", "label", 2, restarts=2)
    assert pairs.select("macro_state").distinct().count() == 2 and matrix.count() == 4
    assert macro.where("macro_state IS NULL").count() == 0


MODEL = hmm.HmmParameters(
    np.array([0.6, 0.4]), np.array([[0.9, 0.1], [0.2, 0.8]]), np.array([[0.0, 0.0], [2.0, 1.0]]), np.array([[1.0, 1.0], [1.5, 0.5]])
)


def sequences(spark, lengths=(50, 9, 1), seed=4):
    rng = np.random.default_rng(seed)
    rows, data = [], {}
    for n, length in enumerate(lengths):
        state, xs = 0, []
        for _ in range(length):
            state = int(rng.random() < MODEL.transitions[state, 1])
            xs.append(MODEL.means[state] + rng.normal(size=2) * np.sqrt(MODEL.variances[state]))
        data[f"s{n}"] = np.array(xs)
        rows += [(f"s{n}", i, [float(v) for v in x]) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "station string, seq long, x array<double>"), data


def plain_viterbi(x):
    b, a = hmm.emissions(x, MODEL), np.log(MODEL.transitions)
    best = None
    score, back = np.log(MODEL.start) + b[0], []
    for t in range(1, len(x)):
        options = score[:, None] + a
        back.append(options.argmax(axis=0))
        score = options.max(axis=0) + b[t]
    path = [int(score.argmax())]
    for pointers in reversed(back):
        path.append(int(pointers[path[-1]]))
    return path[::-1]


def plain_likelihood(x):
    b, a = hmm.emissions(x, MODEL), np.log(MODEL.transitions)
    alpha = np.log(MODEL.start) + b[0]
    for t in range(1, len(x)):
        alpha = np.logaddexp.reduce(alpha[:, None] + a, axis=0) + b[t]
    return np.logaddexp.reduce(alpha)


def plain_counts(x):
    """Expected statistics by summing over all state paths of a short series."""
    b, k = hmm.emissions(x, MODEL), 2
    total, start, pairs, held = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros(k)
    for path in itertools.product(range(k), repeat=len(x)):
        p = MODEL.start[path[0]] * np.exp(b[0, path[0]])
        for t in range(1, len(x)):
            p *= MODEL.transitions[path[t - 1], path[t]] * np.exp(b[t, path[t]])
        total += p
        start[path[0]] += p
        for t, s in enumerate(path):
            held[s] += p
            if t:
                pairs[path[t - 1], s] += p
    return start / total, pairs / total, held / total


@pytest.mark.parametrize("block,chained", [(1, 8192), (6, 8192), (8192, 8192), (1, 7), (6, 2)])
def test_decode_and_likelihood_for_any_block(spark, monkeypatch, block, chained):
    monkeypatch.setattr(hmm, "CHAIN_TABLES", chained)
    df, data = sequences(spark)
    paths = {}
    for r in hmm.hmm_decode(df, KEYS, "seq", "x", MODEL, block_rows=block).orderBy("seq").collect():
        paths.setdefault(r.station, []).append(r.state)
    assert paths == {s: plain_viterbi(x) for s, x in data.items()}
    blocks = hmm.arrange_blocks(df, KEYS, "seq", "x", block)
    assert hmm._is_long(blocks) == (chained < 50 / block)
    wanted = sum(plain_likelihood(x) for x in data.values())
    assert hmm.log_likelihood(blocks, MODEL, hmm._is_long(blocks)) == pytest.approx(wanted)


def test_expected_counts_for_any_block(spark, monkeypatch):
    df, data = sequences(spark, (8, 5))
    wanted = [plain_counts(x) for x in data.values()]
    monkeypatch.setattr(hmm, "CHAIN_TABLES", 3)
    for block in (1, 3, 100):
        blocks = hmm.arrange_blocks(df, KEYS, "seq", "x", block)
        stats = hmm._expectation(blocks, MODEL, hmm._is_long(blocks))
        assert stats[1:3] == pytest.approx(sum(w[0] for w in wanted))
        assert stats[3:7].reshape(2, 2) == pytest.approx(sum(w[1] for w in wanted))
        assert stats[7:9] == pytest.approx(sum(w[2] for w in wanted))


def test_fit_and_selection(spark):
    df, _ = sequences(spark, (120, 80))
    fit = hmm.hmm_fit(df, KEYS, "seq", "x", 2, iterations=4, block_rows=32)
    whole = hmm.hmm_fit(df, KEYS, "seq", "x", 2, iterations=4)
    # The starting centres depend on how rows are partitioned, so the two fits agree only closely.
    assert fit.log_likelihood == pytest.approx(whole.log_likelihood, rel=1e-2)
    assert fit.parameters.transitions.sum(axis=1) == pytest.approx([1, 1])
    best = hmm.hmm_select_states(df, KEYS, "seq", "x", [2, 3], iterations=2)
    assert best.bic == min(best.bic_by_states.values())
    assert best.bic_by_states[2] == pytest.approx(
        hmm.hmm_bic(hmm.hmm_fit(df, KEYS, "seq", "x", 2, iterations=2).log_likelihood, 2, 2, 200), rel=1e-2
    )
    pairs = hmm.hmm_seed_stability(df, KEYS, "seq", "x", 2, [0, 1], iterations=2)
    assert -1 <= hmm.stability_summary(pairs).first().ari_min <= 1
    assert hmm.hmm_seed_stability(df, KEYS, "seq", "x", 2, [0], iterations=1) is None


def plain_breaks(x, penalty):
    """The best segmentation over all allowed break positions, by exhaustive search."""
    kernel, n = _kernel(x), len(x)

    def cost(a, b):
        part = kernel[a:b, a:b]
        return np.trace(part) - part.sum() / (b - a)

    allowed = [p for p in range(5, n, 5) if n - p >= 2]
    best = min(
        (sum(cost(a, b) + penalty for a, b in zip((0, *cuts), (*cuts, n))), list(cuts))
        for size in range(len(allowed) + 1)
        for cuts in itertools.combinations(allowed, size)
    )
    return best[1]


def test_breaks_against_exhaustive_search():
    for seed in range(6):
        rng = np.random.default_rng(seed)
        x = np.concatenate([rng.normal(loc=m, size=(n, 2)) for m, n in ((0, 12), (4, 9), (0, 14))])
        for penalty in (0.5, 2.0, 8.0):
            assert find_breaks(x, penalty) == plain_breaks(x, penalty)
    assert find_breaks(np.zeros((3, 1)), 1.0) == []


def test_changepoints_in_segments(spark):
    rng = np.random.default_rng(0)
    rows = [(s, i, [float((i >= cut) * 5 + rng.normal() * 0.1)]) for s, cut in (("a", 50), ("b", 40)) for i in range(120)]
    df = spark.createDataFrame(rows, "station string, seq long, x array<double>")
    for size in (1000, 40, None):
        found = changepoints(df, KEYS, "seq", "x", 3.0, size, 20).collect()
        assert {(r.station, r.boundary) for r in found} == {("a", 50), ("b", 40)}
    assert [r.boundary for r in changepoints(df.where("station = 'a'"), [], "seq", "x", 3.0).collect()] == [50]


def test_changepoints_of_long_series(spark):
    rng = np.random.default_rng(3)
    cuts = [400, 900, 1500, 2200]
    level = np.searchsorted(cuts, np.arange(2_500), side="right")
    rows = [("a", i, [float(5 * (level[i] % 2) + rng.normal() * 0.3)]) for i in range(2_500)]
    df = spark.createDataFrame(rows, "station string, seq long, x array<double>")
    for size in (None, 500, 1_000):
        assert sorted(r.boundary for r in changepoints(df, KEYS, "seq", "x", 3.0, size).collect()) == cuts
    with pytest.raises(ValueError):
        changepoints(df, KEYS, "seq", "x", 3.0, 501)


@pytest.mark.parametrize("settings", [{}, {"block_rows": 20, "run_blocks": 1}, {"block_rows": 35, "run_blocks": 3}])
def test_landmark_changepoints_equal_the_whole_search(spark, settings):
    """With a landmark for every row the features are the kernel itself, whatever the blocks."""
    rng = np.random.default_rng(8)
    rows = []
    for s, n in (("a", 160), ("b", 91), ("c", 1), ("d", 3), ("e", 57), ("f", 40)):
        rows += [(s, i, (rng.normal(size=2) + 6 * ((i // 23) % 2)).tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "station string, seq long, x array<double>").repartition(5)
    for penalty in (1.0, 3.0):
        wanted = {(r.station, r.boundary) for r in changepoints(df, KEYS, "seq", "x", penalty).collect()}
        got = [(r.station, r.boundary) for r in landmark_changepoints(df, KEYS, "seq", "x", penalty, landmarks=200, **settings).collect()]
        assert set(got) == wanted and len(got) == len(wanted) > 5
    one = df.where("station = 'a'").drop("station")
    assert {r.boundary for r in landmark_changepoints(one, [], "seq", "x", 3.0, landmarks=200, **settings).collect()} == {b for s, b in wanted if s == "a"}


def test_landmark_changepoints_of_long_series(spark):
    """Few landmarks, rare regimes, a long stretch without any break and many runs of blocks."""
    cuts = [4_000, 4_030, 30_000, 30_500, 50_000]
    i = F.col("id")
    level = sum((F.when(i >= c, F.lit((-1.0) ** n)).otherwise(0.0) for n, c in enumerate(cuts)), F.lit(0.0))
    df = spark.range(60_000).select(i.alias("seq"), F.array(6 * level + F.randn(3) * 0.5, F.randn(4) * 0.5).alias("x"))
    for settings in ({}, {"block_rows": 5_000, "run_blocks": 2, "bandwidth": 4.0}):
        got = sorted(r.boundary for r in landmark_changepoints(df, [], "seq", "x", **settings).collect())
        assert got == cuts
    assert landmark_changepoints(df.where("false"), [], "seq", "x").collect() == []
    with pytest.raises(ValueError):
        landmark_changepoints(df, [], "seq", "x", block_rows=12)


def test_a_given_bandwidth_compares_no_pairs(spark, monkeypatch):
    rows = [("a", i, [float(i >= 50)]) for i in range(120)]
    df = spark.createDataFrame(rows, "station string, seq long, x array<double>")
    monkeypatch.setattr(changepoints_module, "exact_bandwidths", None)
    assert [r.boundary for r in changepoints(df, KEYS, "seq", "x", 3.0, 40, bandwidth=0.5).collect()] == [50]


def test_sampled_silhouette(spark):
    rng = np.random.default_rng(1)
    labels = rng.choice(4, 3_000, p=[0.6, 0.3, 0.08, 0.02])
    points = rng.normal(size=(3_000, 3)) + 3 * rng.normal(size=(4, 3))[labels]
    df = spark.createDataFrame([(i, int(c), x.tolist()) for i, (c, x) in enumerate(zip(labels, points))], "id long, label int, v array<double>")
    true = plain_silhouette(points, labels)
    whole = agreement.silhouette_sampled(df, "id", "label", "v", 5_000).first()
    assert whole.silhouette_sampled == pytest.approx(true) and whole.standard_error == 0 and whole.judged == 3_000
    part = agreement.silhouette_sampled(df.repartition(7), "id", "label", "v", 400).first()
    assert 400 <= part.judged <= 500 and 0 < part.standard_error < 0.02 and abs(part.silhouette_sampled - true) < 4 * part.standard_error
    alone = agreement.silhouette_sampled(df.where("label = 0"), "id", "label", "v").first()
    assert alone.silhouette_sampled == -1.0 and agreement.silhouette_sampled(df.where("false"), "id", "label", "v").first()[0] == -1.0


def test_models_compare_no_pairs_by_default():
    assert Models().silhouette != "exact" and Models().changepoint_search == "landmarks"


def test_bandwidth_is_of_all_rows(spark):
    """Every 24th of 12,288 rows, an evenly spaced sample, would be the same hour of the day."""
    rng = np.random.default_rng(5)
    hours = [(("a", i, [float(8 * (i % 24 >= 12) + rng.normal() * 0.1)])) for i in range(1_800)]
    short = [("b", i, [float(v)]) for i, v in enumerate((0, 1, 5, 2))] + [("c", 0, [1.0])]
    df = spark.createDataFrame(hours + short, "station string, _p long, _x array<double>")
    top = df.groupBy("station").agg(F.max("_p").alias("_top"))
    got = {r["station"]: r["_middle"] for r in changepoints_module.exact_bandwidths(df, KEYS, top).collect()}
    assert got["a"] == pytest.approx(bandwidth(np.array([x for _, _, x in hours])), rel=1e-9)
    assert got["b"] == bandwidth(np.array([[0.0], [1.0], [5.0], [2.0]])) and got["c"] == 0.0
    alone = changepoints_module.exact_bandwidths(df.where("station = 'b'").drop("station"), [], top.where("station = 'b'").drop("station"))
    assert alone.first()["_middle"] == got["b"]
    assert got["a"] > 1 > bandwidth(np.array([x for _, _, x in hours[::24]]))


def test_selection_silhouette_is_a_setting(spark):
    four = spark.createDataFrame([(i, i // 2, [float(10 * (i // 2) + i % 2)]) for i in range(4)], "id int, label int, v array<double>")
    exact, squared = (clusters.silhouette_for_selection(four, "id", "label", "v", kind) for kind in ("exact", "squared"))
    assert exact == pytest.approx(agreement.silhouette_exact(four, "id", "label", "v").first()[0])
    assert squared == pytest.approx(agreement.silhouette_fast(four, "label", "v")) and squared != pytest.approx(exact)
    with pytest.raises(ValueError):
        clusters.silhouette_for_selection(four, "id", "label", "v", "fast")
