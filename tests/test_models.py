import numpy as np
import pandas as pd
import pytest

from bandwise.operators.clustering import nearest_center
from bandwise.operators.isolation import c_factor, fit_isolation_forest
from bandwise.operators.variational import fit_linear_posterior, kl_to_standard_normal, posterior_kl


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(11)
    n = 1500
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 0.7 * x1 - 0.3 * x2 + 1.2 + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame({"x1": x1, "x2": x2, "y": y, "split": "train"})
    return pdf, spark.createDataFrame(pdf)


def _elbo(mu, sigma, x, y, lam):
    pred = x @ mu
    sse = ((y - pred) ** 2).sum() + ((x ** 2) @ (sigma ** 2)).sum()
    return sse + lam * kl_to_standard_normal(mu, sigma)


def test_closed_form_is_optimum(linear):
    pdf, df = linear
    post = fit_linear_posterior(df, ["x1", "x2"])
    x = np.column_stack([pdf.x1, pdf.x2, np.ones(len(pdf))])
    base = _elbo(post.mu, post.sigma, x, pdf.y.to_numpy(), post.kl_weight)
    rng = np.random.default_rng(0)
    for _ in range(20):
        dm, ds = rng.normal(0, 1e-3, 3), rng.normal(0, 1e-6, 3)
        assert base <= _elbo(post.mu + dm, np.abs(post.sigma + ds), x, pdf.y.to_numpy(), post.kl_weight)
    assert post.mu == pytest.approx([0.7, -0.3, 1.2], abs=0.02)


def test_kl_non_negative_and_table(linear, spark):
    _, df = linear
    post = fit_linear_posterior(df, ["x1", "x2"])
    kl = posterior_kl(post.table(spark)).first()
    assert kl["n_weights"] == 3 and kl["kl"] >= 0
    assert kl["kl"] == pytest.approx(kl_to_standard_normal(post.mu, post.sigma), rel=1e-9)


def test_predictive_equals_direct_draws(linear, spark):
    pdf, df = linear
    post = fit_linear_posterior(df, ["x1", "x2"], kl_weight=50.0)   # wide posterior
    pred = post.predictive(df.limit(50)).toPandas()
    w = post.draws(spark, 100).toPandas().pivot(index="draw", columns="weight_id", values="value")
    x = np.column_stack([pred.x1, pred.x2, np.ones(len(pred))])
    direct = x @ w.to_numpy().T
    assert np.allclose(pred.mc_mean, direct.mean(axis=1))
    assert np.allclose(pred.mc_std, direct.std(axis=1))


def test_c_factor_values():
    assert c_factor([1, 2])[0] == 0.0 and c_factor([2])[0] == 1.0
    n = 256
    h = np.sum(1.0 / np.arange(1, n))
    assert c_factor([n])[0] == pytest.approx(2 * h - 2 * (n - 1) / n, rel=2e-3)


def test_isolation_forest_flags_outliers(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 2))
    x[:30] += 8.0                                  # planted outliers
    pdf = pd.DataFrame({"key": np.arange(3000), "a": x[:, 0], "b": x[:, 1], "split": "train"})
    df = spark.createDataFrame(pdf)
    forest = fit_isolation_forest(df, ["a", "b"], "key")
    assert forest.nodes.tree.nunique() == 100
    assert forest.nodes.groupby("tree")["size"].first().max() == 256
    scored = forest.flag(forest.score(df)).toPandas()
    assert scored.iso_score.between(0, 1).all()
    assert scored.is_anomaly.mean() == pytest.approx(0.05, abs=0.005)
    assert scored[scored.key < 30].is_anomaly.all()


def test_every_tree_has_its_rows(spark):
    """Few distinct keys, repeated rows and a key that holds a third of all rows: no tree is short."""
    rng = np.random.default_rng(2)
    n = 20_000
    pdf = pd.DataFrame({"key": np.where(np.arange(n) % 3 == 0, 1, np.arange(n) // 50), "a": rng.integers(0, 40, n).astype(float),
                        "split": "train"})
    forest = fit_isolation_forest(spark.createDataFrame(pdf), ["a"], "key", trees=40)
    assert (forest.nodes.groupby("tree")["size"].first() == 256).all() and forest.nodes.tree.nunique() == 40
    few = fit_isolation_forest(spark.createDataFrame(pdf.head(100)), ["a"], "key", trees=40)
    assert (few.nodes.groupby("tree")["size"].first() == 100).all()


def test_gram_sums_of_a_wide_frame(spark):
    from bandwise.operators.variational import gram_sums
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(500, 64)), rng.normal(size=500)
    df = spark.createDataFrame(pd.DataFrame({**{f"x{i}": x[:, i] for i in range(64)}, "y": y})).repartition(5)
    n, a, c, yy = gram_sums(df, [f"x{i}" for i in range(64)], "y")
    full = np.column_stack([x, np.ones(500)])
    assert n == 500 and yy == pytest.approx(y @ y)
    assert a == pytest.approx(full.T @ full) and c == pytest.approx(full.T @ y)
    assert gram_sums(df.where("false"), ["x0"], "y")[0] == 0


def test_nearest_center_ties_to_smallest_id(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 2.0],)], "v array<double>")
    out = nearest_center(df, "v", {1: [1.0, 1.0], 0: [1.0, 1.0], 5: [2.0, 2.0]}).collect()
    assert [r.center for r in out] == [0, 5] and out[1].distance == 0.0


def test_kmeans_best_of_starts_and_onehot(spark):
    from pyspark.ml.functions import array_to_vector

    from bandwise.operators.clustering import fit_kmeans_feature
    rng = np.random.default_rng(12)
    centers = np.array([[0, 0], [5, 5], [0, 5]])
    pts = np.vstack([c + rng.normal(0, 0.3, (100, 2)) for c in centers])
    pdf = pd.DataFrame({"v": list(pts), "split": "train"})
    df = spark.createDataFrame(pdf).withColumn("features", array_to_vector("v"))
    feat = fit_kmeans_feature(df, "features", k=3, starts=4)
    out = feat.transform(df, onehot=True).toPandas()
    assert out.cluster.nunique() == 3 and len(out.cluster_onehot.iloc[0]) == 3
    assert feat.cost == pytest.approx(((pts - pts.reshape(3, 100, 2).mean(axis=1).repeat(100, axis=0)) ** 2).sum(), rel=1e-6)


def test_money_and_percent(spark):
    from bandwise.functions.columns import money, percent
    r = spark.createDataFrame([(12.3456, 0.95123)], "a double, b double").select(
        money("a", scale=100000.0).alias("m"), percent("b").alias("p")).first()
    assert r.m == "$1,234,560.00" and r.p == "95.1%"


def test_kmeans_starts_that_move_together_end_as_sparks_do(spark):
    """Every start's centres and cost are those of Spark's KMeans with that seed; one job an iteration serves all."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from bandwise.operators import clustering
    from bandwise.session import spread
    rng = np.random.default_rng(31)
    pts = rng.normal(size=(600, 3)) + 1e3
    df = spread(spark.createDataFrame(pd.DataFrame({"v": list(pts)})).select(array_to_vector("v").alias("features"))).persist()
    begun, want = [], []
    for seed in (7, 8, 9):
        begun.append(np.array([list(c) for c in KMeans(k=12, seed=seed, maxIter=0).fit(df).clusterCenters()]))
        model = KMeans(k=12, seed=seed, maxIter=300, tol=1e-4).fit(df)
        want.append((np.array([list(c) for c in model.clusterCenters()]), model.summary.trainingCost))
    blocks = clustering._vector_blocks(df, "features", 3)
    jobs = []
    real = clustering.summed_vectors
    clustering.summed_vectors = lambda sums: jobs.append(1) or real(sums)
    try:
        got = clustering.lloyd(blocks, begun, 300, 1e-4)
    finally:
        clustering.summed_vectors = real
        blocks.unpersist()
    for (centers, cost), (want_centers, want_cost) in zip(got, want):
        assert np.allclose(centers, want_centers, rtol=1e-9) and cost == pytest.approx(want_cost, rel=1e-9)
    assert len(jobs) < 300
    feat = clustering.fit_kmeans_feature(df, "features", k=12, starts=3, seed=7, split_col=None)
    least = min(range(3), key=lambda i: want[i][1])
    assert feat.seed == 7 + least and feat.cost == pytest.approx(want[least][1], rel=1e-9)
    rows = feat.transform(df).collect()
    sums = [((np.array(r["features"]) - np.array(feat.centers)) ** 2).sum(axis=1) for r in rows]
    assert [r["cluster"] for r in rows] == [int(s.argmin()) for s in sums]
    df.unpersist()


def test_nearest_centre_near_ties_are_told_by_sums():
    from bandwise.operators.clustering import assigned
    centers = np.array([[1e8, 0.0], [1e8 + 2.0, 0.0], [1e8, 5.0]])
    x = np.array([[1e8 + 1.0, 0.0], [1e8 + 1.0001, 0.0], [1e8, 4.0]])
    best, dist = assigned(x, centers)
    assert best.tolist() == [0, 1, 2] and dist == pytest.approx(((x - centers[best]) ** 2).sum(axis=1))
