import numpy as np
import pandas as pd
import pytest

from bandwise.operators.boosting import fit_gbt_mean, fit_quantile_booster, flat_gbt
from bandwise.operators.ensembles import predict_all
from bandwise.operators.prep import assemble


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(21)
    g = rng.integers(0, 2, 2000).astype(float)
    y = np.where(g == 0, rng.normal(10, 1, 2000), rng.normal(30, 4, 2000))
    pdf = pd.DataFrame({"g": g, "y": y, "split": "train"})
    return pdf, assemble(spark.createDataFrame(pdf), ["g"])


def test_quantile_booster_reaches_group_quantiles(grouped):
    """One categorical feature: the pinball-loss optimum is each group's quantile."""
    pdf, df = grouped
    for alpha in (0.05, 0.95):
        m = fit_quantile_booster(df, "features", alpha=alpha, rounds=12, rate=0.5,
                                 checkpoint_every=5)
        out = m.transform(df.select("g", "features").distinct(), "q").toPandas().set_index("g")
        for gv in (0.0, 1.0):
            want = np.percentile(pdf[pdf.g == gv].y, alpha * 100)
            spread = pdf[pdf.g == gv].y.std()
            assert out.loc[gv, "q"] == pytest.approx(want, abs=0.05 * spread)


def test_gbt_mean_reaches_group_means(grouped):
    pdf, df = grouped
    model = fit_gbt_mean(df, "features", rounds=20, rate=0.5)
    out = model.transform(df.select("g", "features").distinct()).toPandas().set_index("g")
    for gv in (0.0, 1.0):
        assert out.loc[gv, "prediction"] == pytest.approx(pdf[pdf.g == gv].y.mean(), abs=0.05)


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 3)) * [1, 1e-9, 1e9]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=np.sin(x[:, 0]) + x[:, 1] * 1e9 + (x[:, 2] > 0), split="train")
    return assemble(spark.createDataFrame(pdf), ["a", "b", "c"])


def test_flat_mean_model_equals_tree_by_tree(wide):
    model = fit_gbt_mean(wide, "features", rounds=12)
    flat = flat_gbt(model)
    assert flat.depth <= 5 and len(flat.roots) == 12
    out = predict_all(model.transform(wide), "features", {"flat": flat}).toPandas()
    assert np.allclose(out.flat, out.prediction, rtol=1e-12, atol=1e-12)


def test_flat_quantile_pair_equals_tree_by_tree(wide):
    models = {a: fit_quantile_booster(wide, "features", alpha=a, rounds=6) for a in (0.1, 0.9)}
    flat = predict_all(wide, "features", {f"q{int(10 * a)}": m.flat() for a, m in models.items()})
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # both ensembles in one pass
    got = flat.toPandas()
    for a, m in models.items():
        want = np.full(len(got), m.init)
        for tree, values in m.trees:
            t = tree.copy()
            t.setLeafCol("leaf").setPredictionCol("p")
            leaves = t.transform(wide).select("leaf").toPandas().leaf
            want = want + m.rate * leaves.map(values).to_numpy()
        assert np.allclose(got[f"q{int(10 * a)}"], want, rtol=1e-12, atol=1e-12)
    assert predict_all(wide.limit(0), "features", {"q": models[0.1].flat()}).count() == 0


def test_a_loop_reads_few_partitions(spark):
    """The frame that boosting loops over has as many partitions as there are cores, and all rows."""
    from bandwise.operators import boosting
    cores = spark.sparkContext.defaultParallelism
    many = boosting.for_loops(spark.range(0, 5000, 1, 4 * cores))
    assert many.rdd.getNumPartitions() == cores and many.agg({"id": "sum"}).first()[0] == 4999 * 2500
    assert boosting.for_loops(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == cores
