import numpy as np
import pandas as pd

from bandwise.operators.blocks import fit_variational_net, n_params
from bandwise.operators.prep import fit_standardizer, random_split


def test_random_split_disjoint_and_exhaustive(spark):
    df = spark.range(1000)
    a, b = random_split(df, (0.8, 0.2), seed=42)
    assert a.count() + b.count() == 1000
    assert a.intersect(b).count() == 0


def test_standardizer_as_frame(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0], "split": "train"})
    sc = fit_standardizer(spark.createDataFrame(pdf), ["a"])
    row = sc.as_frame(spark).first()
    assert row.feature == "a" and row.mean == 2.5 and np.isclose(row.std, np.std([1, 2, 3, 4]))


def test_variational_posterior_table_has_every_weight(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=50), "b": rng.normal(size=50),
                        "y": rng.normal(size=50), "split": "train"})
    net = fit_variational_net(spark.createDataFrame(pdf), ["a", "b"], hidden=(3,), steps=2)
    t = net.posterior_table(spark).toPandas()
    assert len(t) == n_params([2, 3, 1])
    assert set(t.kind) == {"weight", "bias"} and len(net.history) == 2
