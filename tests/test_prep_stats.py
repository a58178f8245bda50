import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bandwise.functions.constants import CLARITY_LEVELS, COLOR_LEVELS, CUT_LEVELS
from bandwise.operators.audits import skew_audit
from bandwise.operators.prep import (
    fit_standardizer, ordinal_encode, positive_filter,
)
from bandwise.operators.stats import density_curve, histogram, moments, spearman
from bandwise.sources.fixtures import orders_frame
from tests.conftest import SMALL


def test_hash_split_disjoint_exhaustive(spark):
    o = orders_frame(spark, SMALL)
    counts = {r.split: r["count"] for r in o.groupBy("split").count().collect()}
    assert counts == {"train": 8961, "val": 3003, "test": 3036}
    parts = [o.where(F.col("split") == s).select("key") for s in counts]
    assert parts[0].union(parts[1]).union(parts[2]).distinct().count() == o.count()
    assert parts[0].intersect(parts[1]).count() == 0 and parts[1].intersect(parts[2]).count() == 0


def test_ordinal_levels_and_unknown(spark):
    df = spark.createDataFrame([("Ideal", "D", "IF"), ("Fair", "J", "I1"), ("Bogus", None, "VS2")],
                               "cut string, color string, clarity string")
    out = ordinal_encode(df, {"cut": CUT_LEVELS, "color": COLOR_LEVELS, "clarity": CLARITY_LEVELS})
    got = [(r.cut_score, r.color_score, r.clarity_score) for r in out.collect()]
    assert got == [(5, 7, 8), (1, 1, 1), (0, 0, 4)]


def test_positive_filter_drops_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 2.0), (None, 1.0), (2.0, 3.0)], "x double, y double")
    assert positive_filter(df, ["x", "y"]).count() == 2


def test_standardizer_train_only_and_constant(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(5, 2, 500), "c": 3.0,
                        "split": rng.choice(["train", "test"], 500)})
    df = spark.createDataFrame(pdf)
    sc = fit_standardizer(df, ["a", "c"])
    out = sc.transform(df).where("split = 'train'").agg(
        F.avg("a"), F.stddev_pop("a"), F.max(F.abs("c"))).first()
    assert abs(out[0]) < 1e-12 and out[1] == pytest.approx(1.0) and out[2] == 0.0


def test_histogram_counts_and_edges(spark):
    vals = np.random.default_rng(2).gamma(2, 3, 999)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    h = histogram(df, "x", 30).orderBy("bin").toPandas()
    want, edges = np.histogram(vals, bins=30)
    assert h["count"].tolist() == want.tolist()
    assert np.allclose(h.bin_lo, edges[:-1]) and np.allclose(h.bin_hi, edges[1:])
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    hc = histogram(const, "x", 30).toPandas()
    assert hc["count"].sum() == 2 and hc.bin_lo.min() == 1.5


def test_moments_and_skew(spark):
    vals = np.random.default_rng(4).lognormal(0, 1, 2000)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    m = moments(df, "x").first()
    d = vals - vals.mean()
    g1 = (d ** 3).mean() / (d ** 2).mean() ** 1.5
    assert m["skewness"] == pytest.approx(g1) and m["std"] == pytest.approx(vals.std())
    rep = skew_audit(df, "x").first()
    assert rep["median"] == pytest.approx(np.median(vals)) and rep["verdict"].startswith("skewed right")


def test_density_integrates_to_one(spark):
    vals = np.random.default_rng(5).normal(0, 1, 3000)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    d = density_curve(df, "x", cut=3.0).orderBy("point").toPandas()
    assert np.trapezoid(d.density, d.x) == pytest.approx(1.0, abs=2e-3)
    h = vals.std(ddof=1) * len(vals) ** -0.2
    g = d.x.iloc[100]
    want = np.exp(-0.5 * ((g - vals) / h) ** 2).sum() / (len(vals) * h * np.sqrt(2 * np.pi))
    assert d.density.iloc[100] == pytest.approx(want)


def test_spearman_with_ties_and_constant(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(0, 20, 800).astype(float)
    b = a + rng.integers(0, 10, 800)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "k": 1.0}))
    want = pd.Series(a).rank().corr(pd.Series(b).rank())
    assert spearman(df, "a", "b", parts=4).first()["spearman"] == pytest.approx(want)
    assert spearman(df, "a", "k").first()["spearman"] is None
