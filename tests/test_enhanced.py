"""k-means on chosen columns, the enhanced pair's report card, and a segment without validation rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bandwise.operators.audits import coverage_verdict
from bandwise.operators.calibration import fit_conformal
from bandwise.operators.clustering import kmeans_on_columns
from bandwise.operators.params import skew_join
from bandwise.plans.trees import enhanced_report_card
from tests.conftest import SMOKE


def test_clusters_come_from_the_named_columns_alone(spark):
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 3, 300)
    pdf = pd.DataFrame({"key": np.arange(300), "lat": centre * 100 + rng.normal(size=300), "noise": rng.normal(size=300) * 1e6,
                        "lon": -centre * 50 + rng.normal(size=300), "name": "x", "split": np.where(np.arange(300) < 240, "train", "test")})
    df = spark.createDataFrame(pdf)
    out, feature = kmeans_on_columns(df, ["lat", "lon"], k=3, starts=3)
    assert out.columns == [*df.columns, "cluster"] and len(feature.centers) == 3 and len(feature.centers[0]) == 2
    got = out.toPandas().set_index("key").sort_index()
    assert got.groupby(centre).cluster.nunique().tolist() == [1, 1, 1] and got.cluster.nunique() == 3
    assert np.allclose(got.noise, pdf.noise)


def test_enhanced_report_card(spark):
    card = enhanced_report_card(spark, SMOKE, rounds=2, k=4, starts=2).collect()
    assert len(card) == 1 and card[0].n > 0 and 0 <= card[0].coverage <= 1 and card[0].verdict


def test_a_segment_without_validation_rows_stays_as_missed(spark):
    rows = [("a", float(i), 0.0, 1.0, "val" if i % 2 else "test") for i in range(40)] + [("b", 1.0, 0.0, 1.0, "test")] * 3
    df = spark.createDataFrame(rows, "segment string, y double, mu double, sigma double, split string")
    conf = fit_conformal(df, by=["segment"])
    test = conf.transform(df.where("split = 'test'"))
    got = {r.segment: (r.n, r.coverage) for r in coverage_verdict(test, "y", "cp_lower", "cp_upper", by=["segment"]).collect()}
    assert got["b"] == (3, 0.0) and got["a"][0] == 20 and got["a"][1] > 0.8


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_are_joined_apart(spark, monkeypatch, how):
    """20,000 segments, half of all rows in one: its rows never meet a shuffle."""
    from bandwise.operators import params

    monkeypatch.setattr(params, "BROADCAST_ROWS", 500)
    df = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 1001 == 0, None).otherwise(
        F.col("id") % 20_000).alias("k"), "id").repartition(6)
    table = spark.range(19_990).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    out = skew_join(df, table, ["k"], how)
    got = out.agg(F.count("*").alias("n"), F.count("v").alias("v"), F.sum(F.expr("v - 3 * k")).alias("wrong")).first()
    want = df.join(table, ["k"], how).agg(F.count("*").alias("n"), F.count("v").alias("v")).first()
    assert (got.n, got.v, got.wrong) == (want.n, want.v, 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan
