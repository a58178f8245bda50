import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bandwise.operators.audits import coverage_verdict, report_card, row_verdict
from bandwise.operators.calibration import (
    fit_conformal, fit_temperature, quantile_interval,
)
from bandwise.operators.gaussian import fit_group_gaussian, nll


@pytest.fixture(scope="module")
def preds(spark):
    rng = np.random.default_rng(3)
    n = 4000
    g = rng.choice(["a", "b"], size=n)
    y = np.where(g == "a", rng.normal(1, 0.5, n), rng.normal(-1, 2.0, n))
    split = rng.choice(["train", "val", "test"], size=n, p=[0.6, 0.2, 0.2])
    pdf = pd.DataFrame({"key": np.arange(n), "g": g, "y": y, "split": split})
    df = spark.createDataFrame(pdf)
    model = fit_group_gaussian(df, by=["g"])
    # a deliberately over-confident model: log-variance shrunk by 1.5
    pred = model.transform(df).withColumn("log_var", F.col("log_var") - 1.5)
    return pdf, pred


def test_group_gaussian_is_group_moments(preds, spark):
    pdf, pred = preds
    p = pred.select("g", "mu", "log_var").distinct().toPandas().set_index("g")
    tr = pdf[pdf.split == "train"]
    for g, sub in tr.groupby("g"):
        assert p.loc[g, "mu"] == pytest.approx(sub.y.mean())
        assert p.loc[g, "log_var"] + 1.5 == pytest.approx(np.log(sub.y.var(ddof=0)))


def test_temperature_is_nll_optimum(preds):
    _, pred = preds
    temp = fit_temperature(pred)
    b = temp.params.first()["bias"]
    val = pred.where(F.col("split") == "val")
    def loss(shift):
        shifted = val.withColumn("lv_s", F.col("log_var") + F.lit(shift))
        return shifted.select(F.avg(nll("y", "mu", "lv_s"))).first()[0]
    at = loss(b)
    assert at <= loss(0.0)
    assert at <= loss(b + 0.05) and at <= loss(b - 0.05)
    assert temp.params.first()["temperature"] > 1.0     # over-confident -> T > 1


def test_conformal_invariant_to_global_temperature(preds):
    _, pred = preds
    a = pred.withColumn("sigma", F.exp(0.5 * F.col("log_var")))
    b = pred.withColumn("sigma", F.exp(0.5 * (F.col("log_var") + 0.7)))
    ca, cb = fit_conformal(a), fit_conformal(b)
    ta = ca.transform(a.where("split = 'test'")).select("key", "cp_lower", "cp_upper").toPandas()
    tb = cb.transform(b.where("split = 'test'")).select("key", "cp_lower", "cp_upper").toPandas()
    m = ta.merge(tb, on="key")
    assert np.allclose(m.cp_lower_x, m.cp_lower_y) and np.allclose(m.cp_upper_x, m.cp_upper_y)


def test_conformal_coverage_at_least_nominal(preds):
    _, pred = preds
    p = pred.withColumn("sigma", F.exp(0.5 * F.col("log_var")))
    c = fit_conformal(p)
    test = c.transform(p.where("split = 'test'"))
    cov = coverage_verdict(test, "y", "cp_lower", "cp_upper").first()["coverage"]
    assert cov >= 0.95 - 3 * np.sqrt(0.95 * 0.05 / 800)


def test_conformal_k_at_least_n_takes_largest(spark):
    rows = [(i, float(i), 0.0, 1.0, "val") for i in range(10)]
    df = spark.createDataFrame(rows, "key int, y double, mu double, sigma double, split string")
    c = fit_conformal(df, alpha=0.05).params.first()
    assert c["q_hat"] == 9.0 and c["rank"] == 10 and c["n_cal"] == 10


def test_one_row_validation(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0, 0.0, "val")], "key int, y double, mu double, log_var double, split string")
    t = fit_temperature(df).params.first()
    assert t["temperature"] == pytest.approx(1.0) and t["n_cal"] == 1


def test_zero_sigma_and_constant_target(spark):
    rows = [(i, 5.0, "train") for i in range(5)] + [(9, 5.0, "val")]
    df = spark.createDataFrame(rows, "key int, y double, split string")
    m = fit_group_gaussian(df)
    pred = m.transform(df)
    row = pred.first()
    assert row["mu"] == 5.0 and np.isfinite(row["log_var"])
    zero = spark.createDataFrame([(1, 1.0, 1.0, 0.0, "val")], "key int, y double, mu double, sigma double, split string")
    assert fit_conformal(zero).params.first()["q_hat"] == 0.0       # an exact hit at sigma 0 scores 0
    bad = [(i, float(i), 0.0, 1.0, "val") for i in range(5)] + [(9, 100.0, 0.0, 0.0, "val")] * 5
    far = fit_conformal(spark.createDataFrame(bad, zero.schema))
    assert far.params.first()["q_hat"] == float("inf") and far.params.first()["n_cal"] == 10
    assert far.transform(zero).first()["cp_lower"] == float("-inf")
    exact = spark.createDataFrame([(1, 1.0, 1.0, 0.0, "val")], "key int, y double, mu double, log_var double, split string")
    assert np.isfinite(fit_temperature(exact).params.first()["bias"])


def test_rows_without_bounds_are_missed(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0, 2.0), (2, 1.0, None, None), (3, 9.0, 0.0, 2.0)],
                               "key int, y double, lower double, upper double")
    got = coverage_verdict(df).first()
    assert got["n"] == 3 and got["coverage"] == pytest.approx(1 / 3)
    assert report_card(df).first()["coverage"] == pytest.approx(1 / 3)


def test_crossed_bounds_and_repair(spark):
    df = spark.createDataFrame([(1, 5.0, 3.0), (2, 1.0, 4.0)], "k int, lo double, hi double")
    out = {r.k: r for r in quantile_interval(df, "lo", "hi").collect()}
    assert out[1].crossed and out[1].width == -2.0 and not out[2].crossed
    rep = {r.k: r for r in quantile_interval(df, "lo", "hi", repair=True).collect()}
    assert rep[1].lower == 3.0 and rep[1].upper == 5.0


def test_unseen_segment_gets_null(spark):
    rows = [(1, "a", 1.0, "train"), (2, "a", 2.0, "train"), (3, "b", 3.0, "test")]
    df = spark.createDataFrame(rows, "key int, g string, y double, split string")
    pred = {r.key: r for r in fit_group_gaussian(df, by=["g"]).transform(df).collect()}
    assert pred[3].mu is None


def test_verdict_boundaries(spark):
    rows = [(i, 0.5 if i < 9 else 2.0, 0.0, 1.0) for i in range(10)]   # coverage exactly 0.90
    ten = spark.createDataFrame(rows, "key int, y double, lower double, upper double")
    assert coverage_verdict(ten, "y", "lower", "upper").first()["verdict"] == "well calibrated"
    df = spark.createDataFrame([(1, 0.9, 0.0, 1.0)], "key int, y double, lower double, upper double")
    assert coverage_verdict(df, "y", "lower", "upper").first()["verdict"] == "under-confident"
    assert row_verdict(df, "key", "y", "y", "lower", "upper").first()["verdict"] == "SUCCESS"
    rc = report_card(df, "y", "lower", "upper").first()
    assert rc["coverage"] == 1.0 and rc["verdict"] == "needs calibration"


def test_segment_without_validation_rows_stays_in_the_report(spark, tmp_path):
    from bandwise.functions.columns import split_label
    from bandwise.plans.calibration import conformal_by_segment

    ids = spark.range(600).select(F.col("id").alias("event_id"), split_label("id").alias("split"))
    rare = (F.col("split") != "val") & (F.col("event_id") % 5 == 0)
    events = ids.select("event_id", (F.col("event_id") % 7).alias("user_id"),
                        F.when(rare, "rare").otherwise("common").alias("event_type"),
                        (10.0 + F.col("event_id") % 13).alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    n = ids.where(rare & (F.col("split") == "test")).count()
    assert n > 0
    rep = {r["segment"]: r for r in conformal_by_segment(spark, str(tmp_path)).collect()}
    assert set(rep) == {"common", "rare"}
    assert (rep["rare"]["n"], rep["rare"]["coverage"], rep["rare"]["q_hat"], rep["rare"]["n_cal"]) == (n, 0.0, None, None)
    assert rep["common"]["q_hat"] is not None and rep["common"]["coverage"] > 0


def test_chain_writes_held_out_rows_alone(spark):
    """The stored predictions hold validation and test rows, each once; later passes read only their columns."""
    from bandwise.plans.calibration import calibrated_predictions
    from bandwise.sources.fixtures import events_frame
    folder = "/root/testdata/sf0.001"
    pred, _ = calibrated_predictions(spark, folder)
    held = events_frame(spark, folder).where(F.col("split") != "train")
    assert {r.split for r in pred.select("split").distinct().collect()} == {"val", "test"}
    assert sorted(r.key for r in pred.select("key").collect()) == sorted(r.key for r in held.select("key").collect())
    plan = pred.select("sigma")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "segment" not in plan.split("FileScan parquet")[1]
