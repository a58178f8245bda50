"""Hand-made edge frames (FIXTURES.md section 4) and report consistency properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bandwise.functions.columns import forward
from bandwise.operators.audits import coverage_verdict, report_card, sharpness_audit, skew_audit
from bandwise.operators.calibration import fit_conformal
from bandwise.operators.gaussian import fit_group_gaussian
from bandwise.operators.prep import with_target


def test_null_and_nonpositive_targets_under_log(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 0.0), (3, -5.0), (4, None), (5, 100.0)],
                               "key int, v double")
    out = {r.key: r.y for r in with_target(df, "v", "log").collect()}
    assert out[2] is None and out[3] is None and out[4] is None
    assert out[1] == pytest.approx(np.log(10.0))
    lp = {r.key: r.y for r in df.select("key", forward("v", "log1p").alias("y")).collect()}
    assert lp[2] == 0.0 and lp[3] is None


def test_null_targets_are_left_out_of_fits_and_reports(spark):
    rows = [(i, "a", float(i), "train") for i in range(6)] + [(9, "a", None, "train")]
    df = spark.createDataFrame(rows, "key int, g string, y double, split string")
    p = fit_group_gaussian(df, by=["g"]).params.first()
    assert p["n_fit"] == 6 and p["mu"] == pytest.approx(2.5)
    rep = coverage_verdict(df.withColumn("lo", F.lit(0.0)).withColumn("hi", F.lit(10.0)),
                           "y", "lo", "hi").first()
    assert rep["n"] == 6 and rep["coverage"] == 1.0


def test_all_scores_tied(spark):
    rows = [(i, 1.0, 0.0, 1.0, "val") for i in range(30)]
    df = spark.createDataFrame(rows, "key int, y double, mu double, sigma double, split string")
    c = fit_conformal(df).params.first()
    assert c["q_hat"] == 1.0 and c["rank"] == 30


def test_constant_target_and_width(spark):
    rows = [(i, 3.0, 3.0, 2.0, 4.0) for i in range(5)]
    df = spark.createDataFrame(rows, "key int, y double, point double, lower double, upper double")
    r = sharpness_audit(df, "y", "point", "lower", "upper").first()
    assert r["width_pct_range"] is None and r["width_std"] == 0.0
    assert r["error_width_spearman"] is None and r["mean_width"] == 2.0
    assert skew_audit(df, "y").first()["skewness"] is None


def test_one_segment_report_equals_global(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"y": rng.gamma(2, 2, 500)})
    pdf["lower"] = pdf.y - rng.uniform(0, 2, 500)
    pdf["upper"] = pdf.y + rng.uniform(-1, 2, 500)
    pdf["point"] = pdf.y + rng.normal(0, 1, 500)
    pdf["seg"] = "only"
    df = spark.createDataFrame(pdf)
    for fn in (coverage_verdict, report_card):
        a = fn(df, "y", "lower", "upper").first().asDict()
        b = fn(df, "y", "lower", "upper", by=["seg"]).drop("seg").first().asDict()
        for k in a:
            assert a[k] == (pytest.approx(b[k]) if isinstance(a[k], float) else b[k])
    a = sharpness_audit(df, "y", "point", "lower", "upper").first().asDict()
    b = sharpness_audit(df, "y", "point", "lower", "upper", by=["seg"]).drop("seg").first().asDict()
    for k in a:
        assert a[k] == pytest.approx(b[k])


def test_empty_split_gives_empty_report(spark):
    df = spark.createDataFrame([(1, 1.0, "train")], "key int, y double, split string")
    test = df.where(F.col("split") == "test").withColumn("lo", F.lit(0.0)).withColumn("hi", F.lit(1.0))
    assert coverage_verdict(test, "y", "lo", "hi", by=["split"]).count() == 0
    assert coverage_verdict(test, "y", "lo", "hi").first()["coverage"] is None


def test_interval_report_equals_separate_audits(spark):
    from bandwise.operators.audits import interval_report
    rng = np.random.default_rng(10)
    pdf = pd.DataFrame({"y": rng.gamma(2, 2, 400), "seg": rng.choice(["a", "b"], 400)})
    pdf["lower"] = pdf.y - rng.uniform(-0.5, 2, 400)
    pdf["upper"] = pdf.y + rng.uniform(-0.5, 2, 400)
    pdf["point"] = pdf.y + rng.normal(0, 1, 400)
    df = spark.createDataFrame(pdf)
    one = interval_report(df, "y", "point", "lower", "upper", by=["seg"]).toPandas().set_index("seg")
    cov = coverage_verdict(df, "y", "lower", "upper", by=["seg"]).toPandas().set_index("seg")
    sh = sharpness_audit(df, "y", "point", "lower", "upper", by=["seg"]).toPandas().set_index("seg")
    for s in ("a", "b"):
        assert one.loc[s, "verdict"] == cov.loc[s, "verdict"]
        assert one.loc[s, "coverage"] == pytest.approx(cov.loc[s, "coverage"])
        for c in ("mean_width", "width_pct_range", "width_std", "error_width_spearman"):
            assert one.loc[s, c] == pytest.approx(sh.loc[s, c])
