"""Events: group Gaussian -> temperature -> conformal -> audits (phases 1, 4, 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.columns import inverse, rounded
from bandwise.functions.constants import GAUSS_Z
from bandwise.functions.columns import band
from bandwise.functions.constants import COVERAGE_HIGH, COVERAGE_LOW, COVERAGE_VERDICTS
from bandwise.operators.audits import (
    coverage_verdict, inside, interval_report, nll_before_after, row_verdict, sharpness_audit,
)
from bandwise.operators.calibration import (
    asymmetric_bars, fit_conformal, fit_temperature, fit_temperature_batched,
)
from bandwise.operators.gaussian import fit_group_gaussian, gaussian_interval
from bandwise.operators.params import attach
from bandwise.operators.stats import hash_sample, sorted_positions, spearman, top_by
from bandwise.session import stored
from bandwise.sources.fixtures import events_frame


def calibrated_predictions(spark: SparkSession, folder: str, group: str = "segment"):
    """Validation and test rows of events with mu, log_var (group Gaussian fitted on train), the
    temperature fitted on val, calibrated log_var_cal and sigma, all on the log1p scale."""
    frame = events_frame(spark, folder)
    model = fit_group_gaussian(frame, by=[group])
    # Every later step (temperature, conformal ranks, reports) reads held-out rows alone: these are
    # written once to the shared checkpoint folder; train rows are read by the fit and never written.
    pred = stored(model.transform(frame.where(F.col("split").isin("val", "test"))), spread_out=True)
    temp = fit_temperature(pred)
    pred = temp.transform(pred).withColumn("sigma", F.exp(F.lit(0.5) * F.col("log_var_cal")))
    return pred, temp


def conformal_test(spark: SparkSession, folder: str, group: str = "segment"):
    """Test rows with the conformal interval on the real scale (y_real, cp_*)."""
    pred, temp = calibrated_predictions(spark, folder, group)
    conf = fit_conformal(pred)
    test = conf.transform(pred.where(F.col("split") == "test"), transform="log1p")
    return test.withColumn("y_real", inverse(F.col("y"), "log1p")), temp, conf


def calibration_chain(spark: SparkSession, folder: str) -> DataFrame:
    test, temp, conf = conformal_test(spark, folder)
    rep = interval_report(test, "y_real", "cp_point", "cp_lower", "cp_upper", by=["segment"])
    rep = attach(rep, temp.params.select("temperature"))
    rep = attach(rep, conf.params.select("q_hat"))
    return rep.select(
        "segment", "n", rounded("coverage").alias("coverage"), "verdict",
        rounded("mean_width").alias("mean_width"),
        rounded("width_pct_range").alias("width_pct_range"),
        rounded("width_std").alias("width_std"),
        rounded("error_width_spearman").alias("error_width_spearman"),
        rounded("temperature").alias("temperature"), rounded("q_hat").alias("q_hat"))


# ---- phase 4: intervals and calibration -------------------------------------

def gaussian_interval_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Per test row: calibrated 1.96-sigma interval on the real scale."""
    pred, _ = calibrated_predictions(spark, folder, "user_id")
    test = gaussian_interval(pred.where(F.col("split") == "test"), log_var="log_var_cal",
                             z=GAUSS_Z, transform="log1p")
    return test.select("key", rounded(inverse(F.col("y"), "log1p")).alias("truth"),
                       rounded("point").alias("point"), rounded("lower").alias("lower"),
                       rounded("upper").alias("upper"), rounded("width").alias("width"))


def nll_before_after_report(spark: SparkSession, folder: str) -> DataFrame:
    pred, _ = calibrated_predictions(spark, folder, "user_id")
    rep = nll_before_after(pred.where(F.col("split") == "test"), "y", "mu", "log_var", "log_var_cal")
    return rep.select("n", *[rounded(c).alias(c) for c in
                             ("nll_raw", "nll_cal", "improvement", "coverage_model_scale")])


def mse_report(spark: SparkSession, folder: str) -> DataFrame:
    """Squared error of the per-user mean, summed and averaged, per split."""
    frame = events_frame(spark, folder)
    pred = fit_group_gaussian(frame, by=["user_id"]).transform(frame)
    error = F.pow(F.col("y") - F.col("mu"), 2)
    return pred.groupBy("split").agg(F.count(error).alias("n"), rounded(F.sum(error)).alias("sse"), rounded(F.avg(error)).alias("mse"))


def temperature_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Temperature per event type (validation rows) for the per-user Gaussian."""
    pred, _ = calibrated_predictions(spark, folder, "user_id")
    temp = fit_temperature(pred, by=["segment"])
    return temp.params.select("segment", rounded("bias").alias("bias"),
                              rounded("temperature").alias("temperature"), "n_cal")


def temperature_batched(spark: SparkSession, folder: str) -> DataFrame:
    """Temperature from per-batch means over validation batches of 256 in key order."""
    pred, _ = calibrated_predictions(spark, folder, "user_id")
    temp = fit_temperature_batched(pred, "key")
    return temp.params.select(rounded("bias").alias("bias"),
                              rounded("temperature").alias("temperature"), "n_cal")


def conformal_interval(spark: SparkSession, folder: str) -> DataFrame:
    test, _, conf = conformal_test(spark, folder, "user_id")
    cov = test.agg(F.count("y_real").alias("n"),
                   F.avg(inside("y_real", "cp_lower", "cp_upper").cast("double")).alias("coverage"),
                   F.avg("cp_width").alias("mean_width"))
    cov = cov.withColumn("verdict", band("coverage", COVERAGE_LOW, COVERAGE_HIGH, COVERAGE_VERDICTS))
    rep = attach(cov, conf.params)
    return rep.select("n", rounded("coverage").alias("coverage"), "verdict",
                      rounded("q_hat").alias("q_hat"), "n_cal", "rank",
                      rounded("mean_width").alias("mean_width"))


def conformal_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    """q_hat per event type on validation; coverage per event type on test."""
    pred, _ = calibrated_predictions(spark, folder, "user_id")
    conf = fit_conformal(pred, by=["segment"])
    test = conf.transform(pred.where(F.col("split") == "test"), transform="log1p")
    test = test.withColumn("y_real", inverse(F.col("y"), "log1p"))
    cov = coverage_verdict(test, "y_real", "cp_lower", "cp_upper", by=["segment"])
    # a segment without validation rows has no q_hat: its test rows count as missed
    rep = cov.join(conf.params, on="segment", how="left")
    return rep.select("segment", "n", rounded("coverage").alias("coverage"), "verdict",
                      rounded("q_hat").alias("q_hat"), "n_cal", "rank")


def asymmetric_bars_rows(spark: SparkSession, folder: str) -> DataFrame:
    test, _, _ = conformal_test(spark, folder, "user_id")
    bars = asymmetric_bars(test, "cp_point", "cp_lower", "cp_upper")
    return bars.select("key", rounded("err_low").alias("err_low"),
                       rounded("err_high").alias("err_high"))


# ---- phase 5: audits ----------------------------------------------------------

def coverage_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """1.96-sigma coverage before and after temperature, on validation and test."""
    pred, _ = calibrated_predictions(spark, folder, "user_id")
    raw = gaussian_interval(pred, log_var="log_var", transform="log1p", prefix="r_")
    both = gaussian_interval(raw, log_var="log_var_cal", transform="log1p", prefix="c_")
    both = both.withColumn("y_real", inverse(F.col("y"), "log1p"))
    # both stages in one pass: stack (stage, lower, upper) per row, then one grouped audit
    stacked = both.select("split", "y_real", F.explode(F.array(
        F.struct(F.lit("raw").alias("stage"), F.col("r_lower").alias("lower"), F.col("r_upper").alias("upper")),
        F.struct(F.lit("calibrated").alias("stage"), F.col("c_lower").alias("lower"),
                 F.col("c_upper").alias("upper")))).alias("s")).select("split", "y_real", "s.*")
    rep = coverage_verdict(stacked, "y_real", "lower", "upper", by=["split", "stage"])
    return rep.select("split", "stage", "n", rounded("coverage").alias("coverage"), "verdict")


def sharpness_report(spark: SparkSession, folder: str) -> DataFrame:
    test, _, _ = conformal_test(spark, folder, "user_id")
    rep = sharpness_audit(test, "y_real", "cp_point", "cp_lower", "cp_upper")
    return rep.select("n", *[rounded(c).alias(c) for c in
                             ("mean_width", "width_pct_range", "width_std", "error_width_spearman")])


def spearman_width_error(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation of width and absolute error, per event type and overall."""
    test, _, _ = conformal_test(spark, folder, "user_id")
    rows = test.select("segment", F.col("cp_width").alias("width"),
                       F.abs(F.col("y_real") - F.col("cp_point")).alias("abs_error"))
    per = spearman(rows, "width", "abs_error", by=["segment"])
    overall = spearman(rows, "width", "abs_error").select(F.lit("ALL").alias("segment"), "spearman")
    return per.unionByName(overall).select("segment", rounded("spearman").alias("spearman"))


def row_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    test, _, _ = conformal_test(spark, folder, "user_id")
    rv = row_verdict(test, "key", "y_real", "cp_point", "cp_lower", "cp_upper")
    return rv.select("key", *[rounded(c).alias(c) for c in
                              ("truth", "prediction", "range_low", "range_high")],
                     "inside", rounded("width").alias("width"), "verdict")


# ---- phase 3: plot tables over the calibrated intervals ------------------------

def top_by_truth(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 test rows with the lowest truth, with bars and their position (V4)."""
    test, _, _ = conformal_test(spark, folder, "user_id")
    top = top_by(test, ["y_real", "key"], 100)
    top = asymmetric_bars(top, "cp_point", "cp_lower", "cp_upper")
    top = sorted_positions(top, ["y_real", "key"])
    return top.select("position", "key", rounded("y_real").alias("truth"),
                      rounded("cp_point").alias("point"), rounded("err_low").alias("err_low"),
                      rounded("err_high").alias("err_high"))


def error_width_points(spark: SparkSession, folder: str) -> DataFrame:
    """(width, absolute error) of every test row (V3)."""
    test, _, _ = conformal_test(spark, folder, "user_id")
    return test.select("key", rounded("cp_width").alias("width"),
                    rounded(F.abs(F.col("y_real") - F.col("cp_point"))).alias("abs_error"))


def single_row_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """One hash-chosen test row: truth, point, range, inside, width, verdict (L4 + A8)."""
    test, _, _ = conformal_test(spark, folder, "user_id")
    rv = row_verdict(hash_sample(test, "key", 1), "key", "y_real", "cp_point", "cp_lower", "cp_upper")
    return rv.select("key", *[rounded(c).alias(c) for c in
                              ("truth", "prediction", "range_low", "range_high")],
                     "inside", rounded("width").alias("width"), "verdict")


def sample_sorted_band(spark: SparkSession, folder: str, n: int = 200) -> DataFrame:
    """A hash-chosen sample of test rows re-sorted by truth, with the band (V5)."""
    test, _, _ = conformal_test(spark, folder, "user_id")
    s = sorted_positions(hash_sample(test, "key", n), ["y_real", "key"])
    return s.select("position", "key", rounded("y_real").alias("truth"),
                    rounded("cp_point").alias("point"), rounded("cp_lower").alias("lower"),
                    rounded("cp_upper").alias("upper"))
