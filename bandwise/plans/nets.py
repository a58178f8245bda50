"""Phase 10: the two nets, trained data-parallel, on documents.

Registered queries train for the API default of 2000 full-batch steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.constants import MEANVAR_STEPS
from bandwise.operators.audits import coverage_verdict
from bandwise.operators.blocks import fit_meanvar_net, fit_variational_net
from bandwise.operators.calibration import fit_conformal, fit_temperature
from bandwise.operators.prep import fit_standardizer
from bandwise.operators.variational import credible_interval
from bandwise.session import cut_lineage
from bandwise.sources.fixtures import documents_frame

FEATURES = ["x_words", "x_lines"]
NET_QUERY_STEPS = MEANVAR_STEPS


def scaled(spark: SparkSession, folder: str) -> DataFrame:
    # features come from whole texts: derive them once, write the narrow frame
    frame = cut_lineage(documents_frame(spark, folder).select(
        "key", "segment", "split", "y", *FEATURES), spread_out=True)
    return fit_standardizer(frame, FEATURES).transform(frame)


def variational_net(spark: SparkSession, folder: str, steps: int = NET_QUERY_STEPS) -> DataFrame:
    """6-64-32-1 style variational net (here 2 inputs); MC mean/std and the
    exp(mean -/+ 2 std) band for every test document."""
    frame = scaled(spark, folder)
    net = fit_variational_net(frame, FEATURES, steps=steps)
    pred = net.predictive(frame.where(F.col("split") == "test").select("key", "y", *FEATURES))
    ci = credible_interval(pred, transform="log")
    return ci.select("key", "y", "mc_mean", "mc_std", "point", "lower", "upper")


def net_training_log(spark: SparkSession, folder: str, steps: int = NET_QUERY_STEPS) -> DataFrame:
    frame = scaled(spark, folder)
    net = fit_variational_net(frame, FEATURES, steps=steps)
    return net.history_frame(spark)


def mean_logvar_net(spark: SparkSession, folder: str, steps: int = NET_QUERY_STEPS) -> DataFrame:
    """Mean + log-variance net, temperature and conformal calibration on validation,
    conformal bounds (real scale) for every test document."""
    frame = scaled(spark, folder)
    net = fit_meanvar_net(frame, FEATURES, steps=steps)
    # the forward pass is read by the temperature, conformal and output passes: write it once
    pred = cut_lineage(net.transform(frame.select("key", "split", "y", *FEATURES)))
    temp = fit_temperature(pred)
    pred = temp.transform(pred).withColumn("sigma", F.exp(0.5 * F.col("log_var_cal")))
    conf = fit_conformal(pred)
    test = conf.transform(pred.where(F.col("split") == "test"), transform="log")
    return test.select("key", "y", "mu", "log_var", "log_var_cal", "sigma",
                       "cp_point", "cp_lower", "cp_upper")


def mean_logvar_coverage(spark: SparkSession, folder: str, steps: int = NET_QUERY_STEPS) -> DataFrame:
    t = mean_logvar_net(spark, folder, steps).withColumn("y_real", F.exp("y"))
    return coverage_verdict(t, "y_real", "cp_lower", "cp_upper")


def mean_logvar_linear(spark: SparkSession, folder: str, steps: int = NET_QUERY_STEPS) -> DataFrame:
    """Linear mean and linear log-variance heads (no hidden layer), same trainer."""
    frame = scaled(spark, folder)
    net = fit_meanvar_net(frame, FEATURES, hidden=(), steps=steps)
    pred = net.transform(frame.where(F.col("split") == "test").select("key", "y", *FEATURES))
    return pred.select("key", "y", "mu", "log_var")
