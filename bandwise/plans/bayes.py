"""Phase 6: linear variational model on documents (ln chars on ln words)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.columns import rounded
from bandwise.operators.audits import spread_diagnosis
from bandwise.operators.calibration import asymmetric_bars
from bandwise.operators.stats import hash_sample
from bandwise.operators.prep import fit_standardizer
from bandwise.operators.variational import (
    credible_interval, fit_linear_posterior, posterior_kl,
)
from bandwise.session import cut_lineage
from bandwise.sources.fixtures import documents_frame

FEATURES = ["x_words"]


def scaled_documents(spark: SparkSession, folder: str):
    # features come from whole texts: derive them once, write the narrow frame
    frame = cut_lineage(documents_frame(spark, folder).select(
        "key", "segment", "split", "y", *FEATURES), spread_out=True)
    scaler = fit_standardizer(frame, FEATURES)
    return scaler.transform(frame)


def fitted(spark: SparkSession, folder: str):
    frame = scaled_documents(spark, folder)
    return frame, fit_linear_posterior(frame, FEATURES)


def linear_posterior(spark: SparkSession, folder: str) -> DataFrame:
    _, post = fitted(spark, folder)
    t = post.table(spark)
    return t.select("layer", "row", "col", "kind", "name", rounded("mu").alias("mu"),
                    rounded(F.log1p(F.exp("rho")), 9).alias("sigma"), rounded("rho").alias("rho"))


def posterior_kl_report(spark: SparkSession, folder: str) -> DataFrame:
    _, post = fitted(spark, folder)
    k = posterior_kl(post.table(spark))
    return k.select("n_weights", rounded("kl", 4).alias("kl"))


def mc_predictive_linear(spark: SparkSession, folder: str) -> DataFrame:
    """100-draw Monte Carlo mean and population std for every test document."""
    frame, post = fitted(spark, folder)
    pred = post.predictive(frame.where(F.col("split") == "test"))
    return pred.select("key", rounded("mc_mean").alias("mc_mean"), rounded("mc_std", 9).alias("mc_std"))


def credible_interval_rows(spark: SparkSession, folder: str) -> DataFrame:
    """exp(mean -/+ 2 std) around exp(mean), in characters, for every test document."""
    frame, post = fitted(spark, folder)
    pred = post.predictive(frame.where(F.col("split") == "test"))
    ci = credible_interval(pred, transform="log")
    return ci.select("key", rounded(F.exp("y")).alias("truth"), rounded("point").alias("point"),
                     rounded("lower").alias("lower"), rounded("upper").alias("upper"))


def spread_diagnosis_report(spark: SparkSession, folder: str) -> DataFrame:
    """Mean Monte Carlo std (log scale) per language, with the spread verdict."""
    frame, post = fitted(spark, folder)
    pred = post.predictive(frame.where(F.col("split") == "test"))
    rep = spread_diagnosis(pred, "mc_std", by=["segment"])
    return rep.select(F.col("segment").alias("lang"), "n", rounded("mean_std", 9).alias("mean_std"), "verdict")


def mc_sample_bars(spark: SparkSession, folder: str, n: int = 20) -> DataFrame:
    """20 hash-chosen test documents: truth, MC point and asymmetric bars (V6)."""
    frame, post = fitted(spark, folder)
    pred = post.predictive(hash_sample(frame.where(F.col("split") == "test"), "key", n))
    ci = asymmetric_bars(credible_interval(pred, transform="log"))
    return ci.select("key", rounded(F.exp("y")).alias("truth"), rounded("point").alias("point"),
                     rounded("err_low").alias("err_low"), rounded("err_high").alias("err_high"))
