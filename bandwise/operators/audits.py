"""Audits and reports (A1-A8): one row per segment, numbers plus a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.columns import band, safe_div
from bandwise.functions.constants import (
    COVERAGE_HIGH, COVERAGE_LOW, COVERAGE_VERDICTS, REPORT_TARGET, REPORT_TOLERANCE,
    REPORT_VERDICTS, ROW_VERDICTS, SKEW_LIMIT, SKEW_VERDICTS, SPREAD_HIGH, SPREAD_LOW,
    SPREAD_VERDICTS,
)
from bandwise.operators.gaussian import nll
from bandwise.operators.params import join_reports
from bandwise.operators.stats import median, spearman


def inside(y: str, lower: str, upper: str):
    """Inclusive containment lower <= y <= upper (P10); a row without bounds isn't inside. Null
    only where the truth is."""
    hit = (F.col(y) >= F.col(lower)) & (F.col(y) <= F.col(upper))
    return F.when(F.col(y).isNotNull(), F.coalesce(hit, F.lit(False)))


def coverage_verdict(df: DataFrame, y: str = "y", lower: str = "lower", upper: str = "upper",
                     by=(), low: float = COVERAGE_LOW, high: float = COVERAGE_HIGH) -> DataFrame:
    """Share of rows inside their interval, and the calibration verdict (A1)."""
    # rows without bounds count as missed
    rep = df.groupBy(*by).agg(F.count(F.col(y)).alias("n"),
                              F.avg(inside(y, lower, upper).cast("double")).alias("coverage"))
    return rep.withColumn("verdict", band("coverage", low, high, COVERAGE_VERDICTS))


def sharpness_audit(df: DataFrame, y: str = "y", point: str = "point", lower: str = "lower",
                    upper: str = "upper", by=()) -> DataFrame:
    """Mean width, width as % of the target range, width spread, and the Spearman
    correlation of width with absolute error (A3)."""
    by = list(by)
    rows = df.select(*by, F.col(y).alias("_y"), (F.col(upper) - F.col(lower)).alias("width"),
                     F.abs(F.col(y) - F.col(point)).alias("abs_error"))
    base = rows.groupBy(*by).agg(
        F.count("_y").alias("n"),
        F.avg("width").alias("mean_width"),
        (F.lit(100.0) * safe_div(F.avg("width"), F.max("_y") - F.min("_y"))).alias("width_pct_range"),
        F.stddev_pop("width").alias("width_std"))
    rho = spearman(rows, "width", "abs_error", by, out="error_width_spearman")
    return join_reports(base, rho, by)


def interval_report(df: DataFrame, y: str = "y", point: str = "point", lower: str = "lower",
                    upper: str = "upper", by=(), low: float = COVERAGE_LOW,
                    high: float = COVERAGE_HIGH) -> DataFrame:
    """Coverage with its verdict (A1) and the sharpness numbers (A3) from one pass over
    the rows (plus the rank passes of the Spearman correlation)."""
    by = list(by)
    rows = df.select(*by, F.col(y).alias("_y"), inside(y, lower, upper).cast("double").alias("_in"),
                     (F.col(upper) - F.col(lower)).alias("width"),
                     F.abs(F.col(y) - F.col(point)).alias("abs_error"))
    base = rows.groupBy(*by).agg(
        F.count("_y").alias("n"),
        F.avg("_in").alias("coverage"),
        F.avg("width").alias("mean_width"),
        (F.lit(100.0) * safe_div(F.avg("width"), F.max("_y") - F.min("_y"))).alias("width_pct_range"),
        F.stddev_pop("width").alias("width_std"))
    base = base.withColumn("verdict", band("coverage", low, high, COVERAGE_VERDICTS))
    rho = spearman(rows, "width", "abs_error", by, out="error_width_spearman")
    return join_reports(base, rho, by)


def report_card(df: DataFrame, y: str = "y", lower: str = "lower", upper: str = "upper", by=(),
                target: float = REPORT_TARGET, tolerance: float = REPORT_TOLERANCE) -> DataFrame:
    """Quantile-pair report card (A4): good when |coverage - target| < tolerance (strict)."""
    rep = df.groupBy(*by).agg(
        F.count(F.col(y)).alias("n"),
        F.avg(inside(y, lower, upper).cast("double")).alias("coverage"),
        F.avg(F.col(upper) - F.col(lower)).alias("mean_width"),
        F.avg(F.col(y)).alias("mean_target"))
    return (rep.withColumn("relative_width_pct", F.lit(100.0) * safe_div("mean_width", "mean_target"))
            .withColumn("verdict", F.when(F.abs(F.col("coverage") - F.lit(target)) < F.lit(tolerance),
                                          F.lit(REPORT_VERDICTS[0]))
                        .when(F.col("coverage").isNotNull(), F.lit(REPORT_VERDICTS[1]))))


def nll_before_after(df: DataFrame, y: str = "y", mu: str = "mu", raw: str = "log_var",
                     cal: str = "log_var_cal", z: float = 1.96, by=()) -> DataFrame:
    """NLL with raw and calibrated log-variance, the improvement, and coverage of the
    calibrated z-interval on the model scale (A2)."""
    sig = F.exp(F.lit(0.5) * F.col(cal))
    hit = ((F.col(y) >= F.col(mu) - F.lit(z) * sig) & (F.col(y) <= F.col(mu) + F.lit(z) * sig))
    hit = F.when(F.col(y).isNotNull(), F.coalesce(hit, F.lit(False)))
    rep = df.groupBy(*by).agg(
        F.count(F.col(y)).alias("n"),
        F.avg(nll(y, mu, raw)).alias("nll_raw"),
        F.avg(nll(y, mu, cal)).alias("nll_cal"),
        F.avg(hit.cast("double")).alias("coverage_model_scale"))
    return rep.withColumn("improvement", F.col("nll_raw") - F.col("nll_cal"))


def spread_diagnosis(df: DataFrame, std: str = "mc_std", by=(), low: float = SPREAD_LOW,
                     high: float = SPREAD_HIGH) -> DataFrame:
    """Mean per-row predictive std on the model scale, and its verdict (A5)."""
    rep = df.groupBy(*by).agg(F.count(F.col(std)).alias("n"), F.avg(std).alias("mean_std"))
    return rep.withColumn("verdict", band("mean_std", low, high, SPREAD_VERDICTS))


def skew_audit(df: DataFrame, value: str = "y", by=(), limit: float = SKEW_LIMIT) -> DataFrame:
    """Population skewness, mean, median and the skew verdict."""
    by = list(by)
    x = F.col(value).cast("double")
    rep = df.groupBy(*by).agg(F.count(x).alias("n"), F.skewness(x).alias("skewness"),
                              F.avg(x).alias("mean"))
    med = median(df, value, by)
    rep = join_reports(rep, med, by)
    return rep.withColumn("verdict", band("skewness", -limit, limit, SKEW_VERDICTS))


def row_verdict(df: DataFrame, key: str, y: str = "y", point: str = "point", lower: str = "lower",
                upper: str = "upper", scale: float = 1.0) -> DataFrame:
    """Per-row truth, point, range (times ``scale``), inside flag, width, verdict."""
    s = F.lit(float(scale))
    hit = inside(y, lower, upper)
    return df.select(
        key,
        (F.col(y) * s).alias("truth"), (F.col(point) * s).alias("prediction"),
        (F.col(lower) * s).alias("range_low"), (F.col(upper) * s).alias("range_high"),
        hit.alias("inside"), ((F.col(upper) - F.col(lower)) * s).alias("width"),
        F.when(hit, F.lit(ROW_VERDICTS[1])).otherwise(F.lit(ROW_VERDICTS[0])).alias("verdict"))
