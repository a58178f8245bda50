"""Fitted interval models applied to a stream.

Every scoring step is a per-row expression with parameters fixed at fit time
(literals for global parameters, a stream-static join for per-segment ones),
so the same operators run unchanged on a streaming DataFrame. The coverage
monitor is the coverage audit per event-time window, with a watermark so its
state is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.columns import inverse
from bandwise.operators.audits import inside
from bandwise.operators.calibration import Conformal, Temperature
from bandwise.operators.gaussian import GroupGaussian


def score_stream(stream: DataFrame, model: GroupGaussian, temperature: Temperature,
                 conformal: Conformal, transform: str = "identity") -> DataFrame:
    """mu, calibrated sigma and conformal bounds (real scale) for each arriving row.

    Rows without a truth column (``y``) are scored too; ``y_real`` is added only
    when the truth is there (the coverage monitor needs it).
    """
    pred = temperature.transform(model.transform(stream))
    pred = pred.withColumn("sigma", F.exp(F.lit(0.5) * F.col("log_var_cal")))
    out = conformal.transform(pred, transform=transform)
    if "y" in stream.columns:
        out = out.withColumn("y_real", inverse(F.col("y"), transform))
    return out


def coverage_monitor(scored: DataFrame, ts: str, window: str = "1 hour",
                     watermark: str = "2 hours", by=()) -> DataFrame:
    """Share of rows inside their conformal interval per event-time window."""
    hit = inside("y_real", "cp_lower", "cp_upper").cast("double")
    # watermarks need TIMESTAMP (local-time TIMESTAMP_NTZ is read as session time)
    timed = scored.withColumn("_event_time", F.col(ts).cast("timestamp"))
    return (timed.withWatermark("_event_time", watermark)
            .groupBy(F.window("_event_time", window).alias("window"), *by)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("coverage"),
                 F.avg("cp_width").alias("mean_width")))
