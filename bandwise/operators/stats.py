"""Statistics behind the audits and plot tables (G*, W*, L*, V*)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.columns import col_of
from bandwise.functions.constants import HIST_BINS, KDE_GRID
from bandwise.operators.params import attach
from bandwise.operators.ranks import average_ranks, exact_percentile, row_numbers
from bandwise.session import cut_lineage


def moments(df: DataFrame, value: str, by=()) -> DataFrame:
    """n, mean, population std, population skewness (g1), min, max per group."""
    x = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"),
        F.skewness(x).alias("skewness"), F.min(x).alias("min"), F.max(x).alias("max"))


def median(df: DataFrame, value: str, by=()) -> DataFrame:
    return exact_percentile(df, value, 0.5, by, out="median").select(*by, "median")


def spearman(df: DataFrame, x: str, y: str, by=(), out: str = "spearman",
             parts: int | None = None) -> DataFrame:
    """Rank correlation with tie-averaged ranks; null when a side is constant.

    Rows become a table of counts of (by, x, y) first, written once. Each side's ranks come from its own counts, and the
    correlation from weighted moments of the joint counts, which meet the ranks by a join that no tied
    value can make uneven (broadcast if few, hot values apart if many). NaN counts as no value.
    """
    by = list(by)
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    keys = [f"_by{i}" for i in range(len(by))]
    rows = df.select(*[F.struct(F.col(c)).alias(k) for c, k in zip(by, keys)], a.alias("_x"), b.alias("_y"))
    rows = rows.where("_x is not null and _y is not null and not isnan(_x) and not isnan(_y)")
    joint = cut_lineage(rows.groupBy(*keys, "_x", "_y").agg(F.count(F.lit(1)).alias("_n")))
    ranked = joint
    for side, rank in (("_x", "_rx"), ("_y", "_ry")):
        ranked = attach(ranked, average_ranks(joint, side, keys, parts=parts, out=rank, weight="_n"), [*keys, side], "inner")
    # moments about the middle rank, which is the mean of all ranks of a group
    n = F.sum("_n")
    totals = joint.groupBy(*keys).agg(n.alias("_total"))
    ranked = attach(ranked, totals, keys, "inner")
    dx, dy = (F.col(c) - (F.col("_total") + 1) / F.lit(2.0) for c in ("_rx", "_ry"))
    rho = F.try_divide(F.sum(F.col("_n") * dx * dy), F.sqrt(F.sum(F.col("_n") * dx * dx)) * F.sqrt(F.sum(F.col("_n") * dy * dy)))
    found = ranked.groupBy(*keys).agg(rho.alias(out))
    if not by:
        return found
    # a group whose rows all lack a value has no correlation, but is a group
    return found.select(*[F.col(f"{k}.{c}").alias(c) for c, k in zip(by, keys)], out)


def histogram(df: DataFrame, value: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed on the right.

    A zero range uses [min-0.5, max+0.5], as numpy does. Empty bins are kept.
    """
    x = F.col(value).cast("double")
    rng = df.agg(F.min(x).alias("_lo0"), F.max(x).alias("_hi0"))
    rng = rng.select(
        F.when(F.col("_hi0") > F.col("_lo0"), F.col("_lo0")).otherwise(F.col("_lo0") - 0.5).alias("_lo"),
        F.when(F.col("_hi0") > F.col("_lo0"), F.col("_hi0")).otherwise(F.col("_hi0") + 0.5).alias("_hi"))
    rows = attach(df.select(x.alias("_x")).where(F.col("_x").isNotNull()), rng)
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    counts = (rows.withColumn("bin", F.least(F.floor((F.col("_x") - F.col("_lo")) / w).cast("int"),
                                             F.lit(bins - 1)))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    edges = attach(spark.range(bins).select(F.col("id").cast("int").alias("bin")), rng)
    edges = edges.select("bin",
                         (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                         (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"))
    return (edges.join(counts, on="bin", how="left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def density_curve(df: DataFrame, value: str, grid: int = KDE_GRID, cut: float = 0.0,
                  bins: int = HIST_BINS) -> DataFrame:
    """Gaussian kernel density, Scott bandwidth (sample std * n^(-1/5)), on ``grid``
    points from min - cut*h to max + cut*h (G12).

    Each Arrow batch adds its rows' kernels at every grid point in numpy and
    emits one vector; the vectors are summed by a vector aggregate, so only
    ``grid`` numbers per partition cross the shuffle. ``count_scale``
    rescales the density to histogram counts (n * bin width).
    """
    x = F.col(value).cast("double")
    src = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    st = src.agg(F.count("_x").alias("n"), F.stddev_samp("_x").alias("sd"),
                 F.min("_x").alias("mn"), F.max("_x").alias("mx")).first()
    n, sd, mn, mx = st["n"], st["sd"], st["mn"], st["mx"]
    spark = df.sparkSession
    schema = "point int, x double, density double, count_scale double"
    if not n or sd is None or sd == 0.0:
        return spark.createDataFrame([], schema)
    h = sd * float(n) ** -0.2
    g0 = mn - cut * h
    gs = (mx - mn + 2 * cut * h) / float(grid - 1)
    pts = g0 + np.arange(grid) * gs

    def run(batches):
        acc = np.zeros(grid)
        for pdf in batches:
            xs = pdf["_x"].to_numpy(dtype=float)
            for i in range(0, len(xs), 2048):
                z = (pts[None, :] - xs[i:i + 2048, None]) / h
                acc += np.exp(-0.5 * z * z).sum(axis=0)
        yield pd.DataFrame({"k": [acc]})

    summed = (src.mapInPandas(run, "k array<double>").select(array_to_vector("k").alias("v"))
              .agg(Summarizer.sum(F.col("v")).alias("s")))
    norm = float(n) * h * math.sqrt(2 * math.pi)
    binw = (mx - mn) / float(bins)
    return (summed.select(F.posexplode(vector_to_array("s")).alias("point", "_sum"))
            .select(F.col("point").cast("int").alias("point"),
                    (F.lit(g0) + F.col("point") * F.lit(gs)).alias("x"),
                    (F.col("_sum") / F.lit(norm)).alias("density"),
                    (F.col("_sum") / F.lit(norm) * F.lit(float(n)) * F.lit(binw)).alias("count_scale")))


def top_by(df: DataFrame, order_cols, n: int) -> DataFrame:
    """First n rows in a stated order (L1, L2): per-partition top-n, then a merge."""
    return df.orderBy(*[col_of(c) for c in order_cols]).limit(n)


def hash_sample(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """n rows without replacement, chosen by md5 of (seed, key); all rows if n >= count (L3)."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return df.withColumn("_bw_h", h).orderBy("_bw_h", key).limit(n).drop("_bw_h")


def sorted_positions(df: DataFrame, order_cols, out: str = "position") -> DataFrame:
    """1-based position in a stated order (W2), whatever the number of rows: dealt by the first column, numbered
    within buckets (``ranks.row_numbers``)."""
    first, *ties = order_cols
    return row_numbers(df, first, out, ties=ties)
