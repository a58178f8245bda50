"""Phase 2 and 3 queries: preparation, statistics and plot tables."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.columns import forward, inverse, rounded
from bandwise.functions.constants import CONFORMAL_ALPHA, HIST_BINS, QUANTILE_ALPHAS
from bandwise.operators.audits import report_card, skew_audit
from bandwise.operators.calibration import conformal_rank
from bandwise.operators.prep import (
    feature_pipeline, fit_standardizer, hash_split, ordinal_encode, positive_filter, standardize_train_stats,
)
from bandwise.operators.ranks import exact_percentiles, order_statistic
from bandwise.operators.stats import density_curve, histogram
from bandwise.plans.calibration import conformal_test
from bandwise.sources.fixtures import LINEITEM_FEATURES, events_frame, lineitem_part_frame, orders_frame
from bandwise.session import ensure_checkpoint_dir
from bandwise.sources.tables import read_csv_checked, read_table

# --- fixed values: TPC-H order priorities, lowest rank first; "4-NOT SPECIFIED" is
# left out on purpose so that an unknown level shows the 0 score.
PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


def positive_filter_rows(spark: SparkSession, folder: str) -> DataFrame:
    c = read_table(spark, folder, "customer", ["c_custkey", "c_acctbal"])
    return positive_filter(c, ["c_custkey", "c_acctbal"])


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table written as CSV to the shared folder and read with its declared schema, with the number of rejected lines."""
    c = read_table(spark, folder, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    path = f"{ensure_checkpoint_dir(spark)}/customer-csv-{uuid.uuid4().hex}"
    c.write.option("header", "true").option("escape", '"').csv(path)
    rows, rejects = read_csv_checked(spark, path, c.schema)
    return rows.withColumn("n_rejected", F.lit(rejects.count()).cast("long"))


def ordinal_encode_rows(spark: SparkSession, folder: str) -> DataFrame:
    o = read_table(spark, folder, "orders", ["o_orderkey", "o_orderpriority"])
    enc = ordinal_encode(o, {"o_orderpriority": PRIORITY_LEVELS})
    return enc.select("o_orderkey", "o_orderpriority", "o_orderpriority_score")


def hash_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    o = read_table(spark, folder, "orders", ["o_orderkey"])
    three = hash_split(o, "o_orderkey").groupBy("split").count()
    d = read_table(spark, folder, "documents", ["doc_id"])
    two = hash_split(d, "doc_id", cuts=(80,), names=("train", "test")).groupBy("split").count()
    return (three.select(F.lit("orders").alias("table_name"), "split", F.col("count").alias("n"))
            .unionByName(two.select(F.lit("documents").alias("table_name"), "split",
                                    F.col("count").alias("n"))))


def standardize_train_stats_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Train-only mean and population std of the lineitem x part features."""
    frame = lineitem_part_frame(spark, folder)
    st = standardize_train_stats(frame, LINEITEM_FEATURES)
    return st.select("feature", rounded("mean").alias("mean"), rounded("std").alias("std"), "n")


def standardized_check(spark: SparkSession, folder: str) -> DataFrame:
    """After train-only scaling: per split, mean and population std of each scaled feature."""
    frame = lineitem_part_frame(spark, folder)
    scaler = fit_standardizer(frame, LINEITEM_FEATURES)
    scaled = scaler.transform(frame.select("split", *LINEITEM_FEATURES))
    stacked = scaled.select("split", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("z")) for c in LINEITEM_FEATURES
    ])).alias("s")).select("split", "s.*")
    return stacked.groupBy("split", "feature").agg(
        F.round(F.avg("z"), 6).alias("mean"), F.round(F.stddev_pop("z"), 6).alias("std"),
        F.count(F.lit(1)).alias("n"))


def target_transform_rows(spark: SparkSession, folder: str) -> DataFrame:
    """log1p and ln of every event value and their inverses (ln of 0 is null)."""
    ev = read_table(spark, folder, "events", ["event_id", "value"])
    return ev.select(
        "event_id",
        rounded(forward("value", "log1p"), 9).alias("y_log1p"),
        rounded(forward("value", "log"), 9).alias("y_log"),
        rounded(inverse(forward("value", "log1p"), "log1p"), 9).alias("back_log1p"),
        rounded(inverse(forward("value", "log"), "log"), 9).alias("back_log"))


def drop_select_rows(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem x part modelling frame: features, target, split; other columns dropped."""
    frame = lineitem_part_frame(spark, folder)
    return frame.drop("segment")


def skew_audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Skew audit of the event value raw, under log1p and under ln."""
    ev = read_table(spark, folder, "events", ["value"])
    stacked = ev.select(F.explode(F.array(
        F.struct(F.lit("identity").alias("transform"), forward("value", "identity").alias("x")),
        F.struct(F.lit("log1p").alias("transform"), forward("value", "log1p").alias("x")),
        F.struct(F.lit("log").alias("transform"), forward("value", "log").alias("x")),
    )).alias("s")).select("s.*")
    rep = skew_audit(stacked, "x", by=["transform"])
    return rep.select("transform", "n", rounded("skewness").alias("skewness"),
                      rounded("mean").alias("mean"), rounded("median").alias("median"), "verdict")


def width_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """30 equal-width bins of the conformal interval widths on test (V1)."""
    test, _, _ = conformal_test(spark, folder, "user_id")
    h = histogram(test, "cp_width", HIST_BINS)
    return h.select("bin", rounded("bin_lo").alias("bin_lo"), rounded("bin_hi").alias("bin_hi"), "count")


def target_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """30 equal-width bins of log1p(event value) over all rows (V2)."""
    frame = events_frame(spark, folder)
    h = histogram(frame, "y", HIST_BINS)
    return h.select("bin", rounded("bin_lo").alias("bin_lo"), rounded("bin_hi").alias("bin_hi"), "count")


def density_curve_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Gaussian KDE (Scott) of log1p(event value) on 200 points (V2)."""
    frame = events_frame(spark, folder)
    d = density_curve(frame, "y")
    return d.select("point", rounded("x", 9).alias("x"), rounded("density", 9).alias("density"),
                    rounded("count_scale", 6).alias("count_scale"))


def order_stat_quantile(spark: SparkSession, folder: str) -> DataFrame:
    """Conformal-rank order statistic of o_totalprice, per order status and overall."""
    o = read_table(spark, folder, "orders", ["o_orderstatus", "o_totalprice"])
    rank = lambda n: conformal_rank(n, CONFORMAL_ALPHA, "higher")
    per = order_statistic(o, "o_totalprice", rank, by=["o_orderstatus"], out="q_value")
    overall = order_statistic(o, "o_totalprice", rank, out="q_value")
    return per.unionByName(overall.select(F.lit("ALL").alias("o_orderstatus"), "q_value", "n", "r"))


def _group_quantile_bounds(frame: DataFrame) -> DataFrame:
    train = frame.where(F.col("split") == "train")
    return exact_percentiles(train, "y", {"q_lower": QUANTILE_ALPHAS[0], "q_upper": QUANTILE_ALPHAS[1]},
                             by=["segment"])


def group_quantile_interval(spark: SparkSession, folder: str) -> DataFrame:
    """5% and 95% train quantiles of l_extendedprice per part type (saturated quantile model)."""
    frame = lineitem_part_frame(spark, folder)
    b = _group_quantile_bounds(frame)
    return b.select("segment", rounded("q_lower").alias("q_lower"),
                    rounded("q_upper").alias("q_upper"), F.col("n").alias("n_train"))


def report_card_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Report card of the per-type quantile pair on the lineitem test rows (A4)."""
    frame = lineitem_part_frame(spark, folder)
    b = _group_quantile_bounds(frame).drop("n")
    test = frame.where(F.col("split") == "test").join(b, on="segment", how="inner")
    rep = report_card(test, "y", "q_lower", "q_upper", by=["segment"])
    return rep.select("segment", "n", rounded("coverage").alias("coverage"),
                      rounded("mean_width").alias("mean_width"),
                      rounded("mean_target").alias("mean_target"),
                      rounded("relative_width_pct").alias("relative_width_pct"), "verdict")


def assembled_features(spark: SparkSession, folder: str) -> DataFrame:
    """The staged pipeline over orders: ordinal stage, then the assembled vector, as an array."""
    orders = orders_frame(spark, folder)
    pipeline = feature_pipeline({"o_orderpriority": PRIORITY_LEVELS}, ["y"])
    made = pipeline.fit(orders).transform(orders).withColumn("a", vector_to_array("features"))
    return made.select("key", F.size("a").alias("width"), F.col("a")[0].alias("total"), F.col("a")[1].alias("priority"))
