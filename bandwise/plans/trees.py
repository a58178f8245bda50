"""Phases 8 and 9: boosted mean and quantile models, isolation forest, combined scan.

Fixture: documents, features ln(words+1) and ln(lines+1) scaled on train,
raw target n_chars (the quantile notebook keeps its target raw).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.constants import BOOST_ROUNDS, CONTAMINATION, QUANTILE_ALPHAS
from bandwise.operators.audits import report_card
from bandwise.operators.boosting import fit_gbt_mean, fit_quantile_booster
from bandwise.operators.calibration import quantile_interval
from bandwise.operators.clustering import kmeans_on_columns
from bandwise.operators.ensembles import predict_all
from bandwise.operators.isolation import IsolationForest, fit_isolation_forest, scan, trust_label
from bandwise.operators.prep import assemble, fit_standardizer
from bandwise.operators.ranks import exact_percentile
from bandwise.session import cut_lineage
from bandwise.sources.fixtures import LINEITEM_FEATURES, documents_frame, lineitem_part_frame, orders_frame
from bandwise.sources.tables import read_table

FEATURES = ["x_words", "x_lines"]
# Registered queries run the API default of 100 rounds.
QUERY_ROUNDS = BOOST_ROUNDS


def tree_frame(spark: SparkSession, folder: str) -> DataFrame:
    # features come from whole texts: derive them once, write the narrow frame
    frame = cut_lineage(documents_frame(spark, folder).select(
        "key", "split", F.col("n_chars").alias("y"), *FEATURES), spread_out=True)
    frame = fit_standardizer(frame, FEATURES).transform(frame)
    # the loops iterate over the assembled vectors: write those once too
    return cut_lineage(assemble(frame, FEATURES).select("key", "split", "y", "features", *FEATURES))


def lineitem_tree_frame(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem x part, five features, target l_extendedprice (the volume fixture).

    The join runs once: its narrow result is written, then scaled and assembled."""
    frame = cut_lineage(lineitem_part_frame(spark, folder).select(
        "key", "split", "y", *LINEITEM_FEATURES), spread_out=True)
    frame = fit_standardizer(frame, LINEITEM_FEATURES).transform(frame)
    # the loops iterate over the assembled vectors: write those once too
    return cut_lineage(assemble(frame, LINEITEM_FEATURES).select("key", "split", "y", "features"))


def lineitem_quantile_pair(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS) -> DataFrame:
    """5% / 95% boosted pair on lineitem x part; report card on the test rows."""
    frame = lineitem_tree_frame(spark, folder).select("key", "split", "features", "y")
    lo, hi = fit_together(
        lambda: fit_quantile_booster(frame, "features", alpha=QUANTILE_ALPHAS[0], rounds=rounds),
        lambda: fit_quantile_booster(frame, "features", alpha=QUANTILE_ALPHAS[1], rounds=rounds))
    test = frame.where(F.col("split") == "test")
    test = predict_all(test, "features", {"q_lower": lo.flat(), "q_upper": hi.flat()})
    test = quantile_interval(test, "q_lower", "q_upper")
    return report_card(test, "y", "lower", "upper")


def lineitem_gbt_mean(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS) -> DataFrame:
    frame = lineitem_tree_frame(spark, folder).select("key", "split", "features", "y")
    model = fit_gbt_mean(frame, "features", rounds=rounds)
    test = model.setPredictionCol("predicted").transform(frame.where(F.col("split") == "test"))
    return test.agg(F.count("y").alias("n"),
                    F.sqrt(F.avg(F.pow(F.col("y") - F.col("predicted"), 2))).alias("rmse"))


def fit_together(*fits):
    """Run independent model fits as concurrent Spark jobs (driver threads)."""
    with ThreadPoolExecutor(max_workers=len(fits)) as pool:
        futures = [pool.submit(f) for f in fits]
        return [f.result() for f in futures]


def gbt_mean(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS) -> DataFrame:
    frame = tree_frame(spark, folder)
    model = fit_gbt_mean(frame, "features", rounds=rounds)
    test = model.setPredictionCol("predicted").transform(frame.where(F.col("split") == "test"))
    return test.select("key", "y", "predicted")


def quantile_boost(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS) -> DataFrame:
    """5% and 95% boosted quantile models; bounds and crossing flag per test row."""
    frame = tree_frame(spark, folder)
    lo, hi = fit_together(
        lambda: fit_quantile_booster(frame, "features", alpha=QUANTILE_ALPHAS[0], rounds=rounds),
        lambda: fit_quantile_booster(frame, "features", alpha=QUANTILE_ALPHAS[1], rounds=rounds))
    test = frame.where(F.col("split") == "test")
    test = predict_all(test, "features", {"q_lower": lo.flat(), "q_upper": hi.flat()})
    return quantile_interval(test, "q_lower", "q_upper").select(
        "key", "y", "lower", "upper", "width", "crossed")


def quantile_report_card(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS) -> DataFrame:
    q = quantile_boost(spark, folder, rounds)
    return report_card(q, "y", "lower", "upper")


def isolation_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Isolation forest fitted on train rows; score, weirdness and flag for every row."""
    frame = tree_frame(spark, folder)
    forest = fit_isolation_forest(frame, FEATURES, "key")
    scored = forest.flag(forest.score(frame.select("key", "split", *FEATURES)))
    return scored.select("key", "split", "iso_score", "weirdness_score", "is_anomaly")


def combined_scan(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS) -> DataFrame:
    """Mean, quantile pair and anomaly flag together for every test row (the scan)."""
    frame = tree_frame(spark, folder)
    mean, lo, hi, forest = fit_together(
        lambda: fit_gbt_mean(frame, "features", rounds=rounds),
        lambda: fit_quantile_booster(frame, "features", alpha=QUANTILE_ALPHAS[0], rounds=rounds),
        lambda: fit_quantile_booster(frame, "features", alpha=QUANTILE_ALPHAS[1], rounds=rounds),
        lambda: fit_isolation_forest(frame, FEATURES, "key"))
    return scan(frame.where(F.col("split") == "test"), "key", "features", mean, lo, hi, forest)


def _enhanced(spark: SparkSession, folder: str, rounds: int, k: int, starts: int):
    """Frame with the cluster id as a further feature, and the models refitted on it."""
    frame, _ = kmeans_on_columns(tree_frame(spark, folder), FEATURES, k=k, starts=starts)
    wide = frame.withColumn("cluster_id", F.col("cluster").cast("double"))
    cols = [*FEATURES, "cluster_id"]
    wide = cut_lineage(assemble(wide.drop("features"), cols).select(
        "key", "split", "y", "features", "cluster", *cols))
    models = fit_together(
        lambda: fit_gbt_mean(wide, "features", rounds=rounds),
        lambda: fit_quantile_booster(wide, "features", alpha=QUANTILE_ALPHAS[0], rounds=rounds),
        lambda: fit_quantile_booster(wide, "features", alpha=QUANTILE_ALPHAS[1], rounds=rounds),
        lambda: fit_isolation_forest(wide, cols, "key"))
    return wide, models


def enhanced_scan(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS,
                  k: int = 50, starts: int = 10) -> DataFrame:
    """The scan again with a k-means cluster id as an extra feature.

    k-means (k=50, best of 10 seeds) on the two scaled coordinates chosen by
    name; the id is appended as a numeric feature (original columns kept),
    then the mean, the quantile pair and the isolation forest are refitted
    on the wider features and every test row is scanned.
    """
    wide, (mean, lo, hi, forest) = _enhanced(spark, folder, rounds, k, starts)
    test = wide.where(F.col("split") == "test")
    out = scan(test, "key", "features", mean, lo, hi, forest)
    return out.join(test.select("key", "cluster"), on="key", how="inner")


def enhanced_report_card(spark: SparkSession, folder: str, rounds: int = QUERY_ROUNDS,
                         k: int = 50, starts: int = 10) -> DataFrame:
    """The report card of the pair refitted with the cluster id: coverage and width on the test rows."""
    wide, (_, lo, hi, _) = _enhanced(spark, folder, rounds, k, starts)
    test = predict_all(wide.where(F.col("split") == "test"), "features", {"q_lower": lo.flat(), "q_upper": hi.flat()})
    return report_card(quantile_interval(test, "q_lower", "q_upper"), "y", "lower", "upper")


def anomaly_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Cut, weirdness, flag and trust label of given scores (order totals): the part of the scan after the forest."""
    orders = orders_frame(spark, folder)
    cut = exact_percentile(orders.where(F.col("split") == "train"), "y", 1.0 - CONTAMINATION, out="q").first()["q"]
    forest = IsolationForest([], None, 1, float(cut))
    return forest.flag(orders, "y").select("key", F.round("weirdness_score", 6).alias("weirdness_score"), "is_anomaly",
                                           trust_label().alias("trust"))


def crossing_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds that cross on some rows of lineitem, as they are and repaired."""
    rows = read_table(spark, folder, "lineitem", ["l_extendedprice", "l_discount", "l_quantity"]).select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("q_lower"),
        (F.col("l_quantity").cast("double") * 1500.0).alias("q_upper"))
    raw = quantile_interval(rows, "q_lower", "q_upper").withColumnRenamed("width", "raw_width").drop("lower", "upper")
    both = quantile_interval(raw, "q_lower", "q_upper", repair=True)
    return both.groupBy("crossed").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("raw_width"), 4).alias("mean_raw_width"),
        F.round(F.avg("width"), 4).alias("mean_width"), F.sum((F.col("lower") > F.col("upper")).cast("int")).alias("n_crossed_after"))
