"""Phase 7: k-means feature and nearest centre on the embeddings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.columns import rounded
from bandwise.operators.clustering import fit_kmeans_feature, group_centroids, nearest_center
from bandwise.sources.fixtures import embeddings_frame


def nearest_center_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Centres = per-label mean of the train embeddings; every vector gets the nearest."""
    e = embeddings_frame(spark, folder)
    centers = group_centroids(e.where(F.col("split") == "train"), "embedding", "label")
    out = nearest_center(e, "embedding", centers)
    return out.select(F.col("key").alias("vec_id"), "label", "center",
                      rounded("distance").alias("distance"))


def kmeans_feature(spark: SparkSession, folder: str, k: int = 50, starts: int = 10) -> DataFrame:
    """k-means (k=50, best of 10 seeds) on train vectors; cluster id added to every row."""
    e = embeddings_frame(spark, folder).withColumn("features", array_to_vector("embedding"))
    feat = fit_kmeans_feature(e, "features", k=k, starts=starts)
    out = feat.transform(e)
    return out.select(F.col("key").alias("vec_id"), "split", "label", "cluster",
                      F.lit(feat.seed).alias("best_seed"), F.lit(float(feat.cost)).alias("train_cost"))
