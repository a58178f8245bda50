"""Modelling frames built from the driver tables: key, features, y, split (+ segment).

Each reads only the columns it needs (pruned at the parquet scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.columns import forward, split_label
from bandwise.sources.tables import read_table


def events_frame(spark: SparkSession, folder: str, transform: str = "log1p") -> DataFrame:
    """y = transform(value), segment = event_type, hash split on event_id (60/20/20)."""
    ev = read_table(spark, folder, "events", ["event_id", "user_id", "event_type", "value"])
    return ev.select(F.col("event_id").alias("key"), F.col("event_type").alias("segment"), "user_id",
                     F.col("value").cast("double").alias("value"),
                     forward("value", transform).alias("y"),
                     split_label("event_id").alias("split"))


def word_count(text_col: str = "text"):
    """Whitespace-separated pieces of the whole text (same rule as DuckDB's
    len(string_split_regex(text, '\\s+')))."""
    return F.size(F.split(F.col(text_col), r"\s+"))


def line_count(text_col: str = "text"):
    """Lines of the whole text: newline characters + 1 (no array is built)."""
    t = F.col(text_col)
    return F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1


def documents_frame(spark: SparkSession, folder: str) -> DataFrame:
    """x = ln(words + 1) over the whole text, y = ln(n_chars); segment = lang."""
    d = read_table(spark, folder, "documents", ["doc_id", "text", "lang", "n_chars"])
    return d.select(F.col("doc_id").alias("key"), F.col("lang").alias("segment"),
                    F.log(word_count("text").cast("double") + 1.0).alias("x_words"),
                    F.log(line_count("text").cast("double") + 1.0).alias("x_lines"),
                    F.col("n_chars").cast("double").alias("n_chars"),
                    forward("n_chars", "log").alias("y"),
                    split_label("doc_id").alias("split"))


def orders_frame(spark: SparkSession, folder: str) -> DataFrame:
    o = read_table(spark, folder, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return o.select(F.col("o_orderkey").alias("key"), "o_orderpriority",
                    F.col("o_totalprice").cast("double").alias("y"),
                    split_label("o_orderkey").alias("split"))


LINEITEM_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


def lineitem_part_frame(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem joined to part on the part key; target l_extendedprice.

    The key is the text of (orderkey, linenumber, partkey, suppkey). The join
    strategy is AQE's: part is broadcast only when its measured size allows.
    """
    li = read_table(spark, folder, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    pa = read_table(spark, folder, "part", ["p_partkey", "p_type", "p_size", "p_retailprice"])
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return j.select(key.alias("key"), F.col("p_type").alias("segment"),
                    *[F.col(c).cast("double").alias(c) for c in LINEITEM_FEATURES],
                    F.col("l_extendedprice").cast("double").alias("y"),
                    split_label(key).alias("split"))


def embeddings_frame(spark: SparkSession, folder: str) -> DataFrame:
    e = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    return e.select(F.col("vec_id").alias("key"),
                    F.col("embedding").cast("array<double>").alias("embedding"),
                    "label", split_label("vec_id").alias("split"))
