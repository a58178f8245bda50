"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs``. Texts go to Python in small Arrow batches (``common.small_batches``, a setting that
the session keeps, since a stage's frame is evaluated after it has been returned). Rows with a null id can't be named by a decision: the filtering stages that
decide by id keep them.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.llm import decontam, neardup, packing, pii, toxicity
from bandwise.llm.common import free_name, small_batches, table, without_ids, written
from bandwise.llm.queries import SURROGATE_KEY, tokenizer_path, toxicity_chain


def _small(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@_small
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject (null and empty texts stay)."""
    return toxicity.keep_accepted(docs, toxicity_chain(docs, table(spark, sf_dir, "labels")))


@_small
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Of rows
    repeated whole under one id one stays."""
    found = written(neardup.near_duplicates(docs, words=5).where("doc_id is not null"), "near-copies")
    out = without_ids(docs, found.where("not kept").select("doc_id").distinct(), "doc_id")
    repeated = found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return out
    once = out.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return out.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(once)


@_small
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, written(found.select("doc_id").distinct(), "contaminated"), "doc_id")


@_small
def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the text."""
    replaced = free_name(docs.columns, "_replaced")
    out = pii.rewrite(docs, SURROGATE_KEY, replaced)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(replaced) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


@_small
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, with their token ids."""
    return packing.pack_documents(docs, tokenizer_path(), encode_special_tokens=False)


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("decontamination", drop_contaminated),
          ("personal data", replace_private), ("packing", pack)]

#: Learned scores, near copies and tokens are beyond SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
