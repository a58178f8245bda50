"""Shared helpers of the training-data operators."""

from __future__ import annotations


import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that one vectorised step inside a task handles at once.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only a local session (tests, bench) without that setting gets a folder of
    its own; on a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="bandwise-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def free_name(columns: list[str], name: str) -> str:
    """``name``, or it behind as many underscores as make it none of ``columns`` (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: evaluated once, and
    lost executors cost nothing that has been written."""
    path = fresh_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that one Arrow batch of whole texts holds at most.
TEXT_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """From now on the session's Arrow batches hold at most ``rows`` rows (fewer, if it says so already).

    A batch is held by the executor outside its heap and again by the Python worker, for every task, and Spark's
    10,000 rows of whole texts are tens of MB in each. The results don't depend on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_chunks(batches: Iterator[pa.RecordBatch], text_col: int = 1,
                chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``chars`` bytes of text, one row at least."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if size and size + n > chars:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def bounded_sample(df: DataFrame, most: int, id_col: str) -> DataFrame:
    """All rows, or about ``most`` of more: those whose id hashes lowest (the same on every run)."""
    n = df.count()
    if n <= most:
        return df
    cut = int(most / n * (1 << 40))
    return df.where(F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 40)) < cut)


def bounded_classes(df: DataFrame, most: int, least: int, id_col: str, positive: Column) -> DataFrame:
    """``bounded_sample`` in which neither class of ``positive`` falls below ``least`` rows, or all it has."""
    sizes = {bool(r["p"]): r["count"] for r in df.groupBy(positive.alias("p")).count().collect()}
    n = sum(sizes.values())
    if n <= most:
        return df
    cuts = {k: min(1.0, max(most / n, least / size)) for k, size in sizes.items()}
    cut = F.when(positive, F.lit(int(cuts.get(True, 1.0) * (1 << 40)))).otherwise(F.lit(int(cuts.get(False, 1.0) * (1 << 40))))
    return df.where(F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 40)) < cut)


#: Bits of a table of hashes: 8 MB, whatever the number of hashes.
TABLE_BITS = 26


def bit_table(hashes: DataFrame, column: str) -> bytes:
    """One bit for each of the hashes (64-bit numbers) of a column; 2048 bitmaps of 4 kB reach the driver at most.

    A set bit says "maybe": what passes must be joined exactly afterwards.
    """
    bit = F.shiftrightunsigned(column, 64 - TABLE_BITS) + 1
    rows = hashes.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    table = bytearray(1 << (TABLE_BITS - 3))
    for r in rows:
        at = (r["bucket"] - 1) * len(r["bits"])
        table[at:at + len(r["bits"])] = r["bits"]
    return bytes(table)


def in_table(table: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set."""
    bit = (hashes.view(np.uint64) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (np.frombuffer(table, np.uint8)[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def without_ids(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id isn't one of ``ids`` (a column of that name); null ids stay.

    A bit table tells most rows from the ids within their task; only rows whose id may be
    one of them are shuffled, however many rows stay.
    """
    ids = ids.select(F.col(id_col).cast(rows.schema[id_col].dataType).alias(id_col))
    table = rows.sparkSession.sparkContext.broadcast(bit_table(ids.select(F.xxhash64(id_col).alias("hash")), "hash"))

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_table(table.value, hashes.to_numpy()))

    flag = free_name(rows.columns, "_maybe")
    marked = rows.withColumn(flag, maybe(F.xxhash64(id_col)))
    met = marked.where(flag).join(ids, id_col, "left_anti").select(marked.columns)
    return marked.where(~F.col(flag)).unionByName(met).drop(flag)
