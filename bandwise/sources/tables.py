"""Scans (S1, S2): parquet tables of a folder, CSV with a declared schema, catalog tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Columns the driver tables carry that our fixtures read (pruned at the scan).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, folder: str, name: str, columns=None) -> DataFrame:
    """Parquet scan of ``folder/name.parquet``; ``columns`` prunes the ReadSchema."""
    path = os.path.join(folder, f"{name}.parquet")
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True) -> DataFrame:
    """CSV scan with a declared schema: no inference pass over the files."""
    return spark.read.schema(schema).option("header", str(header).lower()).csv(path)


REJECT = "_rejected_line"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV scan with a declared schema: lines with a value that isn't of its column's type, or with too few or
    too many values, are kept whole in rejects (line, file) and are no rows. Quotes within values are doubled; empty values are null.
    All columns are parsed, also where a query reads a few: else what is rejected would depend on the query.
    """
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reject = REJECT
    while reject.lower() in {n.lower() for n in want.names}:
        reject = "_" + reject
    raw = (spark.read.schema(StructType([*want.fields, StructField(reject, StringType())]))
           .option("header", str(header).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", reject)
           .option("escape", '"').option("multiLine", str(multi_line).lower()).option("columnPruning", "false").csv(path))
    bad = F.col(reject).isNotNull()
    # always true, but it reads every column: a value is parsed only where its column is read
    whole = F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in want.names]), F.lit(2)).isin(0, 1)
    return (raw.where(~bad & whole).drop(reject),
            raw.where(bad & whole).select(F.col(reject).alias("line"), F.input_file_name().alias("file")))


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
