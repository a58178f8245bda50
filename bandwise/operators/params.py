"""Attach fitted parameters to rows (J2): literals when global, an equi-join per segment."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.session import ensure_checkpoint_dir


#: Parameter rows that are held by the driver and broadcast; more are written and joined.
BROADCAST_ROWS = 10_000


def local_rows(spark, rows: pa.Table, schema) -> DataFrame:
    """A few rows that the driver holds, as a relation that no job has to compute."""
    return spark.createDataFrame(rows, schema) if rows.num_rows else spark.createDataFrame([], schema)


def frozen(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Fitted parameters, evaluated once and fixed from then on, whatever their number.

    They are written to the shared folder in one pass and read back; at most ``limit`` rows then
    become a local relation, which needs no file any more.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/params-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    rows = kept.limit(limit + 1).toArrow()
    return kept if rows.num_rows > limit else local_rows(spark, rows, df.schema)


#: A key that holds more than one in so many rows is hot: at most so many keys are.
HOT_SHARE = 1_000


def skew_join(df: DataFrame, table: DataFrame, by, how: str = "left") -> DataFrame:
    """Join with a table of one row per key, whose hot keys are met without a shuffle.

    Keys that hold more than one in ``HOT_SHARE`` of the rows (counted here, so at most that many) are taken out: their table
    rows are broadcast, and only the other rows are dealt by key. Keys null in ``by`` meet nothing.
    """
    by = list(by)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_bw_n")).where(
        F.expr(" and ".join(f"`{c}` is not null" for c in by)))
    counts = frozen(counts)
    total = counts.agg(F.sum("_bw_n")).first()[0] or 0
    hot = counts.where(F.col("_bw_n") > max(total / HOT_SHARE, BROADCAST_ROWS)).select(*by)
    rows = hot.toArrow()
    if not rows.num_rows:
        return df.join(table, by, how)
    hot = local_rows(df.sparkSession, rows, hot.schema)
    few = frozen(table.join(F.broadcast(hot), by, "left_semi"))
    cold = df.join(F.broadcast(hot), by, "left_anti").join(table, by, how)
    return df.join(F.broadcast(hot), by, "left_semi").join(F.broadcast(few), by, how).unionByName(cold)


def attach(df: DataFrame, params: DataFrame, by=(), how: str = "left") -> DataFrame:
    """Add the parameter columns to every row.

    Global parameters are one row: it is read to the driver (a few numbers)
    and becomes literals, so the row plan stays a single codegen stage.
    Per-segment parameters stay a DataFrame: up to ``BROADCAST_ROWS`` rows, counted here, are
    broadcast, so rows aren't shuffled on a few segment keys; more are joined on the
    keys by ``skew_join``, so no segment, however large, lands in one task.
    """
    by = list(by)
    if by:
        few = how in ("left", "inner", "left_semi") and params.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        if few:
            return df.join(F.broadcast(params), on=by, how=how)
        return skew_join(df, params, by, how) if how in ("left", "inner") else df.join(params, on=by, how=how)
    rows = params.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"global parameters must be one row, got {len(rows)}")
    row = rows[0].asDict()
    types = dict(params.dtypes)
    out = df
    for k, v in row.items():
        out = out.withColumn(k, F.lit(v).cast(types[k]))
    return out


def join_reports(left: DataFrame, right: DataFrame, by=(), how: str = "left") -> DataFrame:
    """Side-by-side join of two per-segment reports (one-row reports when ``by`` is empty)."""
    by = list(by)
    if by:
        return left.join(right, on=by, how=how)
    k = "_bw_report"
    return left.withColumn(k, F.lit(1)).join(right.withColumn(k, F.lit(1)), on=k, how=how).drop(k)
