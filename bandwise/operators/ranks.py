"""Exact ranks and order statistics without a single-task global window.

A window with no partition column runs in one task. Order statistics are found by radix
selection instead: a 64-bit code in the value's order, 16 bits of it counted a pass, so that only counts
are shuffled and no row is joined, sorted or written. Ranks of all values need an order: values are cut
into buckets at approximate quantiles (the cut points are the only numbers that reach the driver), every
window is partitioned by bucket, and bucket counts give the offsets. Approximation only affects balance, never the answer.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType

from bandwise.functions.columns import col_of
from bandwise.operators.params import BROADCAST_ROWS, attach, frozen, local_rows
from bandwise.session import cut_lineage

BUCKET = "_bw_bucket"

# Rows of one located prefix that the last pass counts by value without narrowing further.
PICK_ROWS = 1_000_000
# Bucket sizing: an exact step sorts one bucket's distinct values in one task.
ROWS_PER_BUCKET = 1_000_000   # target rows per bucket
BASE_PARTS = 64               # buckets from the first, combined count + sketch pass
MAX_PARTS = 65_536            # ceiling on buckets (cut points pulled to the driver)


def _clean(cuts) -> list[float]:
    return sorted({c for c in cuts if c is not None and not math.isnan(c) and not math.isinf(c)})


def auto_cut_points(df: DataFrame, value: str, parts: int | None = None) -> list[float]:
    """Cut points sized so one bucket holds about ROWS_PER_BUCKET rows.

    The row count and a coarse sketch come from one aggregate; a finer sketch
    pass runs only when the data needs more than BASE_PARTS buckets.
    """
    if parts:
        return cut_points(df, value, parts)
    probs = [i / BASE_PARTS for i in range(1, BASE_PARTS)]
    x = F.col(value).cast("double")
    row = df.agg(F.count(x).alias("n"),
                 F.percentile_approx(x, probs, 4 * BASE_PARTS * 16).alias("q")).first()
    need = -(-int(row["n"]) // ROWS_PER_BUCKET)
    if need <= BASE_PARTS:
        return _clean(row["q"] or [])
    return cut_points(df, value, min(MAX_PARTS, need))


def cut_points(df: DataFrame, value: str, parts: int) -> list[float]:
    """parts - 1 approximate quantile cuts (the only numbers that reach the driver)."""
    probs = [i / parts for i in range(1, parts)]
    if not probs:
        return []
    dbl = df.select(F.col(value).cast("double").alias("_bw_dbl"))
    return _clean(dbl.approxQuantile("_bw_dbl", probs, max(1e-5, 1.0 / (4 * parts))))


def bucketize(df: DataFrame, value: str, cuts: list[float], out: str = BUCKET) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0))
    tmp = "_bw_dbl"
    b = Bucketizer(splits=[-math.inf, *[float(c) for c in cuts], math.inf], inputCol=tmp,
                   outputCol=out, handleInvalid="keep")
    res = b.transform(df.withColumn(tmp, F.col(value).cast("double") + 0.0))  # a zero without sign
    return res.withColumn(out, F.col(out).cast("int")).drop(tmp)


def _with_value(df: DataFrame, value, by, more=()) -> tuple[DataFrame, str]:
    """The value keeps its own type: grouping, ordering and the exact pick use it
    as is (a 64-bit key stays exact). Only bucket choice goes through double,
    and rounding to double never breaks the order, so buckets stay ordered."""
    name = value if isinstance(value, str) else "_bw_value"
    d = df.select(*by, col_of(value).alias(name), *more)
    keep = F.col(name).isNotNull()
    if isinstance(d.schema[name].dataType, (DoubleType, FloatType)):
        keep = keep & ~F.isnan(F.col(name))
    return d.where(keep), name


def order_code(value: Column) -> Column:
    """A 64-bit integer in the order of a double (zeros equal): its IEEE bits, negated below zero.

    Built from exact operations: a division by a power of two and a product with 2^52. Not for NaN.
    """
    size = F.abs(value)
    exponent = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    part = size / F.pow(F.lit(2.0), exponent)
    # the logarithm may be off by one next to a power of two
    exponent = exponent + (part >= 2).cast("int") - ((part < 1) & (exponent > -1022)).cast("int")
    part = size / F.pow(F.lit(2.0), exponent)
    code = (exponent + 1022) * F.lit(1 << 52) + (part * F.lit(float(1 << 52))).cast("long")
    code = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(0x7FF << 52)).otherwise(code)
    return F.when(value < 0, -code).otherwise(code).cast("long")


def first_digit(value: Column) -> Column:
    """A bucket of a double by its sign and logarithm, 2048 to an octave, in the doubles' order. Not for NaN."""
    size = F.abs(value)
    step = F.floor(F.least(F.log2(size), F.lit(1024.0)) * 2048).cast("int") + (1075 * 2048 + 1)
    return F.when(size == 0, F.lit(0)).when(value > 0, step).otherwise(-step)


def _code_of(d: DataFrame, name: str) -> Column:
    """Whole numbers are their own code; other types go by their double, which keeps their order."""
    if isinstance(d.schema[name].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(name).cast("long")
    return order_code(F.col(name).cast("double"))


def _bounded(located: DataFrame) -> tuple[DataFrame, int]:
    """Where the wanted ranks lie, evaluated once, and the rows of the largest such place."""
    rows = located.limit(BROADCAST_ROWS + 1).toArrow()
    if rows.num_rows > BROADCAST_ROWS:  # many groups: they stay a table
        located = frozen(located, 0)
        return located, located.agg(F.max("_c")).first()[0]
    few = local_rows(located.sparkSession, rows, located.schema)
    return F.broadcast(few), max(rows.column("_c").to_pylist(), default=0)


def order_statistics(df: DataFrame, value, ranks: dict, by=(), parts: int | None = None) -> DataFrame:
    """Several exact order statistics in one go, per ``by`` group, by radix selection.

    ``ranks`` maps a name to an int or to a function from the group's row
    count (Column) to the wanted 1-based rank (Column). The first pass counts logarithmic buckets; if one that holds a
    wanted rank has more than ``PICK_ROWS`` rows, its order codes are counted 16 bits a pass. The last pass counts the
    distinct values of the located place. What is shuffled are counts after partial aggregation. A
    group null in ``by`` is a group. ``parts`` isn't used any more. Returns long rows ``by + [which, value, n, r]``.
    """
    by = list(by)
    d, name = _with_value(df, value, by)
    group = [f"_by{i}" for i in range(len(by))]  # structs, so that null groups meet by equality
    d = d.select(*[F.struct(F.col(c)).alias(k) for c, k in zip(by, group)], F.col(name).alias("_value"))
    d = d.withColumn("_first", first_digit(F.col("_value").cast("double"))).withColumn("_place", F.lit(0).cast("long"))
    wanted = F.array(*[
        F.struct(F.lit(which).alias("which"),
                 (F.lit(rank) if isinstance(rank, int) else rank(F.col("n"))).cast("bigint").alias("r"))
        for which, rank in ranks.items()])
    counts = d.groupBy(*group, "_first", "_place").agg(F.count(F.lit(1)).alias("_c"))
    seg = Window.partitionBy(*group) if group else Window.partitionBy()
    run = seg.orderBy("_first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("n", F.sum("_c").over(seg)).withColumn("_cum", F.sum("_c").over(run))
    located = counts.withColumn("_k", F.explode(wanted)).select(
        *group, "_first", "_place", "n", "_k.which", "_k.r", "_c", (F.col("_k.r") - F.col("_cum") + F.col("_c")).alias("_rl"))
    located, most = _bounded(located.where("_rl >= 1 and _rl <= _c"))
    pick = Window.partitionBy(*group, "which")
    told = [*group, "which", "n", "r", "_first", "_rl"]

    def narrowed(place: Column, out: str) -> DataFrame:
        """The counts of ``place`` over the located rows, and of them those that hold the wanted ranks."""
        run = pick.orderBy(out).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        held = d.join(located, [*group, "_first", "_place"]).groupBy(*told, place.alias(out)).agg(F.count(F.lit(1)).alias("_n"))
        return held.withColumn("_cum", F.sum("_n").over(run)).where(
            (F.col("_cum") - F.col("_n") < F.col("_rl")) & (F.col("_rl") <= F.col("_cum")))

    for shift in (32, 16, 0):
        if most <= PICK_ROWS:
            break
        code = F.shiftright(_code_of(d, "_value"), shift)
        located, most = _bounded(narrowed(code, "_next").select(
            *group, "_first", F.col("_next").alias("_place"), "which", "n", "r", F.col("_n").alias("_c"),
            (F.col("_rl") - F.col("_cum") + F.col("_n")).alias("_rl")))
        d = d.withColumn("_place", code)
    found = narrowed(F.col("_value"), "_found")
    return found.select(*[F.col(f"{k}.{c}").alias(c) for c, k in zip(by, group)], "which", F.col("_found").alias("value"), "n", "r")


def order_statistic(df: DataFrame, value, rank, by=(), parts: int | None = None,
                    out: str = "value") -> DataFrame:
    """The ``rank``-th smallest value (1-based) per ``by`` group: ``by + [out, n, r]``."""
    res = order_statistics(df, value, {"k": rank}, by, parts)
    return res.select(*by, F.col("value").alias(out), "n", "r")


def exact_percentiles(df: DataFrame, value, qs: dict, by=(), parts: int | None = None) -> DataFrame:
    """Linear-interpolated percentiles (numpy's default), exactly, several at once.

    ``qs`` maps an output column name to a fraction in [0, 1]. Returns
    ``by + [names..., n]``, one row per group.
    """
    by = list(by)
    ranks = {}
    for nm, q in qs.items():
        ranks[f"{nm}__lo"] = (lambda qq: lambda n: F.floor((n - 1).cast("double") * F.lit(qq)) + 1)(q)
        ranks[f"{nm}__hi"] = (lambda qq: lambda n: F.ceil((n - 1).cast("double") * F.lit(qq)) + 1)(q)
    long = order_statistics(df, value, ranks, by, parts)
    aggs = [F.max("n").alias("n")]
    for nm, q in qs.items():
        lo = F.max(F.when(F.col("which") == f"{nm}__lo", F.col("value")))
        hi = F.max(F.when(F.col("which") == f"{nm}__hi", F.col("value")))
        h = (F.max("n") - 1).cast("double") * F.lit(q)
        aggs.append((lo + (h - F.floor(h)) * (hi - lo)).alias(nm))
    return long.groupBy(*by).agg(*aggs)


def exact_percentile(df: DataFrame, value, q: float, by=(), parts: int | None = None,
                     out: str = "value") -> DataFrame:
    """Linear-interpolated percentile (numpy's default) per group, exactly."""
    res = exact_percentiles(df, value, {out: q}, by, parts)
    return res.select(*by, out, "n")


def _offsets(totals: DataFrame, by: list) -> DataFrame:
    """Rows of the group before each bucket, from bucket totals (a bounded number a group)."""
    seg = Window.partitionBy(*by) if by else Window.partitionBy()
    before = seg.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*by, BUCKET, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))


def average_ranks(df: DataFrame, value, by=(), parts: int | None = None,
                  out: str = "avg_rank", weight: str | None = None) -> DataFrame:
    """Average (tie-shared) rank of every distinct value, per group.

    A row counts ``weight`` times (a whole number). Returns ``by + [value, out]`` with one row per distinct value.
    """
    by = list(by)
    d, name = _with_value(df, value, by, () if weight is None else (weight,))
    # distinct values with their counts, written once: cut points, bucket
    # totals and the local running counts all read it
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    distinct = cut_lineage(d.groupBy(*by, name).agg(times.alias("_c")))
    cuts = auto_cut_points(distinct, name, parts)
    b = bucketize(distinct, name, cuts)
    offsets = _offsets(b.groupBy(*by, BUCKET).agg(F.sum("_c").alias("_t")), by)
    local = Window.partitionBy(*by, BUCKET).orderBy(name).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = b.withColumn("_cum", F.sum("_c").over(local))
    return (
        attach(ranked, offsets, [*by, BUCKET], "inner")
        .select(*by, name,
                (F.col("_off") + F.col("_cum") - (F.col("_c") - 1) / F.lit(2.0)).alias(out))
    )


def row_numbers(df: DataFrame, key: str, out: str = "position", parts: int | None = None, ties=()) -> DataFrame:
    """``df`` with the 1-based position of every row in the order of ``key``, then ``ties``, nulls first.

    Rows are dealt to buckets of ``key`` once and numbered there; bucket counts give what comes before. Rows
    of one key share a task, so a key that many rows share should be left to ``average_ranks``.
    """
    keyed = bucketize(df, key, auto_cut_points(df, key, parts)).withColumn(BUCKET, F.coalesce(BUCKET, F.lit(-1)))
    # a null key is in no bucket: Bucketizer keeps it as one past the last, which would sort it last
    keyed = keyed.withColumn(BUCKET, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.col(BUCKET)))
    offsets = _offsets(keyed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_t")), [])
    local = Window.partitionBy(BUCKET).orderBy(key, *ties)
    numbered = keyed.withColumn(out, F.row_number().over(local))
    return attach(numbered, offsets, [BUCKET], "left").withColumn(
        out, (F.col(out) + F.col("_off")).cast("bigint")).drop(BUCKET, "_off")
