"""Filters, ordinal encoding, feature assembly, hash splits, train-only scaling (P*, F1-F3, F7)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.columns import forward, split_label


def positive_filter(df: DataFrame, cols) -> DataFrame:
    """Keep rows whose columns are all > 0 (P1); nulls drop, as in SQL."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in cols]))


def ordinal_encode(df: DataFrame, levels: dict[str, list[str]], suffix: str = "_score") -> DataFrame:
    """String -> 1-based rank of its level; unknown or null -> 0."""
    out = df
    for name, order in levels.items():
        expr = None
        for i, level in enumerate(order, start=1):
            cond = F.col(name) == F.lit(level)
            expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
        out = out.withColumn(f"{name}{suffix}", expr.otherwise(F.lit(0)).cast("int"))
    return out


def ordinal_sql(levels: dict[str, list[str]], suffix: str = "_score") -> str:
    """The same encoding as SQL over ``__THIS__`` (for an ML SQLTransformer stage)."""
    cases = []
    for name, order in levels.items():
        whens = " ".join(f"WHEN {name} = '{lv}' THEN {i}" for i, lv in enumerate(order, start=1))
        cases.append(f"CAST(CASE {whens} ELSE 0 END AS INT) AS {name}{suffix}")
    return "SELECT *, " + ", ".join(cases) + " FROM __THIS__"


def feature_pipeline(levels: dict[str, list[str]], numeric, out: str = "features",
                     handle_invalid: str = "error"):
    """Staged ML pipeline (P6): ordinal SQL stage, then the vector assembler."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer

    cols = [*numeric, *[f"{n}_score" for n in levels]]
    return Pipeline(stages=[SQLTransformer(statement=ordinal_sql(levels)),
                            VectorAssembler(inputCols=cols, outputCol=out,
                                            handleInvalid=handle_invalid)])


def assemble(df: DataFrame, cols, out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Feature vector column (P5); ``handle_invalid`` in error | skip | keep."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def hash_split(df: DataFrame, key: str, cuts=(60, 80), names=("train", "val", "test"),
               out: str = "split") -> DataFrame:
    """Deterministic split by md5 bucket of the key (F1 with cuts=(80,), F2 with (60, 80))."""
    return df.withColumn(out, split_label(key, cuts, names))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """Spark's seeded random split: fast, but no oracle can repeat it."""
    return df.randomSplit(list(weights), seed)


def with_target(df: DataFrame, source: str, kind: str = "identity", out: str = "y") -> DataFrame:
    return df.withColumn(out, forward(source, kind))


@dataclass
class Standardizer:
    """Train-only means and population stds; a zero std divides by 1."""

    means: dict
    stds: dict

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = df
        for c, m in self.means.items():
            s = self.stds[c]
            s = 1.0 if (s is None or s == 0.0) else s
            out = out.withColumn(f"{c}{suffix}", (F.col(c).cast("double") - F.lit(m)) / F.lit(s))
        return out

    def as_frame(self, spark):
        rows = [(c, float(self.means[c]), float(self.stds[c])) for c in self.means]
        return spark.createDataFrame(rows, "feature string, mean double, std double")


def fit_standardizer(df: DataFrame, cols, split_col: str | None = "split",
                     fit_on: str = "train") -> Standardizer:
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = src.agg(*aggs).first()
    return Standardizer({c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols})


def standardize_train_stats(df: DataFrame, cols, split_col: str = "split",
                            fit_on: str = "train") -> DataFrame:
    """The fitted means / stds as a table (one row per feature), lazily."""
    src = df.where(F.col(split_col) == fit_on)
    stacked = src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols
    ])).alias("s")).select("s.*")
    return stacked.groupBy("feature").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"),
        F.count(F.lit(1)).alias("n"))
