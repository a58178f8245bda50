"""Isolation forest (U1, U1b) and the combined uncertainty scan.

Liu, Ting and Zhou (2008). Each tree is grown on its own subsample of at most
``sample`` training rows, to depth ceil(log2(sample)), with a random feature
and a uniform random threshold between that feature's min and max in the
node. A row's path length is its leaf depth plus c(leaf size); the score is
s = 2^(-mean path / c(sample)). The anomaly cut is the (1 - contamination)
percentile of the training scores: weirdness = s - cut, anomaly when > 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.functions.constants import CONTAMINATION, FOREST_SAMPLE, FOREST_TREES, SEED, TRUST_LABELS
from bandwise.operators.boosting import flat_gbt
from bandwise.operators.ensembles import predict_all
from bandwise.operators.ranks import exact_percentile

EULER = 0.5772156649015329
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size int, depth int")


def c_factor(n):
    """Average path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(tree_id: int, x: np.ndarray, max_depth: int, seed: int) -> list:
    rng = np.random.default_rng([seed, tree_id])
    nodes = []   # [node, feature, threshold, left, right, size, depth]

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(idx), depth])
        if depth >= max_depth or len(idx) < 2:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if len(usable) == 0:
            return me
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= t
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][1:5] = [f, t, left, right]
        return me

    build(np.arange(len(x)), 0)
    return nodes


@dataclass
class IsolationForest:
    features: list
    nodes: pd.DataFrame        # NODE_SCHEMA rows, bounded by trees * 2^(depth+1)
    sample: int
    cut: float | None = None

    def _arrays(self):
        trees = []
        for _, g in self.nodes.groupby("tree"):
            g = g.sort_values("node")
            trees.append((g["feature"].to_numpy(np.int64), g["threshold"].to_numpy(float),
                          g["left"].to_numpy(np.int64), g["right"].to_numpy(np.int64),
                          (g["depth"].to_numpy(float) + c_factor(g["size"].to_numpy(float)))))
        return trees

    def score(self, df: DataFrame, out: str = "iso_score") -> DataFrame:
        """Adds s in (0, 1]; only the features go to Python, forest broadcast once per executor."""
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast(self._arrays())
        feats, denom = list(self.features), float(c_factor([self.sample])[0])

        @F.pandas_udf("double")
        def run(*columns: pd.Series) -> pd.Series:
            trees = bc.value
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            total = np.zeros(len(x))
            for feat, thr, left, right, leaf_len in trees:
                node = np.zeros(len(x), dtype=np.int64)
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    go = x[active, f] <= thr[node[active]]
                    node[active] = np.where(go, left[node[active]], right[node[active]])
                    active = feat[node] >= 0
                total += leaf_len[node]
            # a forest on one row tells nothing apart: every score is 1
            return pd.Series(np.power(2.0, -(total / len(trees)) / denom) if denom > 0 else np.ones(len(x)))

        return df.withColumn(out, run(*[F.col(c).cast("double") for c in feats]))

    def flag(self, df: DataFrame, score: str = "iso_score") -> DataFrame:
        """weirdness = s - cut (positive = odd); is_anomaly = weirdness > 0."""
        w = F.col(score) - F.lit(float(self.cut))
        return df.withColumn("weirdness_score", w).withColumn("is_anomaly", w > 0)


def fit_isolation_forest(df: DataFrame, features, key: str, trees: int = FOREST_TREES,
                         sample: int = FOREST_SAMPLE, contamination: float = CONTAMINATION,
                         seed: int = SEED, split_col: str | None = "split",
                         fit_on: str = "train") -> IsolationForest:
    """A forest in which every tree grows from exactly ``sample`` rows chosen by hash (all, of fewer): candidates
    under a hash bound are counted, and the bound is raised until no tree is short."""
    features = list(features)
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    src = src.select(key, *[F.col(c).cast("double").alias(c) for c in features])
    n = src.count()
    if n == 0:
        raise ValueError("no training rows")
    m = min(sample, n)
    # equal keys of different rows get hashes of their own; equal rows can stand for each other
    h = lambda *parts: (F.pmod(F.xxhash64(F.lit(seed), F.col(key), *[F.col(c) for c in features], *parts),
                               F.lit(1 << 53)).cast("double") / float(1 << 53))
    p, short = min(1.0, 2.0 * m / n), True     # bound of the hash under which a row is a candidate for a tree
    while short:
        q = min(1.0, trees * p)                # one hash tells most rows from the candidates of any tree
        picks = F.filter(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)),
                                     lambda t: F.struct(t.alias("tree"), h(t).alias("u"))),
                         lambda s: s["u"] < F.lit(p / q))
        cand = src.where(h(F.lit(-1)) < F.lit(q)).select(*features, key, F.explode(picks).alias("s")).select(*features, key, "s.*")
        sizes = [r["count"] for r in cand.groupBy("tree").count().collect()] if p < 1.0 else [m] * trees
        short = len(sizes) < trees or min(sizes) < m
        p = min(1.0, 4.0 * p) if short else p
    ranked = cand.withColumn("_rn", F.row_number().over(
        Window.partitionBy("tree").orderBy("u", key)))
    chosen = ranked.where(F.col("_rn") <= m).select("tree", *features)
    depth = int(math.ceil(math.log2(max(m, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rows = _grow(t, pdf[features].to_numpy(dtype=float), depth, seed)
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree", t)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32",
                           "right": "int32", "size": "int32", "depth": "int32"})

    nodes = chosen.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    forest = IsolationForest(features, nodes, m)
    scored = forest.score(src.select(*features)).select("iso_score").persist()  # read once a pass
    try:
        forest.cut = float(exact_percentile(scored, "iso_score", 1.0 - contamination, out="q").first()["q"])
    finally:
        scored.unpersist()
    return forest


def trust_label(flag: str = "is_anomaly"):
    """'uncommon' for flagged rows, else 'normal' (U3)."""
    return F.when(F.col(flag), F.lit(TRUST_LABELS[1])).otherwise(F.lit(TRUST_LABELS[0]))


def scan(df: DataFrame, key: str, features_col: str, mean_model, lower_model, upper_model,
         forest: IsolationForest, weird_limit: float | None = None,
         width_limit: float | None = None) -> DataFrame:
    """Per row: predicted value, safe range, range width, weirdness and anomaly flag.

    ``weird_limit`` / ``width_limit`` are optional extra flags, off by default.
    """
    cur = predict_all(df, features_col, {"predicted": flat_gbt(mean_model), "_lo": lower_model.flat(), "_hi": upper_model.flat()})
    cur = forest.flag(forest.score(cur))
    out = cur.select(
        key, "predicted",
        F.struct(F.col("_lo").alias("lower"), F.col("_hi").alias("upper")).alias("safe_range"),
        (F.col("_hi") - F.col("_lo")).alias("range_width"),
        F.col("weirdness_score"), F.col("is_anomaly"), trust_label().alias("trust"))
    if weird_limit is not None:
        out = out.withColumn("too_weird", F.col("weirdness_score") > F.lit(weird_limit))
    if width_limit is not None:
        out = out.withColumn("too_wide", F.col("range_width") > F.lit(width_limit))
    return out
