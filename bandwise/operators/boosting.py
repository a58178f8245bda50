"""Boosted trees: squared-error mean model (M8) and quantile boosting (M9)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.constants import BOOST_DEPTH, BOOST_RATE, BOOST_ROUNDS, SEED
from bandwise.operators.ensembles import FlatTrees, flatten, predict_all
from bandwise.operators.ranks import exact_percentile
from bandwise.session import cut_lineage, for_loops

LEAF = "_bw_leaf"


def fit_gbt_mean(df: DataFrame, features_col: str, y: str = "y", rounds: int = BOOST_ROUNDS,
                 rate: float = BOOST_RATE, depth: int = BOOST_DEPTH, seed: int = SEED,
                 split_col: str | None = "split", fit_on: str = "train") -> GBTRegressionModel:
    """Spark's GBT with squared loss: same objective and shape, not tree-for-tree equal."""
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    gbt = GBTRegressor(featuresCol=features_col, labelCol=y, maxIter=rounds, stepSize=rate,
                       maxDepth=depth, lossType="squared", seed=seed)
    return gbt.fit(src)


@dataclass
class QuantileBooster:
    alpha: float
    init: float
    rate: float
    features_col: str
    trees: list = field(default_factory=list)   # (tree model, {leaf index: value})

    def flat(self) -> FlatTrees:
        """All trees as node arrays, leaves moved by ``rate`` times their quantile."""
        return flatten([t for t, _ in self.trees], [self.rate] * len(self.trees), self.init, [v for _, v in self.trees])

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        return predict_all(df, self.features_col, {out: self.flat()})


def flat_gbt(model: GBTRegressionModel) -> FlatTrees:
    """A boosted mean model as node arrays."""
    return flatten(model.trees, list(model.treeWeights))


def fit_quantile_booster(df: DataFrame, features_col: str, y: str = "y", alpha: float = 0.5,
                         rounds: int = BOOST_ROUNDS, rate: float = BOOST_RATE,
                         depth: int = BOOST_DEPTH, seed: int = SEED,
                         split_col: str | None = "split", fit_on: str = "train",
                         checkpoint_every: int = 10, accuracy: int = 10000) -> QuantileBooster:
    """Gradient boosting on the pinball loss.

    Start at the alpha-quantile of y. Each round fits a regression tree to the
    negative gradient (alpha where y > F, alpha - 1 otherwise); each leaf then
    moves by ``rate`` times the alpha-quantile of the residuals y - F it holds
    (a mergeable percentile sketch per leaf, so a huge leaf is no hot spot).
    Each round persists one frame, the rows with their leaves, on which the next prediction is a column; its
    lineage is cut by a reliable checkpoint every ``checkpoint_every`` rounds.
    """
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    src = src.select(features_col, F.col(y).cast("double").alias("_y")).where(F.col("_y").isNotNull())
    init = exact_percentile(src, "_y", alpha, out="q").first()["q"]
    model = QuantileBooster(alpha, float(init), rate, features_col)
    cur = for_loops(src).withColumn("_F", F.lit(float(init))).persist()
    grad = F.when(F.col("_y") > F.col("_F"), F.lit(alpha)).otherwise(F.lit(alpha - 1.0))
    kept = [cur]   # the frame that ``cur`` reads, and the one that replaces it
    try:
        for r in range(rounds):
            data = cur.withColumn("_g", grad)
            tree = DecisionTreeRegressor(featuresCol=features_col, labelCol="_g", maxDepth=depth,
                                         seed=seed + r, leafCol=LEAF).fit(data)
            # each row's leaf, computed once: read by the leaf quantiles and the next round
            m = tree.copy()
            m.setPredictionCol("_bw_tp")
            leaves = m.transform(cur).drop("_bw_tp").persist()
            kept.append(leaves)
            vals = {row[LEAF]: row["v"] for row in leaves.groupBy(LEAF).agg(
                F.percentile_approx(F.col("_y") - F.col("_F"), alpha, accuracy).alias("v")).collect()}
            kept.pop(0).unpersist()
            model.trees.append((tree, vals))
            if r == rounds - 1:
                break                      # the state after the last tree is never read
            pairs = []
            for leaf, v in sorted(vals.items()):
                pairs += [F.lit(float(leaf)), F.lit(float(v))]
            step = F.lit(float(rate)) * F.coalesce(
                F.element_at(F.create_map(*pairs), F.col(LEAF)), F.lit(0.0))
            cur = leaves.withColumn("_F", F.col("_F") + step).drop(LEAF)
            if checkpoint_every and (r + 1) % checkpoint_every == 0:
                cur = cut_lineage(cur).persist()
                kept.append(cur)
                kept.pop(0).unpersist()
    finally:
        for frame in kept:
            frame.unpersist()
    return model
