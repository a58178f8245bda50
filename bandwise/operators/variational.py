"""Mean-field variational linear model (M1-M5) in closed form.

Loss: E_q[SSE] + kl_weight * KL(q || N(0, 1)) with q = prod_j N(mu_j, sigma_j^2),
sigma_j = softplus(rho_j). With A = X'X, c = X'y (bias column included):

    mu = (A + kl_weight/2 * I)^-1 c,      sigma_j^2 = kl_weight / (kl_weight + 2 A_jj)

A and c come from one aggregate over the training rows; the p x p solve is on
the driver (p is the feature count, never the row count).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.columns import hash_normal, inverse, softplus
from bandwise.functions.constants import CREDIBLE_K, MC_DRAWS, SEED

BIAS = "bias"


def kl_to_standard_normal(mu, sigma):
    """0.5 * sum(mu^2 + sigma^2 - 2 ln sigma - 1) (M1)."""
    mu, sigma = np.asarray(mu), np.asarray(sigma)
    return float(0.5 * np.sum(mu ** 2 + sigma ** 2 - 2 * np.log(sigma) - 1))


@dataclass
class LinearPosterior:
    features: list
    mu: np.ndarray       # features..., bias last
    sigma: np.ndarray
    kl_weight: float
    n_train: int

    @property
    def names(self):
        return [*self.features, BIAS]

    def table(self, spark: SparkSession) -> DataFrame:
        """Posterior as rows (layer, row, col, kind, mu, rho)."""
        rows = []
        for j, name in enumerate(self.names):
            rho = float(np.log(np.expm1(self.sigma[j])))
            rows.append((0, 0, j, "bias" if name == BIAS else "weight", name,
                         float(self.mu[j]), rho))
        return spark.createDataFrame(
            rows, "layer int, row int, col int, kind string, name string, mu double, rho double")

    def draws(self, spark: SparkSession, n_draws: int = MC_DRAWS, seed: int = SEED) -> DataFrame:
        """Weight draws (draw, weight_id, value): mu + softplus(rho) * eps, with eps a
        repeatable Box-Muller normal of (seed, draw, weight_id) (M2)."""
        t = self.table(spark)
        d = t.select(F.explode(F.sequence(F.lit(0), F.lit(n_draws - 1))).alias("draw"),
                     F.col("col").alias("weight_id"), "mu", "rho")
        eps = hash_normal(F.lit(str(seed)), F.col("draw"), F.col("weight_id"))
        return d.select("draw", "weight_id", (F.col("mu") + softplus("rho") * eps).alias("value"))

    def predictive(self, df: DataFrame, n_draws: int = MC_DRAWS, seed: int = SEED,
                   mean: str = "mc_mean", std: str = "mc_std") -> DataFrame:
        """Monte Carlo predictive for every row (M4): mean and population std over the
        draws of x . w_d. Each draw is shared by all rows, so with W the draw matrix
        the per-row values are x . mean(W) and sqrt(x' Cov(W) x): per-row columns,
        no explode of rows by draws."""
        w = self.draws(df.sparkSession, n_draws, seed).collect()   # n_draws x p numbers
        p = len(self.names)
        mat = np.zeros((n_draws, p))
        for r in w:
            mat[r["draw"], r["weight_id"]] = r["value"]
        wbar = mat.mean(axis=0)
        cov = np.cov(mat, rowvar=False, bias=True).reshape(p, p)
        xs = [F.col(c).cast("double") for c in self.features] + [F.lit(1.0)]
        m = sum((x * F.lit(float(wbar[j])) for j, x in enumerate(xs)), F.lit(0.0))
        v = F.lit(0.0)
        for j in range(p):
            for k in range(p):
                v = v + xs[j] * xs[k] * F.lit(float(cov[j, k]))
        return df.withColumn(mean, m).withColumn(std, F.sqrt(F.greatest(v, F.lit(0.0))))

    def point(self, df: DataFrame, out: str = "mu") -> DataFrame:
        """Deterministic pass: the posterior means only."""
        xs = [F.col(c).cast("double") for c in self.features] + [F.lit(1.0)]
        return df.withColumn(out, sum((x * F.lit(float(self.mu[j])) for j, x in enumerate(xs)), F.lit(0.0)))


def credible_interval(df: DataFrame, mean: str = "mc_mean", std: str = "mc_std",
                      k: float = CREDIBLE_K, transform: str = "identity") -> DataFrame:
    """f^-1(mean -/+ k*std), point f^-1(mean): model spread only, no noise term (M5)."""
    return (df.withColumn("point", inverse(F.col(mean), transform))
            .withColumn("lower", inverse(F.col(mean) - F.lit(k) * F.col(std), transform))
            .withColumn("upper", inverse(F.col(mean) + F.lit(k) * F.col(std), transform)))


def gram_sums(df: DataFrame, features, y: str) -> tuple[int, np.ndarray, np.ndarray, float]:
    """(n, X'X, X'y, y'y) with a bias column last in X. Every task sums its Arrow batches as matrix products into one vector of
    (p + 2)(p + 1) / 2 numbers, p the columns of X; these are summed by place, partial sums first. Nulls count as
    not-a-number and show in the sums they belong to."""
    cols = [*features, y]
    k = len(cols) + 1
    upper = np.triu_indices(k)

    def sums(batches):
        total = np.zeros((k, k))
        for b in batches:
            x = np.column_stack([*(np.asarray(c.to_numpy(zero_copy_only=False), float) for c in b.columns), np.ones(b.num_rows)])
            total += x.T @ x
        if total[-1, -1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])], ["at", "v"])

    slim = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    found = slim.mapInArrow(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    full = np.zeros((k, k))
    for r in found:
        full[upper[0][r["at"]], upper[1][r["at"]]] = r["v"]
    full = full + np.triu(full, 1).T
    x = [*range(k - 2), k - 1]  # the truth stands before the bias
    return int(full[-1, -1]), full[np.ix_(x, x)], full[x, k - 2], float(full[k - 2, k - 2])


def fit_linear_posterior(df: DataFrame, features, y: str = "y", split_col: str | None = "split",
                         fit_on: str = "train", kl_weight: float | None = None) -> LinearPosterior:
    features = list(features)
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    n, a, c, _ = gram_sums(src.where(F.col(y).isNotNull()), features, y)
    if n == 0:
        raise ValueError("no training rows")
    lam = (1.0 / n) if kl_weight is None else float(kl_weight)
    mu = np.linalg.solve(a + 0.5 * lam * np.eye(len(c)), c)
    sigma = np.sqrt(lam / (lam + 2.0 * np.diag(a)))
    return LinearPosterior(features, mu, sigma, lam, n)


def posterior_kl(table: DataFrame) -> DataFrame:
    """KL of a posterior table to N(0, 1), summed over its weights (M1)."""
    s = softplus("rho")
    return table.agg(F.count(F.lit(1)).alias("n_weights"),
                     (F.lit(0.5) * F.sum(F.pow("mu", 2) + F.pow(s, 2) - 2 * F.log(s) - 1)).alias("kl"))
