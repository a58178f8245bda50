"""Per-group Gaussian model (M6a), Gaussian NLL (M7) and Gaussian intervals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.columns import inverse
from bandwise.functions.constants import GAUSS_Z
from bandwise.operators.params import attach, frozen


@dataclass
class GroupGaussian:
    """mu = group mean, log_var = ln(group population variance), from train rows.

    This is the exact optimum of the Gaussian NLL when the only feature is
    the group (the mean/log-variance heads are free per group).
    """

    params: DataFrame
    by: list

    def transform(self, df: DataFrame) -> DataFrame:
        return attach(df, self.params.select(*self.by, "mu", "log_var"), self.by)


def fit_group_gaussian(df: DataFrame, y: str = "y", by=(), split_col: str | None = "split",
                       fit_on: str = "train", min_var: float = 1e-12) -> GroupGaussian:
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    params = src.groupBy(*by).agg(
        F.avg(y).alias("mu"),
        F.log(F.greatest(F.var_pop(y), F.lit(min_var))).alias("log_var"),
        F.count(y).alias("n_fit"),
    )
    return GroupGaussian(frozen(params), list(by))


def nll(y: str = "y", mu: str = "mu", log_var: str = "log_var"):
    """Gaussian negative log-likelihood per row, no constant: 0.5*(lv + (y-mu)^2 e^-lv)."""
    return F.lit(0.5) * (F.col(log_var) + F.pow(F.col(y) - F.col(mu), 2) * F.exp(-F.col(log_var)))


def gaussian_interval(df: DataFrame, mu: str = "mu", log_var: str = "log_var", z: float = GAUSS_Z,
                      transform: str = "identity", prefix: str = "") -> DataFrame:
    """sigma = exp(lv/2); bounds mu -/+ z*sigma, then the inverse target transform."""
    sigma = F.exp(F.lit(0.5) * F.col(log_var))
    return (
        df.withColumn(f"{prefix}sigma", sigma)
        .withColumn(f"{prefix}point", inverse(F.col(mu), transform))
        .withColumn(f"{prefix}lower", inverse(F.col(mu) - F.lit(z) * sigma, transform))
        .withColumn(f"{prefix}upper", inverse(F.col(mu) + F.lit(z) * sigma, transform))
        .withColumn(f"{prefix}width", F.col(f"{prefix}upper") - F.col(f"{prefix}lower"))
    )
