"""Temperature scaling (C1), split conformal intervals (C2, C3), quantile pairs (I2), bars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.functions.columns import inverse
from bandwise.functions.constants import CONFORMAL_ALPHA, TEMPERATURE_BATCH
from bandwise.operators.params import attach, frozen
from bandwise.operators.ranks import order_statistic, row_numbers


#: Least mean squared score that a temperature is fitted to.
MIN_SQUARE = 1e-12


def _z2(y: str, mu: str, log_var: str) -> Column:
    return F.pow(F.col(y) - F.col(mu), 2) * F.exp(-F.col(log_var))


@dataclass
class Temperature:
    """lv' = lv + b with T = sqrt(exp(b)); params has columns by + [bias, temperature, n_cal]."""

    params: DataFrame
    by: list

    def transform(self, df: DataFrame, log_var: str = "log_var", out: str = "log_var_cal") -> DataFrame:
        p = self.params.select(*self.by, F.col("bias").alias("_bw_bias"))
        return attach(df, p, self.by).withColumn(out, F.col(log_var) + F.col("_bw_bias")).drop("_bw_bias")


def fit_temperature(df: DataFrame, y: str = "y", mu: str = "mu", log_var: str = "log_var",
                    by=(), split_col: str | None = "split", fit_on: str = "val") -> Temperature:
    """Exact minimiser of the validation Gaussian NLL over a log-variance shift.

    d/db sum 0.5*(lv + b + z^2 e^-b) = 0  gives  b = ln(mean z^2), one aggregate.
    """
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    # an exact fit has a mean square of zero: bounded, as the group Gaussian's variance is
    m = F.greatest(F.avg(_z2(y, mu, log_var)), F.lit(MIN_SQUARE))
    params = src.groupBy(*by).agg(F.log(m).alias("bias"), F.sqrt(m).alias("temperature"),
                                  F.count(F.lit(1)).alias("n_cal"))
    return Temperature(frozen(params), list(by))


def fit_temperature_batched(df: DataFrame, key: str, y: str = "y", mu: str = "mu",
                            log_var: str = "log_var", batch: int = TEMPERATURE_BATCH,
                            split_col: str | None = "split", fit_on: str = "val") -> Temperature:
    """Same shift, but the loss is a sum of per-batch means over batches of ``batch``
    rows in key order (the last, smaller batch weighs as much as a full one):
    b = ln(mean over batches of the batch mean of z^2).
    """
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    rows = row_numbers(src.select(F.col(key).alias("_bw_key"), _z2(y, mu, log_var).alias("_z2")), "_bw_key", "_pos")
    batched = (rows.withColumn("_b", F.floor((F.col("_pos") - 1) / F.lit(batch)))
               .groupBy("_b").agg(F.avg("_z2").alias("_m"), F.count(F.lit(1)).alias("_n")))
    m = F.greatest(F.avg("_m"), F.lit(MIN_SQUARE))
    params = batched.agg(F.log(m).alias("bias"), F.sqrt(m).alias("temperature"),
                         F.sum("_n").alias("n_cal"))
    return Temperature(frozen(params), [])


def conformal_rank(n: Column, alpha: float, rank: str = "higher") -> Column:
    """1-based rank of q_hat among n sorted scores.

    k = ceil((n+1)(1-alpha)). The notebook takes numpy's 'higher' quantile at
    level min(1, k/n), which is the (k+1)-th smallest when k < n and the
    largest otherwise; rank='standard' gives the textbook k-th.
    """
    k = F.ceil((n + F.lit(1)).cast("double") * (F.lit(1.0) - F.lit(float(alpha))))
    if rank == "higher":
        return F.when(k < n, k + 1).otherwise(n)
    if rank == "standard":
        return F.least(k, n)
    raise ValueError("rank must be 'higher' or 'standard'")


@dataclass
class Conformal:
    """params has columns by + [q_hat, n_cal, rank]."""

    params: DataFrame
    by: list

    def transform(self, df: DataFrame, mu: str = "mu", sigma: str = "sigma",
                  transform: str = "identity", prefix: str = "cp_") -> DataFrame:
        p = self.params.select(*self.by, F.col("q_hat").alias("_bw_q"))
        out = attach(df, p, self.by)
        # an infinite q_hat gives unbounded intervals, also at a sigma of zero
        half = F.when(F.col("_bw_q") == float("inf"), F.col("_bw_q")).otherwise(F.col("_bw_q") * F.col(sigma))
        lo, hi = F.col(mu) - half, F.col(mu) + half
        return (out.withColumn(f"{prefix}point", inverse(F.col(mu), transform))
                .withColumn(f"{prefix}lower", inverse(lo, transform))
                .withColumn(f"{prefix}upper", inverse(hi, transform))
                .withColumn(f"{prefix}width", F.col(f"{prefix}upper") - F.col(f"{prefix}lower"))
                .drop("_bw_q"))


def conformal_scores(y: str = "y", mu: str = "mu", sigma: str = "sigma") -> Column:
    """|y - mu| / sigma; at a sigma of zero an error scores infinity and an exact hit zero."""
    error = F.abs(F.col(y) - F.col(mu))
    at_zero = F.when(error > 0, F.lit(float("inf"))).when(error == 0, F.lit(0.0))
    return F.when(F.col(sigma) == 0, at_zero).otherwise(F.try_divide(error, F.col(sigma)))


def fit_conformal(df: DataFrame, y: str = "y", mu: str = "mu", sigma: str = "sigma",
                  alpha: float = CONFORMAL_ALPHA, by=(), rank: str = "higher",
                  split_col: str | None = "split", fit_on: str = "val",
                  parts: int | None = None) -> Conformal:
    """Normalised split conformal: q_hat = exact order statistic of |y-mu|/sigma."""
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    scored = src.select(*by, conformal_scores(y, mu, sigma).alias("_score"))
    q = order_statistic(scored, "_score", lambda n: conformal_rank(n, alpha, rank), by,
                        parts=parts, out="q_hat")
    params = q.select(*by, "q_hat", F.col("n").alias("n_cal"), F.col("r").alias("rank"))
    return Conformal(frozen(params), list(by))


def quantile_interval(df: DataFrame, lower: str, upper: str, repair: bool = False) -> DataFrame:
    """Bounds from two quantile models; width may be negative unless repaired."""
    crossed = F.col(lower) > F.col(upper)
    out = df.withColumn("crossed", crossed)
    if repair:
        lo, hi = F.least(F.col(lower), F.col(upper)), F.greatest(F.col(lower), F.col(upper))
        out = out.withColumn("lower", lo).withColumn("upper", hi)
    else:
        out = out.withColumn("lower", F.col(lower)).withColumn("upper", F.col(upper))
    return out.withColumn("width", F.col("upper") - F.col("lower"))


def asymmetric_bars(df: DataFrame, point: str = "point", lower: str = "lower",
                    upper: str = "upper") -> DataFrame:
    """Error bar lengths below and above the point."""
    return (df.withColumn("err_low", F.col(point) - F.col(lower))
            .withColumn("err_high", F.col(upper) - F.col(point)))
