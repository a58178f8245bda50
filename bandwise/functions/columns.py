"""Column expressions shared by every operator (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "hash_bucket", "split_label", "forward", "inverse", "safe_div",
    "softplus", "relu", "band", "rounded", "as_double", "safe_corr",
    "hash_uniform", "hash_normal", "money", "percent",
]

TRANSFORMS = ("identity", "log", "log1p")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of the key's text.

    The same value comes out of DuckDB with
    ('0x'||substr(md5(key::varchar),1,8))::bigint % buckets.
    """
    h = F.conv(F.substring(F.md5(col_of(key).cast("string")), 1, 8), 16, 10)
    return (h.cast("bigint") % F.lit(buckets)).cast("int")


def split_label(key, cuts=(60, 80), names=("train", "val", "test")) -> Column:
    """Hash split: bucket < cuts[0] -> names[0], < cuts[1] -> names[1], ..."""
    if len(names) != len(cuts) + 1:
        raise ValueError("need one more name than cuts")
    b = hash_bucket(key, 100)
    expr = F.when(b < cuts[0], F.lit(names[0]))
    for cut, name in zip(cuts[1:], names[1:-1]):
        expr = expr.when(b < cut, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def forward(c, kind: str = "identity") -> Column:
    """Target transform. log of a value <= 0 is null (not -inf)."""
    x = col_of(c).cast("double")
    if kind == "identity":
        return x
    if kind == "log":
        return F.when(x > 0, F.log(x))
    if kind == "log1p":
        return F.when(x > -1, F.log1p(x))
    raise ValueError(f"transform must be one of {TRANSFORMS}")


def inverse(c, kind: str = "identity") -> Column:
    x = col_of(c)
    if kind == "identity":
        return x
    if kind == "log":
        return F.exp(x)
    if kind == "log1p":
        return F.expm1(x)
    raise ValueError(f"transform must be one of {TRANSFORMS}")


def safe_div(a, b) -> Column:
    """Division that gives null for a zero divisor even under ANSI mode."""
    return F.try_divide(col_of(a), col_of(b))


def softplus(c) -> Column:
    return F.log1p(F.exp(col_of(c)))


def relu(c) -> Column:
    return F.greatest(col_of(c), F.lit(0.0))


def band(value, low: float, high: float, labels, strict: bool = False) -> Column:
    """Three-way verdict: below low -> labels[0], above high -> labels[2].

    Boundary values fall in the middle class (strict=False), as in the
    coverage, spread and skew checks.
    """
    v = col_of(value)
    lo, mid, hi = labels
    if strict:
        return F.when(v <= low, lo).when(v >= high, hi).when(v.isNotNull(), mid)
    return F.when(v < low, lo).when(v > high, hi).when(v.isNotNull(), mid)


def rounded(c, digits: int = 6) -> Column:
    """Reports are rounded so float-sum order never changes a value."""
    return F.round(col_of(c).cast("double"), digits) + F.lit(0.0)


def as_double(c) -> Column:
    return col_of(c).cast("double")


def safe_corr(x, y) -> Column:
    """Pearson correlation that is null (not an ANSI error) when a side is constant."""
    x, y = col_of(x), col_of(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def hash_uniform(*parts) -> Column:
    """Uniform in (0, 1) from md5 of the parts; repeatable in SQL."""
    txt = F.concat_ws(":", *[col_of(p).cast("string") for p in parts])
    h = F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(4294967296.0)


def hash_normal(*parts) -> Column:
    """Standard normal draw by Box-Muller over two hash uniforms."""
    u1 = hash_uniform(*parts, F.lit("a"))
    u2 = hash_uniform(*parts, F.lit("b"))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def money(c, digits: int = 2, scale: float = 1.0) -> Column:
    """Display text such as $1,234.50 (reports keep numbers; this is for show only)."""
    return F.concat(F.lit("$"), F.format_number(col_of(c) * F.lit(float(scale)), digits))


def percent(c, digits: int = 1) -> Column:
    """Display text of a share, e.g. 0.9512 -> 95.1%."""
    return F.concat(F.format_number(col_of(c) * F.lit(100.0), digits), F.lit("%"))
