"""SQL fragments shared by the DuckDB twins (text only; DuckDB dialect)."""

# Hash split: same bucket as bandwise.functions.columns.hash_bucket.
def bucket(key: str) -> str:
    return f"(('0x'||substr(md5(({key})::varchar),1,8))::BIGINT % 100)"


def split3(key: str) -> str:
    b = bucket(key)
    return f"(CASE WHEN {b} < 60 THEN 'train' WHEN {b} < 80 THEN 'val' ELSE 'test' END)"


def split2(key: str) -> str:
    return f"(CASE WHEN {bucket(key)} < 80 THEN 'train' ELSE 'test' END)"


def log1p(x: str) -> str:
    return f"(CASE WHEN ({x}) > -1 THEN ln(1 + ({x})) END)"


def ln(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln({x}) END)"


def r6(x: str, digits: int = 6) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's rounding gives.
    return f"(round(({x})::DOUBLE, {digits}) + 0.0)"


def avg_rank(value: str, by: str = "") -> str:
    """Tie-averaged rank as a window expression."""
    part = f"PARTITION BY {by}" if by else ""
    peers = f"PARTITION BY {by + ', ' if by else ''}{value}"
    return (f"(rank() OVER ({part} ORDER BY {value}) + "
            f"(count(*) OVER ({peers}) - 1) / 2.0)")


def corr(x: str, y: str) -> str:
    return f"(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0))"
