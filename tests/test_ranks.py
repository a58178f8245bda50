import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bandwise.operators.calibration import conformal_rank
from bandwise.operators import ranks as ranks_module
from bandwise.operators.ranks import (
    average_ranks, exact_percentile, order_code, order_statistic, order_statistics, row_numbers,
)


def _avg_rank(v):
    return pd.Series(v).rank(method="average").to_numpy()


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 3000
    seg = rng.choice(["a", "b", "c"], size=n, p=[0.6, 0.3, 0.1])
    x = np.round(rng.normal(size=n), 2)          # many ties
    x[: n // 3] = 0.5                            # one hot value holds a third of the rows
    pdf = pd.DataFrame({"seg": seg, "x": x})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("parts", [1, 3, 16, 64])
def test_order_statistic_matches_sort(frame, parts):
    pdf, df = frame
    for r in [1, 2, 999, 1000, 1001, 2500, 3000]:
        got = order_statistic(df, "x", r, parts=parts).first()["value"]
        assert got == np.sort(pdf.x.to_numpy())[r - 1]


def test_order_statistic_by_segment(frame):
    pdf, df = frame
    res = order_statistic(df, "x", lambda n: F.ceil(n.cast("double") * 0.9).cast("bigint"),
                          by=["seg"], parts=8).toPandas()
    for _, row in res.iterrows():
        v = np.sort(pdf[pdf.seg == row.seg].x.to_numpy())
        assert row.value == v[int(np.ceil(len(v) * 0.9)) - 1]
        assert row.n == len(v)


def test_exact_percentile_matches_numpy(frame):
    pdf, df = frame
    for q in [0.0, 0.05, 0.5, 0.95, 1.0]:
        got = exact_percentile(df, "x", q, parts=8).first()["value"]
        assert got == pytest.approx(np.percentile(pdf.x, q * 100), abs=1e-12)
    res = exact_percentile(df, "x", 0.95, by=["seg"], parts=8).toPandas()
    for _, row in res.iterrows():
        assert row.value == pytest.approx(np.percentile(pdf[pdf.seg == row.seg].x, 95), abs=1e-12)


def test_average_ranks_match_pandas(frame):
    pdf, df = frame
    got = average_ranks(df, "x", parts=8).toPandas().set_index("x")["avg_rank"]
    want = pd.Series(_avg_rank(pdf.x), index=pdf.x).groupby(level=0).first()
    assert np.allclose(got.sort_index().to_numpy(), want.sort_index().to_numpy())
    seg = average_ranks(df, "x", by=["seg"], parts=4).toPandas()
    for s, g in pdf.groupby("seg"):
        want = pd.Series(_avg_rank(g.x), index=g.x).groupby(level=0).first().sort_index()
        have = seg[seg.seg == s].set_index("x")["avg_rank"].sort_index()
        assert np.allclose(have.to_numpy(), want.to_numpy())


def test_conformal_rank_is_numpy_higher(spark):
    alpha = 0.05
    ns = list(range(1, 300)) + [1999, 2029, 4999]
    df = spark.createDataFrame([(n,) for n in ns], "n bigint")
    got = df.select("n", conformal_rank(F.col("n"), alpha, "higher").alias("r")).toPandas()
    for n, r in zip(got.n, got.r):
        scores = np.arange(1, n + 1, dtype=float)
        level = min(1.0, np.ceil((n + 1) * (1 - alpha)) / n)
        assert np.quantile(scores, level, method="higher") == scores[r - 1], n


def test_empty_and_single_row(spark):
    one = spark.createDataFrame([(3.5,)], "x double")
    assert order_statistic(one, "x", 1).first()["value"] == 3.5
    empty = spark.createDataFrame([], "x double")
    assert order_statistic(empty, "x", 1).count() == 0


def test_fine_cut_path_for_large_inputs(frame, monkeypatch):
    """When buckets would exceed ROWS_PER_BUCKET, a finer sketch is taken; answers stay exact."""
    import bandwise.operators.ranks as ranks
    pdf, df = frame
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 10)
    cuts = ranks.auto_cut_points(df, "x")
    assert len(cuts) > ranks.BASE_PARTS                     # finer than the coarse pass
    for r in [1, 1500, 3000]:
        assert order_statistic(df, "x", r).first()["value"] == np.sort(pdf.x.to_numpy())[r - 1]
    got = average_ranks(df, "x").toPandas().set_index("x")["avg_rank"].sort_index()
    want = pd.Series(_avg_rank(pdf.x), index=pdf.x).groupby(level=0).first().sort_index()
    assert np.allclose(got.to_numpy(), want.to_numpy())


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=60),
       parts=st.integers(1, 9), pick=st.floats(0.0, 1.0), q=st.floats(0.0, 1.0))
def test_order_statistic_property(spark, values, parts, pick, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    srt = np.sort(np.array(values, dtype=float))
    r = 1 + int(pick * (len(values) - 1))
    assert order_statistic(df, "x", r, parts=parts).first()["value"] == srt[r - 1]
    got = exact_percentile(df, "x", q, parts=parts).first()["value"]
    assert got == pytest.approx(np.percentile(srt, q * 100), abs=1e-9)


def test_conformal_rank_standard(spark):
    df = spark.createDataFrame([(n,) for n in (1, 9, 10, 19, 20, 100, 2029)], "n bigint")
    got = df.select("n", conformal_rank(F.col("n"), 0.05, "standard").alias("r")).toPandas()
    for n, r in zip(got.n, got.r):
        assert r == min(int(np.ceil((n + 1) * (1 - 0.05))), n)


def test_large_integer_keys_stay_exact(spark):
    """Keys above 2^53 collide as doubles; ranks must use the keys themselves."""
    base = 2 ** 60
    keys = [base + i for i in range(200)]
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(k),) for k in rng.permutation(keys)], "k bigint")
    assert order_statistic(df, "k", 137, parts=4).first()["value"] == base + 136
    ranks = average_ranks(df, "k", parts=4).toPandas().set_index("k")["avg_rank"]
    assert len(ranks) == 200
    assert all(ranks[base + i] == i + 1 for i in range(200))


def test_order_codes_keep_the_order_of_doubles(spark):
    rng = np.random.default_rng(5)
    bits = rng.integers(-2 ** 63, 2 ** 63 - 1, 4000)
    edges = [0.0, -0.0, 1.0, np.nextafter(1, 0), np.nextafter(2, 0), 2.0, 5e-324, -5e-324, 2.2250738585072014e-308,
             2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, np.inf, -np.inf]
    edges += [np.nextafter(2.0 ** k, s) for k in range(-1070, 1024, 37) for s in (0, np.inf)]
    x = np.concatenate([bits.view(np.float64), edges])
    x = x[~np.isnan(x)]
    got = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", order_code(F.col("x")).alias("c")).collect()
    for r in got:
        m = abs(int(np.float64(abs(r.x)).view(np.int64)))
        assert r.c == (-m if r.x < 0 else m), r.x


@pytest.mark.parametrize("rows", [1, 50])
def test_radix_passes_narrow_to_the_last_bit(spark, monkeypatch, rows):
    """Values that differ in their last bits only, two groups, a null group and a tied third."""
    monkeypatch.setattr(ranks_module, "PICK_ROWS", rows)
    x = [1.0]
    for _ in range(400):
        x.append(np.nextafter(x[-1], 2))
    x += [x[7]] * 200
    # codes with equal leading bits on both sides of logarithmic buckets
    x += [float(2 ** (k / 2048) * (1 + e)) for k in range(5, 60) for e in (-3e-10, -1e-16, 0, 1e-16, 3e-10)]
    data = [(g, float(v) * (-1 if g == "b" else 1)) for g in ("a", "b", None) for v in x]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    wanted = {"first": 1, "some": 120, "late": lambda n: n - 3, "none": 10_000}
    got = {(r.g, r.which): (r.value, r.n, r.r) for r in order_statistics(df, "x", wanted, by=["g"]).collect()}
    for g in ("a", "b", None):
        v = sorted(b for a, b in data if a == g)
        assert got[g, "first"] == (v[0], len(v), 1) and got[g, "some"] == (v[119], len(v), 120)
        assert got[g, "late"] == (v[-4], len(v), len(v) - 3) and (g, "none") not in got
    whole = sorted(b for _, b in data)
    some = {str(r): r for r in range(1, len(whole), 97)}
    assert {int(r.which): r.value for r in order_statistics(df, "x", some).collect()} == {r: whole[r - 1] for r in some.values()}


def test_order_statistics_neither_join_nor_write_rows(spark, frame):
    _, df = frame
    plan = order_statistic(df, "x", 1500)._jdf.queryExecution().optimizedPlan().toString()
    assert "Checkpoint" not in plan and "LogicalRDD [x" not in plan
    from bandwise.operators.ranks import first_digit

    physical = order_statistic(df, "x", 1500)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical  # rows meet the located place in their task
    x = np.sort(np.random.default_rng(0).standard_normal(3000) * 10.0 ** np.arange(3000) ** 0.3)
    x = np.concatenate([[-np.inf, -1e308, -5e-324, 0.0, 5e-324, np.inf], x])
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", first_digit(F.col("x")).alias("d")).collect()
    digits = [r.d for r in sorted(rows, key=lambda r: r.x)]
    assert digits == sorted(digits)


def test_other_types_of_values(spark):
    from decimal import Decimal

    d = [Decimal("1.00000000000000000001"), Decimal("1.00000000000000000003"), Decimal("-5"), Decimal("1.00000000000000000002")]
    df = spark.createDataFrame([(v, i - 2) for i, v in enumerate(d)], "d decimal(30,20), i int")
    assert [order_statistic(df, "d", r).first()["value"] for r in (1, 2, 3, 4)] == sorted(d)
    assert [order_statistic(df, "i", r).first()["value"] for r in (1, 4)] == [-2, 1]


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_row_numbers_match_sort(spark, frame, parts):
    pdf, df = frame
    got = row_numbers(df.withColumn("id", F.monotonically_increasing_id()), "x", ties=["id"], parts=parts).toPandas()
    order = got.sort_values(["x", "id"])
    assert order.position.tolist() == list(range(1, len(pdf) + 1))
    some = spark.createDataFrame([(None,), (2.0,), (float("nan"),), (1.0,), (None,)], "x double")
    got = {str(r.x): r.position for r in row_numbers(some, "x").collect()}
    assert got["1.0"] == 3 and got["2.0"] == 4 and got["nan"] == 5


def test_spearman_with_hot_ties_and_null_groups(spark, frame, monkeypatch):
    from bandwise.operators import params
    from bandwise.operators.stats import spearman

    pdf, _ = frame
    rng = np.random.default_rng(1)
    pdf = pdf.assign(y=np.round(pdf.x + rng.normal(size=len(pdf)), 1), seg=pdf.seg.replace({"c": None}))
    df = spark.createDataFrame([(None if pd.isna(s) else s, float(x), float(y)) for s, x, y in pdf.itertuples(index=False)],
                               "seg string, x double, y double")
    for limit in (params.BROADCAST_ROWS, 5):  # few ranks are broadcast; many are joined, hot values apart
        monkeypatch.setattr(params, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(params, "HOT_SHARE", 20)
        assert spearman(df, "x", "y").first()["spearman"] == pytest.approx(pdf.x.rank().corr(pdf.y.rank()), abs=1e-12)
        got = {r.seg: r.spearman for r in spearman(df, "x", "y", by=["seg"]).collect()}
        for seg in ("a", "b", None):
            g = pdf[pdf.seg.isna() if seg is None else pdf.seg == seg]
            assert got[seg] == pytest.approx(g.x.rank().corr(g.y.rank()), abs=1e-12)
    assert spearman(df.withColumn("x", F.lit(1.0)), "x", "y").first()["spearman"] is None
