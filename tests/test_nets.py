import numpy as np
import pandas as pd
import pytest

from bandwise.operators.blocks import (
    _row_losses, backward, fit_meanvar_net, forward, gradient_sums, n_params, unflatten,
)


@pytest.mark.parametrize("kind,sizes", [("sse", [3, 5, 4, 1]), ("gauss", [3, 6, 2])])
def test_backward_matches_finite_differences(kind, sizes):
    rng = np.random.default_rng(0)
    w = rng.normal(0, 0.5, n_params(sizes))
    x, t = rng.normal(size=(7, 3)), rng.normal(size=7)

    def loss(vec):
        return _row_losses(kind, forward(unflatten(vec, sizes), x)[0][-1], t)[0]

    layers = unflatten(w, sizes)
    acts, zs = forward(layers, x)
    g = backward(layers, acts, zs, _row_losses(kind, acts[-1], t)[1])
    num = np.array([(loss(w + e) - loss(w - e)) / 2e-6 for e in np.eye(len(w)) * 1e-6])
    assert np.allclose(g, num, rtol=1e-4, atol=1e-6)


def test_gradient_sums_equal_local(spark):
    rng = np.random.default_rng(1)
    sizes = [2, 4, 1]
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300), "y": rng.normal(size=300)})
    df = spark.createDataFrame(pdf).repartition(5)
    w = rng.normal(0, 0.5, n_params(sizes))
    g, loss, _, n = gradient_sums(df, ["a", "b"], "y", w, sizes, "sse")
    layers = unflatten(w, sizes)
    acts, zs = forward(layers, pdf[["a", "b"]].to_numpy())
    want_loss, delta, _ = _row_losses("sse", acts[-1], pdf.y.to_numpy())
    assert n == 300 and loss == pytest.approx(want_loss)
    assert np.allclose(g, backward(layers, acts, zs, delta))


def test_meanvar_net_reaches_group_moments(spark):
    """One-hot input, no hidden layer: the optimum is each group's mean and log variance."""
    rng = np.random.default_rng(2)
    g = rng.integers(0, 2, 600)
    y = np.where(g == 0, rng.normal(2.0, 0.5, 600), rng.normal(-1.0, 1.5, 600))
    pdf = pd.DataFrame({"g0": (g == 0).astype(float), "g1": (g == 1).astype(float), "y": y,
                        "split": "train"})
    df = spark.createDataFrame(pdf)
    net = fit_meanvar_net(df, ["g0", "g1"], hidden=(), steps=400, rate=0.05)
    out = net.transform(df.limit(600)).toPandas()
    for k in (0, 1):
        sub = out[pdf.g1.to_numpy()[: len(out)] == k]
        ys = y[g == k]
        assert sub.mu.iloc[0] == pytest.approx(ys.mean(), abs=0.05)
        assert sub.log_var.iloc[0] == pytest.approx(np.log(ys.var()), abs=0.1)
    assert net.history[-1][1] < net.history[0][1]


def test_variational_net_without_hidden_layer_reaches_closed_form(spark):
    """No hidden layer: the variational net is the linear model, whose optimum is known."""
    from bandwise.operators.blocks import _softplus, fit_variational_net
    from bandwise.operators.variational import fit_linear_posterior
    rng = np.random.default_rng(11)
    n = 800
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 0.7 * x1 - 0.3 * x2 + 1.2 + rng.normal(0, 0.1, n)
    df = spark.createDataFrame(pd.DataFrame({"x1": x1, "x2": x2, "y": y, "split": "train"}))
    post = fit_linear_posterior(df, ["x1", "x2"])
    net = fit_variational_net(df, ["x1", "x2"], hidden=(), steps=120, rate=0.05)
    assert net.mu == pytest.approx(post.mu, abs=0.03)
    assert (_softplus(net.rho) < _softplus(-3.0)).all()      # spread shrinks toward the optimum
    assert net.history[-1][2] < net.history[0][2]              # mse falls


@pytest.mark.parametrize("kind", ["meanvar", "variational"])
def test_a_stopped_run_goes_on_from_its_state(spark, tmp_path, kind):
    from bandwise.operators import blocks
    rng = np.random.default_rng(7)
    x = rng.normal(size=300)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": 0.5 * x + rng.normal(0, 0.2, 300), "split": "train"})).coalesce(1).cache()
    fit = {"meanvar": fit_meanvar_net, "variational": blocks.fit_variational_net}[kind]
    run = lambda steps, **kw: fit(df, ["x"], hidden=(4,), steps=steps, rate=0.02, **kw)
    weights = lambda net: net.weights if kind == "meanvar" else np.concatenate([net.mu, net.rho])
    whole, path = run(24), f"file://{tmp_path}/state"
    kept = blocks.TrainingState.save

    def lost(self, step, *rest):   # the driver is lost between two saved steps
        if step == 17:
            raise RuntimeError("lost")
        kept(self, step, *rest)

    blocks.TrainingState.save = lost
    try:
        with pytest.raises(RuntimeError):
            run(24, state_path=path, save_every=5)
    finally:
        blocks.TrainingState.save = kept
    assert spark.read.parquet(path).agg({"step": "max"}).first()[0] == 15
    again = run(24, state_path=path, save_every=5)
    assert weights(again) == pytest.approx(weights(whole), rel=1e-9)
    assert np.array(again.history) == pytest.approx(np.array(whole.history), rel=1e-9)
    ended = run(24, state_path=path, save_every=5)   # nothing left to do
    assert weights(ended) == pytest.approx(weights(whole), rel=1e-9) and len(ended.history) == 24
    if kind == "variational":
        assert ended.kl_weight == whole.kl_weight
    with pytest.raises(ValueError, match="other settings"):
        fit(df, ["x"], hidden=(3,), steps=24, rate=0.02, state_path=path)


def test_registered_queries_train_for_the_defaults():
    import inspect

    from bandwise.plans import nets, trees

    given = lambda f, name: inspect.signature(f).parameters[name].default
    for f in (nets.variational_net, nets.net_training_log, nets.mean_logvar_net, nets.mean_logvar_linear):
        assert given(f, "steps") == 2000
    for f in (trees.gbt_mean, trees.quantile_boost, trees.quantile_report_card, trees.combined_scan, trees.enhanced_scan):
        assert given(f, "rounds") == 100


def test_packed_rows_have_few_partitions(spark):
    """A step's job has as many tasks as there are cores, however many partitions the rows came in; sums are the same."""
    from bandwise.operators.blocks import packed_blocks
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "y": rng.normal(size=3000)})
    many = spark.createDataFrame(pdf).repartition(3 * spark.sparkContext.defaultParallelism)
    blocks = packed_blocks(many, ["a"], "y")
    try:
        assert blocks.getNumPartitions() == spark.sparkContext.defaultParallelism
        rows = np.concatenate(blocks.collect())
    finally:
        blocks.unpersist()
    assert sorted(map(tuple, rows)) == sorted(zip(pdf.a, pdf.y))


def test_rows_of_the_same_features_cost_a_step_once(spark, monkeypatch):
    """The mean / log-variance net reads one row for every distinct combination of features, and trains as on all rows."""
    from bandwise.operators import blocks
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 4, 3000) / 3.0, rng.integers(0, 3, 3000) - 1.0
    a[0], b[0] = 1.7, 0.4   # one combination with a single row
    y = 0.6 * a - 0.2 * b + rng.normal(0, 0.1 + 0.2 * a)
    pdf = pd.DataFrame({"a": a, "b": b, "y": [None if i % 50 == 7 else v for i, v in enumerate(y)],
                        "split": np.where(np.arange(3000) % 5 == 3, "test", "train")})
    read, sums = [], blocks.block_sums
    monkeypatch.setattr(blocks, "ALIKE_ROWS", 3)   # few rows are left as they are
    monkeypatch.setattr(blocks, "block_sums", lambda rows, *rest: (read.append(rows.map(len).sum()), sums(rows, *rest))[1])
    net = fit_meanvar_net(spark.createDataFrame(pdf).repartition(5), ["a", "b"], hidden=(6, 4), steps=25, rate=0.02)
    assert set(read) == {13}

    used = pdf[(pdf.split == "train") & pdf.y.notna()]
    x, t = used[["a", "b"]].to_numpy(), used.y.to_numpy(dtype=float)
    w = fit_meanvar_net(spark.createDataFrame(pdf), ["a", "b"], hidden=(6, 4), steps=0).weights
    opt, history = blocks.Adam(len(w), 0.02), []
    for step in range(25):
        layers = unflatten(w, net.sizes)
        acts, zs = forward(layers, x)
        loss, delta, mon = _row_losses("gauss", acts[-1], t)
        history.append((step, loss / len(t), mon / len(t)))
        w = opt.step(w, backward(layers, acts, zs, delta) / len(t))
    assert np.allclose(net.weights, w, rtol=1e-7, atol=1e-9)
    assert np.allclose(np.array(net.history), np.array(history), rtol=1e-9)


def test_blocks_of_alike_rows_give_the_sums_of_the_rows(spark):
    """Sums of loss, gradient, monitor and rows, of all rows and of the rows of equal features taken together."""
    from bandwise.operators import blocks
    rng = np.random.default_rng(6)
    sizes, n = [1, 5, 2], 400
    pdf = pd.DataFrame({"x": rng.integers(0, 9, n) / 4.0, "y": 1e4 + rng.normal(size=n)})   # a spread small beside the mean
    df, w = spark.createDataFrame(pdf).repartition(3), rng.normal(0, 0.5, n_params([1, 5, 2]))
    w[-2] = 1e4   # the mean's bias
    alike = blocks.alike_blocks(df, ["x"], "y")
    try:
        got = blocks.block_sums(alike, w, sizes, "gauss")
        assert alike.map(len).sum() == 9
    finally:
        alike.unpersist()
    want = gradient_sums(df, ["x"], "y", w, sizes, "gauss")
    assert got[3] == want[3] == n
    for g, v in zip(got, want):
        assert np.allclose(g, v, rtol=1e-9, atol=1e-7)
