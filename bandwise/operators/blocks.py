"""Data-parallel full-batch training of small ReLU nets.

One step = one Spark job: the current weights travel with the tasks, every partition
runs forward and backward passes over its matrices (numpy, a few rows at a time, so that the
activations stay in the processor's cache) and emits one
gradient-sum vector, and the vectors are summed, in two levels if there are many. Only
parameter-sized vectors reach the driver, where Adam updates the weights. The
training rows are packed into matrices and persisted once for all steps, in no more partitions than
there are cores, or than bound a partition's size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.operators.resume import TrainingState
from bandwise.session import cut_lineage, spread
from bandwise.functions.constants import (
    ADAM_RATE, MC_DRAWS, MEANVAR_LAYERS, MEANVAR_STEPS, MU_INIT, RHO_INIT, SEED,
    VARIATIONAL_LAYERS, VARIATIONAL_STEPS,
)


#: Gradient vectors of so many partitions are summed without a second level.
DIRECT_PARTITIONS = 64
#: Numbers in a partition of packed rows; there are as many partitions as cores at least.
PART_NUMBERS = 1 << 23
#: Rows that one forward and backward pass takes.
PASS_ROWS = 512
#: Up to so many training rows a core, a step takes the time of its job, whatever the rows.
ALIKE_ROWS = 10_000


# ---- a plain MLP as a flat parameter vector ------------------------------------

def shapes(sizes):
    return [((o, i), (o,)) for i, o in zip(sizes[:-1], sizes[1:])]


def n_params(sizes):
    return sum(o * i + o for (o, i), _ in shapes(sizes))


def unflatten(vec, sizes):
    out, k = [], 0
    for (o, i), _ in shapes(sizes):
        w = vec[k:k + o * i].reshape(o, i)
        k += o * i
        b = vec[k:k + o]
        k += o
        out.append((w, b))
    return out


def forward(layers, x):
    acts, zs = [x], []
    for j, (w, b) in enumerate(layers):
        z = acts[-1] @ w.T + b
        zs.append(z)
        acts.append(z if j == len(layers) - 1 else np.maximum(z, 0.0))
    return acts, zs


def backward(layers, acts, zs, delta):
    grads = []
    for j in range(len(layers) - 1, -1, -1):
        w, _ = layers[j]
        grads.append((delta.T @ acts[j], delta.sum(axis=0)))
        if j > 0:
            delta = (delta @ w) * (zs[j - 1] > 0)
    grads.reverse()
    return np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads])


def _row_losses(kind, out, t, within=0.0, n=1.0):
    """(sum of loss, dLoss/dout per row, sum of the monitored value). For "gauss" a row may stand for ``n`` rows of the
    same features: ``t`` is then their truths' mean and ``within`` these truths' variance (population)."""
    if kind == "sse":
        r = out[:, 0] - t
        return float((r * r).sum()), 2.0 * r[:, None], float((r * r).sum())
    if kind == "gauss":
        mu, lv = out[:, 0], out[:, 1]
        prec = np.exp(-lv)
        e = t - mu
        square = e * e + within
        loss = n * (0.5 * (lv + square * prec))
        delta = np.column_stack([n * (-e * prec), n * (0.5 * (1.0 - square * prec))])
        return float(loss.sum()), delta, float((n * np.exp(0.5 * lv)).sum())
    raise ValueError(kind)


def packed_blocks(df: DataFrame, features, y: str):
    """The rows as persisted matrices (features, then the truth), one for each Arrow batch of a partition."""
    cols = [*features, y]

    def pack(batches):
        for b in batches:
            if b.num_rows:
                m = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in b.columns])
                yield pa.RecordBatch.from_arrays([pa.array([m.tobytes()], pa.binary())], ["block"])

    k = len(cols)
    packed = df.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(pack, "block binary")
    return few_partitions(packed.rdd.map(lambda r: np.frombuffer(r[0]).reshape(-1, k)).persist(StorageLevel.MEMORY_AND_DISK))


def few_partitions(blocks):
    """Persisted matrices in as few partitions as keep every core busy and each at about PART_NUMBERS numbers: a job
    for every step costs a task for every partition, and the input's partitions follow its bytes, not its rows."""
    have, cores = blocks.getNumPartitions(), blocks.context.defaultParallelism
    if have <= cores:
        return blocks
    wanted = max(cores, -(-blocks.map(lambda m: m.size).sum() // PART_NUMBERS))
    if have <= wanted:
        return blocks
    fewer = blocks.coalesce(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    fewer.count()
    blocks.unpersist()
    return fewer


def block_sums(blocks, weights: np.ndarray, sizes, kind: str):
    """Sum over all blocks of the loss gradient; returns (grad, loss_sum, monitor_sum, n). A block's columns are the
    features and the truth, or the features and what ``alike_blocks`` has of the truth."""
    p, k = n_params(sizes), sizes[0]

    def run(part):
        layers = unflatten(weights, sizes)
        acc = np.zeros(p + 3)
        for m in part:
            for at in range(0, len(m), PASS_ROWS):
                rows = m[at:at + PASS_ROWS]
                acts, zs = forward(layers, rows[:, :k])
                loss, delta, mon = _row_losses(kind, acts[-1], *rows[:, k:].T)
                acc[:p] += backward(layers, acts, zs, delta)
                acc[p:] += [loss, mon, len(rows) if rows.shape[1] == k + 1 else rows[:, -1].sum()]
        yield acc

    summed = summed_vectors(blocks.mapPartitions(run))
    return summed[:p], summed[p], summed[p + 1], summed[p + 2]


def summed_vectors(sums):
    """The sum of an RDD of vectors, one a partition: many are summed in two levels, a few by the driver."""
    return sums.treeReduce(np.add) if sums.getNumPartitions() > DIRECT_PARTITIONS else sums.reduce(np.add)


def gradient_sums(df: DataFrame, features, y: str, weights: np.ndarray, sizes, kind: str):
    """``block_sums`` over the rows of a DataFrame."""
    blocks = packed_blocks(df, features, y)
    try:
        return block_sums(blocks, weights, sizes, kind)
    finally:
        blocks.unpersist()


class Adam:
    def __init__(self, n, rate=ADAM_RATE, b1=0.9, b2=0.999, eps=1e-8):
        self.m, self.v, self.t = np.zeros(n), np.zeros(n), 0
        self.rate, self.b1, self.b2, self.eps = rate, b1, b2, eps

    def step(self, params, grad):
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * grad
        self.v = self.b2 * self.v + (1 - self.b2) * grad * grad
        mh = self.m / (1 - self.b1 ** self.t)
        vh = self.v / (1 - self.b2 ** self.t)
        return params - self.rate * mh / (np.sqrt(vh) + self.eps)


def _softplus(r):
    return np.log1p(np.exp(r))


def _sigmoid(r):
    return 1.0 / (1.0 + np.exp(-r))


def _train_frame(df, features, y, split_col, fit_on):
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    return src.select(*[F.col(c).cast("double").alias(c) for c in features],
                      F.col(y).cast("double").alias(y)).where(F.col(y).isNotNull())


def _train_rows(df, features, y, split_col, fit_on):
    return packed_blocks(spread(_train_frame(df, features, y, split_col, fit_on)), features, y)


def _train_moments(df, features, y, split_col, fit_on):
    """The training rows, alike ones taken together if they are many: sums in another order are other in the last digits,
    which many steps amplify, and few rows gain nothing by it."""
    rows = _train_frame(df, features, y, split_col, fit_on)
    if rows.count() <= ALIKE_ROWS * df.sparkSession.sparkContext.defaultParallelism:
        return packed_blocks(spread(rows), features, y)
    return alike_blocks(rows, features, y)


def alike_blocks(rows: DataFrame, features, y: str):
    """``packed_blocks`` with one row for all rows of the same features: the features, then mean, variance (population) and
    count of their truths. The Gaussian loss and its gradient need no more, so a step costs what the features' distinct
    combinations cost (documents' words and lines are counts), and at most what the rows did. The rows are dealt out evenly:
    a step ends with its slowest task."""
    alike = cut_lineage(rows.groupBy(*features).agg(F.avg(y).alias("_bw_mean"), F.var_pop(y).alias("_bw_within"),
                                                    F.count(y).cast("double").alias("_bw_n")))
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-alike.count() * len(alike.columns) // PART_NUMBERS))
    return packed_blocks(alike.repartition(parts), [*features, "_bw_mean", "_bw_within"], "_bw_n")


def _with_outputs(df: DataFrame, run, features, names: dict) -> DataFrame:
    """``df`` with the fields of ``run`` over the feature columns, which alone go to Python."""
    out = df.withColumn("_bw_out", run(*[F.col(c).cast("double") for c in features]))
    return out.select(*[F.col(c) for c in df.columns if c not in names.values()],
                      *[F.col(f"_bw_out.{k}").alias(v) for k, v in names.items()])


# ---- variational net (M3b) -------------------------------------------------------

@dataclass
class VariationalNet:
    features: list
    sizes: list
    mu: np.ndarray
    rho: np.ndarray
    kl_weight: float
    history: list = field(default_factory=list)   # (step, loss, mse)

    def posterior_table(self, spark):
        rows, k = [], 0
        for layer, ((o, i), _) in enumerate(shapes(self.sizes)):
            for r in range(o):
                for c in range(i):
                    rows.append((layer, r, c, "weight", float(self.mu[k]), float(self.rho[k])))
                    k += 1
            for r in range(o):
                rows.append((layer, r, -1, "bias", float(self.mu[k]), float(self.rho[k])))
                k += 1
        return spark.createDataFrame(rows, "layer int, row int, col int, kind string, mu double, rho double")

    def history_frame(self, spark):
        return spark.createDataFrame(self.history, "step int, loss double, mse double")

    def predictive(self, df: DataFrame, n_draws: int = MC_DRAWS, seed: int = SEED,
                   mean: str = "mc_mean", std: str = "mc_std") -> DataFrame:
        """Monte Carlo predictive for every row: each draw of all weights is shared by
        all rows; mean and population std over draws (M4)."""
        rng = np.random.default_rng([seed, 1])
        sig = _softplus(self.rho)
        draws = self.mu + sig * rng.standard_normal((n_draws, len(self.mu)))
        bc = df.sparkSession.sparkContext.broadcast(draws)
        sizes = self.sizes

        @F.pandas_udf("mean double, std double")
        def run(*columns: pd.Series) -> pd.DataFrame:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            preds = np.stack([forward(unflatten(w, sizes), x)[0][-1][:, 0] for w in bc.value])
            return pd.DataFrame({"mean": preds.mean(axis=0), "std": preds.std(axis=0)})

        return _with_outputs(df, run, self.features, {"mean": mean, "std": std})


def fit_variational_net(df: DataFrame, features, y: str = "y", hidden=VARIATIONAL_LAYERS,
                        steps: int = VARIATIONAL_STEPS, rate: float = ADAM_RATE,
                        kl_weight: float | None = None, seed: int = SEED,
                        split_col: str | None = "split", fit_on: str = "train",
                        state_path: str | None = None, save_every: int = 100) -> VariationalNet:
    """Minimise SSE(sampled weights) + kl_weight * KL(q || N(0,1)), one weight draw per
    step shared by all rows, Adam on (mu, rho). With ``state_path``, a folder of the shared storage, the state is
    kept there every ``save_every`` steps, and a run that was stopped goes on from it."""
    features = list(features)
    sizes = [len(features), *hidden, 1]
    p = n_params(sizes)
    rng = np.random.default_rng(seed)
    mu = rng.uniform(-MU_INIT, MU_INIT, p)
    rho = np.full(p, RHO_INIT)
    rows = _train_rows(df, features, y, split_col, fit_on)
    opt = Adam(2 * p, rate)
    net = VariationalNet(features, sizes, mu, rho, 0.0)
    kept = TrainingState(df.sparkSession, state_path, save_every, {
        "net": "variational", "sizes": sizes, "rate": rate, "kl_weight": kl_weight, "seed": seed})
    begin = 0
    if (found := kept.load(steps)) is not None:
        begin, opt.t, both, opt.m, opt.v, rng.bit_generator.state, net.history = found
        mu, rho = both[:p], both[p:]
    try:
        lam = kl_weight
        if lam is None and begin == steps and steps:
            lam = 1.0 / rows.map(len).sum()  # no step left to count the rows
        for step in range(begin, steps):
            sig = _softplus(rho)
            eps = rng.standard_normal(p)
            g, sse, _, n = block_sums(rows, mu + sig * eps, sizes, "sse")
            if lam is None:
                lam = 1.0 / n
            kl = 0.5 * np.sum(mu ** 2 + sig ** 2 - 2 * np.log(sig) - 1)
            net.history.append((step, float(sse + lam * kl), float(sse / n)))
            g_mu = g + lam * mu
            g_rho = (g * eps + lam * (sig - 1.0 / sig)) * _sigmoid(rho)
            both = opt.step(np.concatenate([mu, rho]), np.concatenate([g_mu, g_rho]))
            mu, rho = both[:p], both[p:]
            kept.save(step + 1, steps, both, opt, rng, net.history)
    finally:
        rows.unpersist()
    net.mu, net.rho, net.kl_weight = mu, rho, float(lam or 0.0)
    return net


# ---- mean / log-variance net (M6c) ---------------------------------------------

@dataclass
class MeanVarNet:
    features: list
    sizes: list
    weights: np.ndarray
    history: list = field(default_factory=list)   # (step, loss, avg_sigma)

    def history_frame(self, spark):
        return spark.createDataFrame(self.history, "step int, loss double, avg_sigma double")

    def transform(self, df: DataFrame, mu: str = "mu", log_var: str = "log_var") -> DataFrame:
        bc = df.sparkSession.sparkContext.broadcast(self.weights)
        sizes = self.sizes

        @F.pandas_udf("mu double, log_var double")
        def run(*columns: pd.Series) -> pd.DataFrame:
            out = forward(unflatten(bc.value, sizes), np.column_stack([c.to_numpy(dtype=float) for c in columns]))[0][-1]
            return pd.DataFrame({"mu": out[:, 0], "log_var": out[:, 1]})

        return _with_outputs(df, run, self.features, {"mu": mu, "log_var": log_var})


def fit_meanvar_net(df: DataFrame, features, y: str = "y", hidden=MEANVAR_LAYERS,
                    steps: int = MEANVAR_STEPS, rate: float = ADAM_RATE, seed: int = SEED,
                    split_col: str | None = "split", fit_on: str = "train",
                    state_path: str | None = None, save_every: int = 100) -> MeanVarNet:
    """Minimise the mean Gaussian NLL 0.5*mean(lv + (y-mu)^2 e^-lv) with two linear heads
    (mean, log-variance) on a shared ReLU trunk; full batch, Adam. ``state_path`` as in ``fit_variational_net``."""
    features = list(features)
    sizes = [len(features), *hidden, 2]
    rng = np.random.default_rng(seed)
    parts = []
    for (o, i), _ in shapes(sizes):
        bound = 1.0 / np.sqrt(i)
        parts += [rng.uniform(-bound, bound, o * i), rng.uniform(-bound, bound, o)]
    w = np.concatenate(parts)
    rows = _train_moments(df, features, y, split_col, fit_on)
    opt = Adam(len(w), rate)
    net = MeanVarNet(features, sizes, w)
    kept = TrainingState(df.sparkSession, state_path, save_every, {
        "net": "mean and log-variance", "sizes": sizes, "rate": rate, "seed": seed})
    begin = 0
    if (found := kept.load(steps)) is not None:
        begin, opt.t, w, opt.m, opt.v, rng.bit_generator.state, net.history = found
    try:
        for step in range(begin, steps):
            g, loss, sig, n = block_sums(rows, w, sizes, "gauss")
            net.history.append((step, float(loss / n), float(sig / n)))
            w = opt.step(w, g / n)
            kept.save(step + 1, steps, w, opt, rng, net.history)
    finally:
        rows.unpersist()
    net.weights = w
    return net
