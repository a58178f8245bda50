"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the neighbour graph, a balanced partitioning of that graph (capacity-bound label
propagation from balanced random bisections), and a small softmax classifier
that learns to name a vector's part. The classifier files every vector of the
table under its likeliest part and routes a query to its ``probes`` likeliest ones;
``probes`` is the least number that reaches the wanted recall on sample queries.
Candidates found there are ranked by exact distance.

Equal vectors are indexed once with their k + 1 smallest ids, which is all that any
query can return of them. Parts are cut into blocks, and a part's queries too,
so no task sees more than a block of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import written


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest other rows, in blocks."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), int)
    norms = (x * x).sum(1)
    for at in range(0, len(x), 512):
        d = norms - 2 * x[at:at + 512] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out[at:at + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(graph: np.ndarray, x: np.ndarray, parts: int, rng, slack: float = 0.05,
                       sweeps: int = 15) -> np.ndarray:
    """Part of each node: few cut edges, no part above (1 + slack) times the mean."""
    n = len(graph)
    part = np.zeros(n, int)
    groups, made = [np.arange(n)], 1
    while made < parts:  # halve the largest group across a random direction
        groups.sort(key=len)
        g = groups.pop()
        order = g[np.argsort(x[g] @ rng.normal(size=x.shape[1]), kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
        made += 1
    for i, g in enumerate(groups):
        part[g] = i
    capacity = int(np.ceil((1 + slack) * n / parts))
    ends = np.repeat(np.arange(n), graph.shape[1])
    for _ in range(sweeps):
        votes = np.zeros((n, parts))
        np.add.at(votes, (ends, part[graph.ravel()]), 1)
        np.add.at(votes, (graph.ravel(), part[ends]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < capacity:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """Softmax classifier of parts; ``probes`` parts are searched for a query."""

    mean: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.weights + self.bias


def fit_router(x: np.ndarray, parts: int, recall: float, k: int, seed: int = 3,
               steps: int = 300, rate: float = 0.05) -> Router:
    """Partition the sample's neighbour graph and learn to name the parts."""
    rng = np.random.default_rng(seed)
    parts = max(1, min(parts, len(x) // 8))
    mean = x.mean(0)
    router = Router(mean, np.zeros((x.shape[1], parts)), np.zeros(parts), parts)
    if parts == 1:
        return router
    graph = neighbour_graph(x, 10)
    part = balanced_partition(graph, x, parts, rng)
    z, hot = x - mean, np.eye(parts)[part]
    scale = 1 / max(float(z.std()), 1e-12)
    z = z * scale
    m = [np.zeros_like(router.weights), np.zeros(parts)]
    v = [np.zeros_like(router.weights), np.zeros(parts)]
    w, b = router.weights, router.bias
    for t in range(1, steps + 1):
        s = z @ w + b
        p = np.exp(s - s.max(1, keepdims=True))
        p = (p / p.sum(1, keepdims=True) - hot) / len(z)
        for i, (value, g) in enumerate(((w, z.T @ p + 1e-4 * w), (b, p.sum(0)))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            value -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    router.weights, router.bias = w * scale, b
    # the least number of probes at which sample queries find their true neighbours
    q = np.arange(0, len(x), max(1, len(x) // 512))
    near = neighbour_graph(x, k)[q]
    s = router.scores(x)
    home = s.argmax(1)
    rank = np.argsort(np.argsort(-s[q], axis=1), axis=1)  # of each part for each query
    need = np.take_along_axis(rank, home[near], axis=1)
    router.probes = next((m for m in range(1, parts + 1) if (need < m).mean() >= recall), parts)
    return router


def _matrix(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten(), float).reshape(len(col), -1)


def _route(shared, count: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = shared.value.scores(_matrix(b.column("vector")))
                top = np.argsort(-s, axis=1, kind="stable")[:, :count or shared.value.probes]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(top.tolist(), pa.list_(pa.int32()))], [*b.schema.names, "parts"])
    return run


def _rank_block(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Each query's k best rows of one block of candidates, by (distance, id)."""
        got_q, got_id, got_d = [], [], []
        if left.num_rows and right.num_rows:
            qid = np.asarray(left["query_id"])
            q, x = _matrix(left["vector"].combine_chunks()), _matrix(right["vector"].combine_chunks())
            ids = right["ids"].combine_chunks()
            flat, offsets = np.asarray(ids.flatten()), np.asarray(ids.offsets) - ids.offsets[0].as_py()
            norms = (x * x).sum(1)
            keep = min(k + 1, len(x))
            for at in range(0, len(q), 256):
                part = q[at:at + 256]
                rough = norms - 2 * part @ x.T + (part * part).sum(1)[:, None]
                bound = np.partition(rough, keep - 1, axis=1)[:, keep - 1]
                margin = 1e-9 * (norms.max() + (part * part).sum(1)) + bound
                for i in range(len(part)):
                    near = np.flatnonzero(rough[i] <= margin[i])
                    diff = x[near] - part[i]
                    d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                    spans = [flat[offsets[j]:offsets[j + 1]] for j in near]
                    cand, dist = np.concatenate(spans), np.repeat(d, [len(s) for s in spans])
                    other = cand != qid[at + i]
                    cand, dist = cand[other], dist[other]
                    best = np.lexsort((cand, dist))[:k]
                    got_q.append(np.full(len(best), qid[at + i]))
                    got_id.append(cand[best])
                    got_d.append(dist[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": pa.array(join(got_q, np.int64), pa.int64()),
                         "vec_id": pa.array(join(got_id, np.int64), pa.int64()),
                         "score": pa.array(join(got_d, float), pa.float64())})
    return run


def nearest_neighbours(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding",
                       k: int = 10, recall: float = 0.97, max_fit_rows: int = 8192,
                       rows_per_part: int = 1024, least_parts: int = 16, max_parts: int = 256, block: int = 8192,
                       query_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row, nearest first, ties by id.

    ``queries`` is a condition on ``vec_id``; candidates are all rows but the query's own.
    Rows whose id or vector is null, or whose vector is zero, holds a null or non-finite
    component or hasn't the table's most frequent length take no part. Rows repeated with the
    same id and vector count once; an id with several vectors is a candidate with each, and asks with the least.
    There is a part for every ``rows_per_part`` distinct vectors, but ``least_parts`` if each gets an
    eighth of that, and at most ``max_parts``, which the sample must fill. With fewer candidates than k all are returned; without usable
    rows the result is empty. Other columns are ignored. ``max_fit_rows`` bounds the fitting sample.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    slim = slim.where("vec_id is not null and vector is not null").where(
        F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))
    lengths = slim.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    slim = slim.where(F.size("vector") == lengths["n"])
    # equal vectors once, with their k + 1 smallest ids
    order = Window.partitionBy("vector").orderBy("vec_id")
    index = written(slim.withColumn("_r", F.dense_rank().over(order)).where(F.col("_r") <= k + 1)
                    .groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "ann-index")
    n = index.count()
    # a sample by hash, in hash order
    share = max_fit_rows / n
    sample = index.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40))) \
        if share < 1 else index
    x = np.array([r["vector"] for r in sample.select("vector").orderBy(F.xxhash64("vector")).limit(
        max_fit_rows).collect()], float)
    parts = max(1, min(least_parts, 8 * n // rows_per_part), min(max_parts, n // rows_per_part))
    shared = spark.sparkContext.broadcast(fit_router(x, parts, recall, k) if len(x) > 1 else
                                          Router(np.zeros(lengths["n"]), np.zeros((lengths["n"], 1)), np.zeros(1), 1))
    filed = index.mapInArrow(_route(shared, 1), "vector array<double>, ids array<long>, parts array<int>").select(
        F.col("parts")[0].alias("part"), "vector", "ids")
    filed = written(filed, "ann-filed")
    asked = slim.where(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector")).mapInArrow(
        _route(shared, None), "query_id long, vector array<double>, parts array<int>")
    asked = written(asked.select("query_id", "vector", F.explode("parts").alias("part")), "ann-asked")
    # how many blocks each part has of either side: max_parts rows
    sizes = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}
    asks = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}
    blocks = {p: -(-c // block) for p, c in sizes.items()}
    lanes = {p: -(-c // query_block) for p, c in asks.items()}
    of = lambda d: F.element_at(F.create_map(*[F.lit(v) for kv in d.items() for v in kv]), F.col("part")) \
        if d else F.lit(None).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    left = asked.withColumn("lane", F.pmod(F.xxhash64("query_id"), of(lanes)).cast("int")).where(
        of(blocks).isNotNull()).select("part", every(of(blocks)).alias("block"), "lane", "query_id", "vector")
    right = filed.withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), of(blocks)).cast("int")).where(
        of(lanes).isNotNull()).select("part", "block", every(of(lanes)).alias("lane"), "vector", "ids")
    found = left.groupBy("part", "block", "lane").cogroup(right.groupBy("part", "block", "lane")).applyInArrow(
        _rank_block(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
