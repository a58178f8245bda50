"""k-means feature (F4-F6) and nearest-centre assignment for fixed centres."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from bandwise.functions.constants import KMEANS_K, KMEANS_STARTS, SEED
from bandwise.operators.blocks import few_partitions, summed_vectors
from bandwise.operators.prep import assemble
from bandwise.session import spread


def squared_distance(vec: Column, center: list[float]) -> Column:
    """Sum of squared differences, added in index order (a column expression)."""
    c = F.array(*[F.lit(float(v)) for v in center])
    sq = F.zip_with(vec, c, lambda a, b: (a - b) * (a - b))
    return F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)


def nearest_center(df: DataFrame, vec: str, centers: dict, out: str = "center",
                   dist: str = "distance") -> DataFrame:
    """Id of the nearest centre (ties: smallest id) and its squared distance.

    ``centers`` maps id -> coordinates; it is bounded by k, not by the rows,
    and is broadcast once. Each Arrow batch computes the exact squared
    distance to every centre in numpy (one pass of batch x dimension per
    centre), which is several times faster than k higher-order functions per
    row in the JVM.
    """
    ids = sorted(centers)
    mat = np.array([[float(v) for v in centers[i]] for i in ids])
    bc = df.sparkSession.sparkContext.broadcast((np.array(ids), mat))
    id_type = IntegerType() if all(-(2 ** 31) <= i < 2 ** 31 for i in ids) else LongType()
    schema = StructType([*df.schema.fields, StructField(out, id_type), StructField(dist, DoubleType())])

    def run(batches):
        cid, cmat = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                pdf[out], pdf[dist] = [], []
                yield pdf
                continue
            x = np.stack(pdf[vec].to_numpy()).astype(float)
            best = np.full(len(pdf), np.inf)
            arg = np.zeros(len(pdf), dtype=np.int64)
            for j in range(len(cid)):
                dj = ((x - cmat[j]) ** 2).sum(axis=1)
                better = dj < best          # strict: ties keep the smaller id
                best[better] = dj[better]
                arg[better] = j
            pdf[out] = cid[arg]
            pdf[dist] = best
            yield pdf

    return df.mapInPandas(run, schema)


def group_centroids(df: DataFrame, vec: str, label: str) -> dict:
    """Mean vector per label (one aggregate; k centres reach the driver)."""
    rows = (df.select(label, array_to_vector(F.col(vec)).alias("_v"))
            .groupBy(label).agg(Summarizer.mean(F.col("_v")).alias("_m")).collect())
    return {r[label]: [float(x) for x in r["_m"]] for r in rows}


@dataclass
class KMeansFeature:
    centers: list[list[float]]
    cost: float
    seed: int
    features_col: str

    def transform(self, df: DataFrame, out: str = "cluster", onehot: bool = False) -> DataFrame:
        """Adds the cluster id as a numeric feature (or one-hot), keeping all columns."""
        bc = df.sparkSession.sparkContext.broadcast(np.array(self.centers))

        @F.pandas_udf("int")
        def nearest(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype="int32")
            return pd.Series(assigned(np.stack(vectors.to_numpy()).astype(float), bc.value)[0].astype(np.int32))

        res = df.withColumn(out, nearest(vector_to_array(F.col(self.features_col))))
        if onehot:
            # as wide as the model has centres, whatever ids this frame holds
            slots = F.transform(F.sequence(F.lit(0), F.lit(len(self.centers) - 1)), lambda i: (i == F.col(out)).cast("double"))
            res = res.withColumn(f"{out}_onehot", array_to_vector(slots))
        return res


#: Rows whose distances to all centres are held at once.
DISTANCE_ROWS = 1024


def assigned(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every row (ties: the first) and its squared distance, which is a sum of squared differences.

    Distances to all centres come from one matrix product, about the centres' mean. Where the two least are closer than
    its rounding can tell, the row's distances are computed as sums too."""
    middle = centers.mean(axis=0)
    moved = centers - middle
    norms = (moved * moved).sum(axis=1)
    best = np.zeros(len(x), np.int64)
    for at in range(0, len(x), DISTANCE_ROWS):
        part = x[at:at + DISTANCE_ROWS] - middle
        near = norms - 2.0 * (part @ moved.T)
        rows = np.arange(len(part))
        first = near.argmin(axis=1)
        if len(centers) > 1:
            least = near[rows, first]
            near[rows, first] = np.inf
            doubt = ~(near.min(axis=1) - least > 1e-9 * ((part * part).sum(axis=1) + norms.max()))
            for i in np.flatnonzero(doubt):
                first[i] = ((x[at + i] - centers) ** 2).sum(axis=1).argmin()
        best[at:at + DISTANCE_ROWS] = first
    return best, ((x - centers[best]) ** 2).sum(axis=1)


def _vector_blocks(df: DataFrame, features_col: str, d: int):
    """The vectors as persisted matrices."""
    def pack(batches):
        for b in batches:
            if b.num_rows:
                flat = np.asarray(b.column(0).flatten(), float)
                yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], ["block"])

    packed = df.select(vector_to_array(F.col(features_col))).mapInArrow(pack, "block binary")
    return few_partitions(packed.rdd.map(lambda r: np.frombuffer(r[0]).reshape(-1, d)).persist(StorageLevel.MEMORY_AND_DISK))


def lloyd(blocks, starts: list[np.ndarray], max_iter: int, tol: float) -> list[tuple[np.ndarray, float]]:
    """(centres, cost) of k-means from each of ``starts``: one job an iteration for all that still move.

    As in Spark's KMeans: a start ends when no centre moves by more than ``tol``, its cost is that of the
    last assignment, and a centre without rows stays where it is."""
    centers, costs = [c.copy() for c in starts], [0.0] * len(starts)
    moving = list(range(len(starts)))
    for _ in range(max_iter):
        if not moving:
            break
        given = [centers[i] for i in moving]

        def run(part, given=given):
            acc = [np.zeros((len(c), c.shape[1] + 1)) for c in given]
            cost = np.zeros(len(given))
            for x in part:
                for j, c in enumerate(given):
                    best, dist = assigned(x, c)
                    cost[j] += dist.sum()
                    for col in range(x.shape[1]):
                        acc[j][:, col] += np.bincount(best, x[:, col], minlength=len(c))
                    acc[j][:, -1] += np.bincount(best, minlength=len(c))
            yield np.concatenate([cost, *[a.ravel() for a in acc]])

        summed = summed_vectors(blocks.mapPartitions(run))
        at, still = len(given), []
        for j, i in enumerate(moving):
            k, d = centers[i].shape
            part = summed[at:at + k * (d + 1)].reshape(k, d + 1)
            at += k * (d + 1)
            some = part[:, -1] > 0
            after = centers[i].copy()
            after[some] = part[some, :-1] / part[some, -1:]
            if (((after - centers[i]) ** 2).sum(axis=1) > tol * tol).any():
                still.append(i)
            centers[i], costs[i] = after, float(summed[j])
        moving = still
    return list(zip(centers, costs))


def fit_kmeans_feature(df: DataFrame, features_col: str, k: int = KMEANS_K,
                       starts: int = KMEANS_STARTS, seed: int = SEED, max_iter: int = 300,
                       tol: float = 1e-4, split_col: str | None = "split",
                       fit_on: str = "train", parallel: int = 4) -> KMeansFeature:
    """Best of ``starts`` k-means fits (seeds seed..seed+starts-1) by within-cluster cost.

    Each start begins with the centres that Spark's distributed k-means (k-means||) chooses; all starts
    then move together, in one pass over the training rows an iteration (``lloyd``).
    """
    src = df.where(F.col(split_col) == fit_on) if split_col else df
    src = spread(src.select(features_col)).persist()

    def begin(s: int) -> np.ndarray:
        found = KMeans(k=k, seed=s, maxIter=0, featuresCol=features_col).fit(src).clusterCenters()
        return np.array([[float(v) for v in c] for c in found])

    blocks = None
    try:
        # independent starts run as concurrent Spark jobs
        with ThreadPoolExecutor(max_workers=min(starts, parallel)) as pool:
            begun = list(pool.map(begin, range(seed, seed + starts)))
        blocks = _vector_blocks(src, features_col, begun[0].shape[1])
        fits = lloyd(blocks, begun, max_iter, tol)
    finally:
        src.unpersist()
        if blocks is not None:
            blocks.unpersist()
    best = min(range(starts), key=lambda i: fits[i][1])  # ties go to the lower seed
    return KMeansFeature([list(map(float, c)) for c in fits[best][0]], fits[best][1], seed + best, features_col)


def kmeans_on_columns(df: DataFrame, columns, out: str = "cluster", **fit) -> tuple[DataFrame, KMeansFeature]:
    """Cluster id from the columns named (P8, for example two coordinates), all other columns kept."""
    vector = "_bw_chosen"
    chosen = assemble(df, list(columns), vector)
    feature = fit_kmeans_feature(chosen, vector, **fit)
    return feature.transform(chosen, out).drop(vector), feature
