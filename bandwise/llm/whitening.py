"""Whitening of embeddings by the leading components of their covariance.

Vectors become whole numbers first, ``floor(scale * c)`` (any whole number added to
them cancels from every result), so all sums are exact: sums and cross products are taken
in whole numbers about a whole-number centre, inside the tasks, and added by Spark. The one
p x p matrix that reaches the driver is rounded once, when it becomes floating point. Its leading eigenpairs come
from FEAST (``feast.py``). Their whitening is then measured: one more pass sums the
products of the whitened vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import written
from bandwise.llm.feast import greatest_eigenpairs

#: Rows that one step inside a task handles at once.
STEP = 4096
_EXACT = 1 << 53
_LONG = 1 << 63


def packed(x: np.ndarray) -> bytes:
    """A vector of whole numbers in the narrowest of three widths that holds it: equal vectors, equal bytes."""
    for kind in ("<i2", "<i4"):
        limits = np.iinfo(kind)
        if x.min(initial=0) >= limits.min and x.max(initial=0) <= limits.max:
            return x.astype(kind).tobytes()
    return x.astype("<i8").tobytes()


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    return np.array([np.frombuffer(b, f"<i{len(b) // dim}") for b in column.to_pylist()], np.int64).reshape(-1, dim)


def _quantizer(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                vectors = part.column(1)
                sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(vectors), 0), np.int64)
                ends = np.cumsum(sizes)
                c = np.asarray(pa.compute.fill_null(vectors.flatten().cast(pa.float64()), np.nan))
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * c)
                    usable = np.abs(x) < 2.0 ** 61  # false for NaN and infinity too
                unusable = np.concatenate(([0], np.cumsum(~usable)))
                ids = np.flatnonzero((sizes > 0) & (unusable[ends] == unusable[ends - sizes]))
                x = np.where(usable, x, 0).astype(np.int64)
                dims = sizes[ids].astype(np.int32)
                codes = [packed(x[e - d:e]) for d, e in zip(dims.tolist(), ends[ids].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(ids)), pa.array(dims),
                     pa.array(codes, pa.binary())], ["id", "dim", "code"])
    return run


def _added(dim: int, of):
    """Mapper that adds whole-number arrays ``of(x)`` over a task's vectors and gives them as cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = of(_unpacked(batch.column(0).slice(at, STEP), dim)).astype(object)
                total = part if total is None else total + part
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat)), pa.int64()),
                 pa.array([Decimal(int(x)) for x in flat], pa.decimal128(38, 0))], ["cell", "total"])
    return run


def _whole_sums(x: np.ndarray) -> np.ndarray:
    big = int(np.abs(x).max(initial=0)) * max(len(x), 1) >= _LONG
    return np.append((x.astype(object) if big else x).sum(axis=0), len(x))


def _whole_products(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact cross products about a whole-number centre."""
    y = x - centre
    most = int(np.abs(y).max(initial=0)) ** 2 * max(len(y), 1)
    if most < _EXACT:  # every partial sum is a whole number that a double holds
        return np.rint(y.astype(float).T @ y.astype(float)).astype(np.int64)
    y = y if most < _LONG else y.astype(object)
    return y.T @ y


def _cells(fit: DataFrame, mapper) -> list[int]:
    """The added arrays of all tasks: a bounded number of cells."""
    rows = fit.select("code").mapInArrow(mapper, "cell long, total decimal(38,0)").groupBy("cell").agg(
        F.sum("total").alias("total")).collect()
    return [int(r["total"]) for r in sorted(rows, key=lambda r: r["cell"])]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
           scale: float = 64.0) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    A vector that is null or empty, or holds a null or non-finite entry or one whose whole number doesn't
    fit 62 bits, takes no part; neither does one of another length than most vectors have (ties: the shorter length). Every other row
    gets its components, with a null id too, and repeated rows repeat theirs. The components are fitted to each distinct
    vector once: unit eigenvectors of its covariance by falling eigenvalue, at most ``components``, and only
    those above 1e-12 of the greatest eigenvalue: constant dimensions give none, a single distinct vector or an
    empty table gives no rows at all. ``deviation`` is the exact sum of (n x - S)^2, null where that doesn't fit 64 bits.
    The sign of a component is that which makes its largest entry positive. Other columns are ignored.
    What reaches the driver is p x p sums for p dimensions.
    """
    session = rows.sparkSession
    slim = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = slim.schema["id"].dataType.simpleString()
    out = (f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")
    usable = written(slim.mapInArrow(_quantizer(scale), f"id {kind}, dim int, code binary"), "vectors")
    most = usable.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return session.createDataFrame([], out)
    dim = most["dim"]
    usable = usable.where(F.col("dim") == dim)
    fit = written(usable.select("code").distinct(), "distinct-vectors")
    *sums, n = _cells(fit, _added(dim, _whole_sums))
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]  # sums about the centre
    products = _cells(fit, _added(dim, lambda x: _whole_products(x, centre)))
    covariance = np.array([[(n * products[i * dim + j] - rest[i] * rest[j]) / (n * n) for j in range(dim)]
                           for i in range(dim)])
    values, vectors = greatest_eigenpairs(covariance, components)
    k = len(values)
    if not k:
        return session.createDataFrame([], out)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    matrix, mean = vectors / np.sqrt(values), np.array([r / n for r in rest])
    explained = values / covariance.trace()

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - centre) - mean) @ matrix

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                w = project(_unpacked(batch.column(0).slice(at, STEP), dim))
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int64()), pa.array(total.ravel())],
                                         ["cell", "total"])

    measured = fit.mapInArrow(measure, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.array([r["total"] for r in sorted(measured.collect(), key=lambda r: r["cell"])]).reshape(k + 1, k) / n
    error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                x = _unpacked(part.column(1), dim)
                y, m = x - centre, len(x)
                reach = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
                wide = reach * reach * dim >= _LONG
                from_sum = (y.astype(object) if wide else y) * n - np.array(rest, object if wide else np.int64)
                squares = [int(s) if s < _LONG else None for s in (from_sum * from_sum).sum(axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n), pa.int64()),
                     pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.select("id", "code").mapInArrow(apply, out)
