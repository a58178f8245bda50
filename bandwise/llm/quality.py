"""Quality classifier: ridge on random Fourier features of document statistics, isotonic scores.

Statistics of every text are written once. Random Fourier features approximate
a Gaussian kernel over the standardised statistics; every task sums its rows'
normal equations and the driver solves the fixed-size system. The raw ridge
scores of a calibration fold are counted into a fixed number of bins, on which
pooled adjacent violators give the isotonic map to probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_chunks, written

STATS = ("log_chars", "log_words", "log_lines", "lower", "upper", "digit", "space", "newline",
         "mark", "stop", "high", "word_mean", "word_std", "distinct", "top_word", "repeat",
         "pair_distinct", "loud", "bare", "line_distinct", "marked_words", "longest")
#: Calibrated score bins and the range of raw scores that they cover.
BINS, LOW, HIGH = 512, -0.5, 1.5


def _byte_classes() -> np.ndarray:
    out = np.full(256, 5, np.int64)  # other marks
    out[128:] = 7
    out[ord("a"):ord("z") + 1] = 0
    out[ord("A"):ord("Z") + 1] = 1
    out[ord("0"):ord("9") + 1] = 2
    out[[9, 11, 12, 13, 32]] = 3
    out[10] = 4
    out[[ord(c) for c in ".,;:'\"?!-"]] = 6
    return out


_CLASS = _byte_classes()


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``STATS``; all zero where it is null or empty."""
    if not text:
        return [0.0] * len(STATS)
    raw = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(_CLASS[raw], minlength=8) / len(raw)
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    distinct = list(counts)
    loud = sum(counts[w] for w in distinct if w.isupper())
    bare = sum(counts[w] for w in distinct if not any(map(str.isalpha, w)))
    marked = sum(counts[w] for w in distinct if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum())
    repeat = sum(map(str.__eq__, words, words[1:]))
    return [np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)),
            *share[[0, 1, 2, 3, 4, 5, 6, 7]].tolist(),
            float(lengths.mean()), float(lengths.std()), len(counts) / n,
            max(counts.values(), default=0) / n, repeat / n, pairs / n, loud / n, bare / n,
            len(set(lines)) / len(lines), marked / n, np.log1p(float(lengths.max()))]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, stats (array) of every row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            rows = [statistics(t) for t in chunk.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, stats array<double>")


@dataclass
class QualityModel:
    """``score`` maps a matrix of statistics to probabilities."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    bins: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.cos(((stats - self.mean) / self.scale) @ self.directions + self.phase)
        return np.hstack([z * np.sqrt(2 / len(self.phase)), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.bins[bin_of(self.raw(stats))]


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted non-decreasing least-squares fit (pooled adjacent violators); bins without
    weight take the value to their left, those before the first weight the first value."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        if w <= 0:
            if blocks:
                blocks[-1][2] += 1
            else:
                blocks.append([0.0, 0.0, 1])
            continue
        if blocks and blocks[0][1] == 0.0 and len(blocks) == 1:
            blocks[0] = [v, w, blocks[0][2] + 1]
        else:
            blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _matrix(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten(), float).reshape(len(col), -1) if len(col) else np.zeros((0, len(STATS)))


def fit_quality(stats: DataFrame, labels: DataFrame, calibrate, features: int = 256,
                width: float = 0.6, ridge: float = 1e-3, seed: int = 7,
                tasks: int = 32) -> QualityModel | None:
    """Model from ``stats`` (doc_id, stats) and ``labels`` (doc_id, label 0/1), all rows of both.

    ``calibrate`` is a condition on doc_id: those rows fit the isotonic map, the
    others the ridge. Rows without a label count for nothing; a document
    labelled several times has the mean label. None without usable rows.
    """
    by_doc = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.avg(F.col("label").cast("double")).alias("label"))
    rows = written(stats.where("doc_id is not null").join(by_doc, "doc_id")
                   .select("stats", "label", calibrate.alias("calibrate")), "quality-rows")
    one = rows.agg(*[f(F.col("stats")[i]).alias(f"{k}{i}") for i in range(len(STATS))
                     for k, f in (("m", F.avg), ("s", F.stddev_pop))],
                   F.sum(F.when(~F.col("calibrate"), 1)).alias("fit"),
                   F.sum(F.when(F.col("calibrate"), 1)).alias("cal")).first()
    if not one["fit"]:
        return None
    rng = np.random.default_rng(seed)
    p = len(STATS)
    model = QualityModel(
        np.array([one[f"m{i}"] for i in range(p)]),
        np.array([max(one[f"s{i}"], 1e-9) for i in range(p)]),
        rng.normal(0, width / np.sqrt(p), (p, features)), rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.full(BINS, 0.5))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c, n = np.zeros((features + 1, features + 1)), np.zeros(features + 1), 0
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                z, y = model.features(_matrix(part.column(0))), np.asarray(part.column(1), float)
                a, c, n = a + z.T @ z, c + z.T @ y, n + len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([c.tobytes()])], ["a", "c"])

    a, c = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
    for r in rows.where("not calibrate").select("stats", "label").coalesce(tasks).mapInArrow(
            sums, "a binary, c binary").toLocalIterator():
        a += np.frombuffer(bytes(r["a"])).reshape(a.shape)
        c += np.frombuffer(bytes(r["c"]))
    model.weights = np.linalg.solve(a + ridge * one["fit"] * np.diag([1.0] * features + [1e-9]), c)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good = np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            at, y = bin_of(model.raw(_matrix(b.column(0)))), np.asarray(b.column(1), float)
            n += np.bincount(at, minlength=BINS)
            good += np.bincount(at, y, minlength=BINS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(good[at])], ["bin", "n", "good"])

    held = rows.where("calibrate") if one["cal"] else rows
    n, good = np.zeros(BINS), np.zeros(BINS)
    for r in held.select("stats", "label").mapInArrow(counts, "bin long, n double, good double").groupBy(
            "bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect():
        n[r["bin"]], good[r["bin"]] = r["n"], r["good"]
    model.bins = np.clip(isotonic(good / np.maximum(n, 1), n), 0, 1)
    return model


def score_quality(stats: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id, score of every row of ``stats``; 0.5 where no model could be fitted.

    Null and empty texts have all-zero statistics and are scored like any other; repeated rows
    and null ids stay; an empty table gives no rows.
    """
    kind = stats.schema["doc_id"].dataType.simpleString()
    if model is None:
        return stats.select("doc_id", F.lit(0.5).alias("score"))
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(shared.value.score(_matrix(b.column(1))))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")
