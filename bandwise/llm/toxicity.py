"""Toxicity by a classifier chain.

Categories are predicted in a fixed order by linear (logistic) models. The
model of a later category also sees the probabilities of the earlier ones; in
training these are out-of-fold, from models that haven't seen the row, so
that they look as they will on new texts.

Inputs are words and word beginnings that tell labelled toxic texts from others,
picked from counts that Spark makes over the fitting rows. The fitting
rows are a bounded sample of the labelled ones (``max_fit_docs``), which bounds
the model; every row is scored on its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import bounded_classes, text_chunks, written

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5)


def inputs_of(text: str | None) -> set[str]:
    """Distinct lower-cased words, and their beginnings marked with a star."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in BEGINNINGS))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Newton steps; the last weight is the intercept. A constant target gives a smoothed constant."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    w[-1] = np.log(rate / (1 - rate))
    if y.min(initial=1) == y.max(initial=0):
        return w
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (y - p) - penalty * w)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w


def apply_logistic(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class ToxicityChain:
    categories: list[str]
    inputs: dict[str, int]
    weights: list[np.ndarray]

    def matrix(self, found: list[set[str]]) -> np.ndarray:
        x = np.zeros((len(found), len(self.inputs)))
        for i, f in enumerate(found):
            x[i, [self.inputs[k] for k in f]] = 1
        return x

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        known = self.inputs.keys()
        x = self.matrix([known & inputs_of(t) for t in texts])
        for w in self.weights:
            x = np.hstack([x, apply_logistic(w, x)[:, None]])
        return x[:, len(self.inputs):]


def ranked_inputs(sample: DataFrame, target: int, min_rows: int) -> tuple[DataFrame, dict[bool, int]]:
    """input, clean, toxic, difference, weight of the inputs in ``min_rows`` rows, and the rows by toxicity: the
    column numbered ``target`` (id and text come first) over 0. ``weight`` is the squared difference of the shares
    among toxic and other rows against its variance under no difference."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            n = [Counter(), Counter()]
            for text, y in zip(chunk.column(1).to_pylist(), chunk.column(target).to_pylist()):
                n[int(y > 0)].update(inputs_of(text))
            keys = list(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([n[0][k] for k in keys], pa.int64()),
                 pa.array([n[1][k] for k in keys], pa.int64())], ["input", "clean", "toxic"])

    size = sample.groupBy((F.col(sample.columns[target]) > 0).alias("y")).count().collect()
    size = {r["y"]: r["count"] for r in size}
    bad, good = F.col("toxic") / float(size.get(True, 0) or 1), F.col("clean") / float(size.get(False, 0) or 1)
    n = float(sum(size.values()) or 1)
    share = (F.col("toxic") + F.col("clean")) / n
    return (sample.mapInArrow(count, "input string, clean long, toxic long").groupBy("input")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where(F.col("clean") + F.col("toxic") >= min_rows).withColumn("difference", bad - good)
            .withColumn("weight", F.pow(bad - good, F.lit(2.0)) / (share * (1 - share) + 1.0 / n))), size


def fit_chain(rows: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
              max_fit_docs: int = 6000, max_inputs: int = 256, min_rows: int = 4, folds: int = 5,
              ridge: float = 0.05, least_class_docs: int = 500) -> ToxicityChain | None:
    """Chain over the 0/1 columns ``categories``, predicted in that order; the last one picks
    the inputs. Rows with a null text or label are left out; None if none is usable."""
    usable = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         *[F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)])
    usable = usable.where(F.expr(" and ".join(["text is not null"] + [
        f"y{i} is not null" for i in range(len(categories))])))
    sample = bounded_classes(usable, max_fit_docs, least_class_docs, "doc_id", F.col(f"y{len(categories) - 1}") > 0)
    target = len(categories) + 1

    ranked, size = ranked_inputs(sample, target, min_rows)
    if not size:
        return None
    picked = ranked.orderBy(F.desc("weight"), "input").limit(max_inputs).collect()
    chain = ToxicityChain(list(categories), {r["input"]: i for i, r in enumerate(picked)}, [])
    known = set(chain.inputs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            rows = [sorted(chain.inputs[k] for k in known & inputs_of(t)) for t in chunk.column(1).to_pylist()]
            ids = [hash_fold(d, folds) for d in chunk.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int32()), pa.array(rows, pa.list_(pa.int32())),
                 pa.array(list(zip(*(c.to_pylist() for c in chunk.columns[2:]))), pa.list_(pa.int32()))],
                ["fold", "found", "y"])

    got = sample.mapInArrow(find, "fold int, found array<int>, y array<int>").collect()  # max_fit_docs rows
    x = np.zeros((len(got), len(chain.inputs)))
    for i, r in enumerate(got):
        x[i, r["found"]] = 1
    y = np.array([r["y"] for r in got], float).reshape(len(got), len(categories)) > 0
    fold = np.array([r["fold"] for r in got])
    for c in range(len(categories)):
        ahead = np.zeros(len(got))
        for f in range(folds):
            out = fold == f
            if out.any():
                w = fit_logistic(x[~out], y[~out, c].astype(float), ridge) if (~out).any() else \
                    fit_logistic(x, y[:, c].astype(float), ridge)
                ahead[out] = apply_logistic(w, x[out])
        chain.weights.append(fit_logistic(x, y[:, c].astype(float), ridge))
        x = np.hstack([x, ahead[:, None]])
    return chain


def hash_fold(key, folds: int) -> int:
    """A fold that depends on the id alone."""
    import zlib

    return zlib.crc32(str(key).encode()) // 7 % folds


def score_chain(docs: DataFrame, chain: ToxicityChain | None, id_col: str = "doc_id",
                text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, p_<category> ..., rejected (last category at ``threshold`` or more) of every row.

    Null and empty texts hold no input and get the base rates; without a model all probabilities
    are 0. Repeated rows and null ids are rows like any other; an empty table
    gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    if chain is None:
        return slim.select("doc_id", F.lit(0.0).alias("p_toxic"), F.lit(False).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            p = shared.value.probabilities(chunk.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), *[pa.array(p[:, i]) for i in range(p.shape[1])],
                 pa.array(p[:, -1] >= threshold)], ["doc_id", *names, "rejected"])

    return slim.mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names) + ", rejected boolean")


def keep_accepted(docs: DataFrame, chain: ToxicityChain | None, text_col: str = "text",
                  threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the chain doesn't reject; null and empty texts stay."""
    if chain is None:
        return docs
    shared, at = docs.sparkSession.sparkContext.broadcast(chain), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, at):
            texts = chunk.column(at).to_pylist()
            p = shared.value.probabilities(texts)
            yield chunk.filter(pa.array((p[:, -1] < threshold) | np.array([not t for t in texts], bool)))

    return docs.mapInArrow(run, docs.schema)


def marker_groups(rows: DataFrame, max_inputs: int = 64, min_rows: int = 4) -> list[set[str]]:
    """Two groups of the inputs that mark the toxic of ``rows`` (doc_id, text, label): those that stand
    together in the same toxic texts are in one group. Chosen from what the labels tell, whatever the
    language; the group with the strongest mark comes first. Marks that all stand in the same texts
    are one group, and the other is empty."""
    ranked, size = ranked_inputs(rows, 2, min_rows)
    if not size.get(True):
        return [set(), set()]
    ranked = ranked.persist()
    tested = ranked.count()
    best = ranked.where("difference > 0").orderBy(F.desc("weight"), "input").limit(max_inputs).collect()
    ranked.unpersist()
    scale = size[True] * size.get(False, 0) / sum(size.values())  # makes a weight the square of a standard score
    # the largest of so many squared scores is about this by chance
    chance = 2 * np.log(max(tested, 2))
    marks = [r["input"] for k, r in enumerate(best) if k < 2 or r["weight"] * scale >= chance]
    if len(marks) < 2:
        return [set(marks), set()]
    at = {m: i for i, m in enumerate(marks)}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(at), len(at)), np.int64)
        for chunk in text_chunks(batches):
            for text in chunk.column(1).to_pylist():
                here = [at[m] for m in at.keys() & inputs_of(text)]
                n[np.ix_(here, here)] += 1
        i, j = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(n[i, j])], ["i", "j", "n"])

    together = np.zeros((len(marks), len(marks)))
    for r in rows.where(F.col(rows.columns[2]) > 0).mapInArrow(pairs, "i int, j int, n long").groupBy("i", "j").agg(
            F.sum("n").alias("n")).collect():  # max_inputs ** 2 rows at most
        together[r["i"], r["j"]] = r["n"]
    alone = np.sqrt(np.diag(together))
    like = together / np.outer(alone, alone)
    like = like - like.mean(0) - like.mean(1)[:, None] + like.mean()
    values, sides = np.linalg.eigh(like)
    if values[-1] < 1e-9:
        return [set(marks), set()]
    side = sides[:, -1]  # sums to zero, so both groups have marks
    first = side * (1 if side[0] >= 0 else -1) > 0
    first[0] = True
    return [{m for m in marks if first[at[m]]}, {m for m in marks if not first[at[m]]}]


def weak_categories(docs: DataFrame, labels: DataFrame, label_col: str = "toxic",
                    max_fit_docs: int = 6000, least_class_docs: int = 500) -> DataFrame:
    """doc_id, text, insult, contempt, toxic: labelled rows with the chain's three targets.

    The table labels toxicity alone; the first two categories are the toxic texts that hold a mark of
    either of ``marker_groups``. A document labelled several times is toxic if any label says so.
    About ``max_fit_docs`` labels are taken, which bounds what is broadcast to meet the texts; a rare class has
    ``least_class_docs`` of them, or all its rows. The rows are written, so that the passes that fit a chain
    run over a table: one Python worker a task, not one for the targets and one for the pass.
    """
    by_doc = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label_col).cast("int")).alias("_label")).where("_label is not null")
    by_doc = bounded_classes(by_doc, max_fit_docs, least_class_docs, "doc_id", F.col("_label") > 0)
    rows = written(docs.select("doc_id", "text").join(F.broadcast(by_doc), "doc_id").select("doc_id", "text", "_label"),
                   "labelled")
    groups = marker_groups(rows)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            found = [inputs_of(t) if y > 0 else set() for t, y in zip(chunk.column(1).to_pylist(), chunk.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), chunk.column(1), *[pa.array([int(not g.isdisjoint(f)) for f in found], pa.int32()) for g in groups],
                 chunk.column(2)], ["doc_id", "text", "insult", "contempt", "toxic"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(told, f"doc_id {kind}, text string, insult int, contempt int, toxic int"), "targets")
