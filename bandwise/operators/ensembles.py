"""Boosted trees as flat node arrays: every tree of several models scored in one Python pass."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Node visits (rows x trees) that one vectorised step holds.
STEP = 1 << 21
_SPLIT = re.compile(r"^\s*If \(feature (\d+) <= (\S+)\)$")
_OTHER = re.compile(r"^\s*Else \(feature \d+ > \S+\)$")
_LEAF = re.compile(r"^\s*Predict: (\S+)$")


@dataclass
class FlatTrees:
    """Nodes of all trees in one row of arrays; ``feature`` is -1 at a leaf, whose ``value`` already
    holds the tree's weight. A prediction is ``start`` plus the leaves' values, added in tree order."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        """Splits on the longest way from a root to a leaf."""
        here, n = self.roots, 0
        while (inner := here[self.feature[here] >= 0]).size:
            here, n = np.concatenate((self.left[inner], self.right[inner])), n + 1
        return n

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        if not len(self.roots):
            return out
        depth, rows = self.depth, max(1, STEP // len(self.roots))
        for at in range(0, len(x), rows):
            part = x[at:at + rows]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(depth):  # one level of all trees and rows at a time; a leaf leads to itself
                feature = self.feature[node]
                low = np.take_along_axis(part, np.maximum(feature, 0), 1) <= self.threshold[node]
                node = np.where(feature < 0, node, np.where(low, self.left[node], self.right[node]))
            for tree in range(len(self.roots)):
                out[at:at + rows] += self.value[node[:, tree]]
        return out


def _nodes(text: str) -> list[tuple]:
    """(feature, threshold, left, right, prediction) of a tree as Spark writes it out, in preorder.

    A split's left child follows it; the right one begins after its "Else"."""
    nodes, waiting, after_else = [], [], False
    for line in text.splitlines():
        split, leaf = _SPLIT.match(line), _LEAF.match(line)
        if split or leaf:
            if after_else:
                nodes[waiting.pop()][3] = len(nodes)
                after_else = False
            if split:
                waiting.append(len(nodes))
                nodes.append([int(split[1]), float(split[2]), len(nodes) + 1, -1, 0.0])
            else:
                nodes.append([-1, 0.0, len(nodes), len(nodes), float(leaf[1])])
        elif _OTHER.match(line):
            after_else = True
        elif re.match(r"^\s*(If|Else)", line):
            raise ValueError("only splits of continuous features can be flattened")
    return nodes


def flatten(trees: list, weights: list[float], start: float = 0.0, leaf_values: list[dict] | None = None) -> FlatTrees:
    """Node arrays of Spark regression trees. ``leaf_values`` replaces the predictions of each tree's leaves, by
    their number in preorder (Spark's leaf column); a leaf without one gets 0."""
    roots, parts, base = [], [], 0
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        nodes = np.array(_nodes(tree.toDebugString), float).reshape(-1, 5)
        leaf = nodes[:, 0] < 0
        if leaf_values is not None:
            nodes[leaf, 4] = [leaf_values[i].get(float(k), 0.0) for k in range(int(leaf.sum()))]
        nodes[:, 4] *= weight
        nodes[:, 2:4] += base
        roots.append(base)
        parts.append(nodes)
        base += len(nodes)
    flat = np.concatenate(parts) if parts else np.zeros((0, 5))
    whole = lambda c: flat[:, c].astype(np.int32)
    return FlatTrees(float(start), np.array(roots, np.int32), whole(0), flat[:, 1], whole(2), whole(3), flat[:, 4])


def predict_all(df: DataFrame, features_col: str, models: dict[str, FlatTrees]) -> DataFrame:
    """``df`` with one column for each model; only the features go to Python, once for all of them."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf(", ".join(f"`{c}` double" for c in models))
    def score(features: pd.Series) -> pd.DataFrame:
        x = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1))
        return pd.DataFrame({name: trees.predict(x) for name, trees in shared.value.items()})

    scored = df.withColumn("_bw_scores", score(vector_to_array(features_col)))
    return scored.select(*[F.col(c) for c in df.columns if c not in models],
                         *[F.col(f"_bw_scores.{c}").alias(c) for c in models])
