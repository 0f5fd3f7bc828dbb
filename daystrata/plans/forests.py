"""Nested forests: one fitted forest stands for all smaller ones of a search grid.

A deep tree holds the shallower ones as its top, because every node keeps its own prediction, and a forest holds
those of its first trees.  So a search over depths and numbers of trees needs one fit for each smallest leaf: the
largest forest is fitted, and rows are scored by all the others on their way down its trees.  The forests of the
first 100 or 200 trees are not those that another fit with fewer trees would draw, as the fit deals its random
numbers row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata import session

#: Rows walked down all trees at once.
STEP = 512


@dataclass
class Nodes:
    """All nodes of a forest; places of a tree's nodes follow each other from its root.  A leaf has feature -1."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predictions(self, x: np.ndarray, depths: Sequence[int], trees: Sequence[int]) -> np.ndarray:
        """(rows, depths, trees): mean of the first ``n`` trees, each followed for ``depth`` splits at most."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        out = np.empty((len(x), len(depths), len(trees)))
        last = np.array(trees) - 1
        for level in range(max(depths) + 1):
            for k in np.flatnonzero(np.array(depths) == level):
                out[:, k] = np.cumsum(self.value[node], axis=1)[:, last] / trees
            feature = self.feature[node]
            left = x[rows, feature] <= self.threshold[node]
            node = np.where(feature < 0, node, np.where(left, self.left[node], self.right[node]))
        return out


def nodes_of(model: RandomForestRegressionModel, spark: SparkSession) -> Nodes:
    """The model's nodes from its stored form; they are as large as the model, which the driver holds anyway.

    Only splits by threshold are read, as the features have no categories.
    """
    path = session.new_folder(spark, "forest")
    model.save(path)
    table = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.get("nodeData.split.leftCategoriesOrThreshold", 0).alias("threshold"),
    ).orderBy("treeID", "id").toArrow()
    columns = {n: table.column(n).to_numpy() for n in ("treeID", "id", "prediction", "leftChild", "rightChild", "feature")}
    threshold = table.column("threshold").fill_null(0.0).to_numpy()
    tree, own = columns["treeID"], columns["id"]
    roots = np.flatnonzero(own == 0)
    start = roots[tree]
    inner = columns["leftChild"] >= 0
    left, right = (np.where(inner, start + columns[n], 0) for n in ("leftChild", "rightChild"))
    return Nodes(roots, np.where(inner, columns["feature"], -1), threshold, left, right, columns["prediction"])


def joined(parts: Sequence[Nodes]) -> Nodes:
    """One forest of the trees of several."""
    starts = np.cumsum([0, *[len(p.value) for p in parts[:-1]]])

    def moved(name: str) -> np.ndarray:
        return np.concatenate([getattr(p, name) + start for p, start in zip(parts, starts)])

    return Nodes(moved("roots"), *[np.concatenate([getattr(p, n) for p in parts]) for n in ("feature", "threshold")],
                 moved("left"), moved("right"), np.concatenate([p.value for p in parts]))


def scored(rows: DataFrame, features: Sequence[str], nodes: Nodes, depths: Sequence[int], trees: Sequence[int], label: str = "label") -> DataFrame:
    """(maxDepth, numTrees, label, prediction): every row scored by every nested forest, in Arrow batches; no row is
    moved before the scores are summed up."""
    depths, trees = list(depths), list(trees)
    shared = rows.sparkSession.sparkContext.broadcast(nodes)
    at = {"maxDepth": np.repeat(depths, len(trees)), "numTrees": np.tile(trees, len(depths))}

    def walk(batches):
        own = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, STEP):
                part = batch.slice(k, STEP)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns[1:]])
                found = own.predictions(x, depths, trees).reshape(len(x), -1)
                yield pa.RecordBatch.from_pydict({
                    **{n: pa.array(np.tile(v, len(x)), pa.int32()) for n, v in at.items()},
                    "label": pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), found.shape[1])), "prediction": pa.array(found.ravel()),
                })

    plain = rows.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in features])
    session.ship(rows.sparkSession)
    return plain.mapInArrow(walk, "maxDepth int, numTrees int, label double, prediction double")
