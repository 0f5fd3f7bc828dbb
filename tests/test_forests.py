"""Nested forests beside separate fits, and the whole grid on a small frame."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from daystrata.plans import forests, models as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 3))
    y = 3 * x[:, 0] + np.sin(4 * x[:, 1]) + rng.normal(size=150) * 0.1
    rows = [(date(2024, 1, 1) + timedelta(days=i), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "date date, a double, b double, c double, label double").coalesce(1)


def test_cut_trees_equal_separate_fits(spark, frame):
    data = M.assembled(frame, ["a", "b", "c"]).cache()

    def fit(depth):
        return RandomForestRegressor(numTrees=12, maxDepth=depth, minInstancesPerNode=2, featureSubsetStrategy="all", seed=3).fit(data)

    deep = fit(30)
    nodes = forests.nodes_of(deep, spark)
    scored = forests.scored(frame, ["a", "b", "c"], nodes, [2, 5, 30], [4, 12]).groupBy("label", "maxDepth", "numTrees").agg(F.max("prediction").alias("p"))
    found = {(r["label"], r["maxDepth"], r["numTrees"]): r["p"] for r in scored.collect()}
    assert len(found) == 150 * 6
    for depth in (2, 5, 30):
        for r in fit(depth).transform(data).select("label", "prediction").collect():
            assert found[r["label"], depth, 12] == pytest.approx(r["prediction"], abs=1e-9)
    first = [t for t in deep.trees][:4]
    for r in data.select("label", "features").limit(20).collect():
        assert found[r["label"], 30, 4] == pytest.approx(np.mean([t.predict(r["features"]) for t in first]), abs=1e-9)


def test_all_settings_of_a_grid(spark, frame):
    grid = {"numTrees": (2, 4, 6), "maxDepth": (2, 3, 5, 30), "minInstancesPerNode": (1, 2, 4)}
    found = M.rf_grid(frame, target="label", grid=grid)
    scores = {(r["numTrees"], r["maxDepth"], r["minInstancesPerNode"]): r["r2"] for r in found.scores.collect()}
    assert len(scores) == 36 and scores[tuple(found.params.values())] == max(scores.values())
    metrics = found.metrics.first()
    assert metrics.r2 > 0.5 and metrics.rmse >= metrics.mae > 0 and sum(v for _, v in found.importances) == pytest.approx(1.0)
    assert found.model.getNumTrees == found.params["numTrees"]


def test_a_large_forest_is_fitted_in_parts(spark, frame, monkeypatch):
    """Only a part is held by the driver as a model; together they hold all trees."""
    monkeypatch.setattr(M, "_TREE_ROWS", 120 * 4, raising=False)
    sizes, nodes_of, scored = [], forests.nodes_of, forests.scored
    walked = []
    monkeypatch.setattr(forests, "nodes_of", lambda model, s: sizes.append(model.getNumTrees) or nodes_of(model, s))
    monkeypatch.setattr(forests, "scored", lambda rows, names, nodes, *more: walked.append(nodes) or scored(rows, names, nodes, *more))
    found = M.rf_grid(frame, target="label", grid={"numTrees": (4, 10), "maxDepth": (3, 30), "minInstancesPerNode": (1,)})
    assert sorted(sizes) == [2] * 3 + [4] * 6 and all(len(n.roots) == 10 for n in walked)
    for nodes in walked:
        inner = nodes.feature >= 0
        tree = np.searchsorted(nodes.roots, np.arange(len(nodes.value)), side="right")
        assert (tree[nodes.left[inner]] == tree[inner]).all() and (tree[nodes.right[inner]] == tree[inner]).all()
    assert found.metrics.first().r2 > 0.5 and found.scores.count() == 4
