"""Model jobs against closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daystrata.operators import features as FE
from daystrata.plans import models as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 400
    base = rng.normal(size=n)
    cols = {
        "bodyBatteryChange": -base + rng.normal(size=n), "restingHeartRate": 60 + 3 * base + rng.normal(size=n), "charged": rng.normal(50, 9, n),
        "drained": rng.normal(40, 5, n), "maxStressLevel": 70 + 8 * base + rng.normal(size=n),
    }
    cols["avgStressLevel"] = 50 + 10 * base + rng.normal(size=n)
    rows = [(i, *[float(v[i]) for v in cols.values()]) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{c} double" for c in cols))
    return df.selectExpr("date_add(date'2024-01-01', cast(id as int)) as date", "id", *cols).repartition(5), cols


def test_pca_equals_eigenvalues(frame):
    df, cols = frame
    fit = M.pca_fit(df, target="avgStressLevel", exclude=["id"])
    x = np.column_stack([cols[c] for c in fit.features])
    x = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert fit.ratios == pytest.approx(values / values.sum())
    assert np.abs(np.array(fit.loadings)) == pytest.approx(np.abs(vectors), abs=1e-6)
    variance = fit.explained_variance().orderBy("component").collect()
    assert variance[-1].cumulative == pytest.approx(1.0)
    scores = np.array([[r.pc1, r.pc2] for r in fit.scores(["id"]).orderBy("id").collect()])
    assert scores == pytest.approx(x @ np.array(fit.loadings)[:, :2], abs=1e-6)
    table = fit.loading_table().collect()
    assert [r.pc1 for r in table] == sorted((r.pc1 for r in table), reverse=True)


def gradient(x, y, w, b, c):
    """Gradient of 0.5 w.w + C * sum of log losses, the intercept not penalised."""
    p = 1 / (1 + np.exp(-(x @ w + b)))
    return np.append(w / c + x.T @ (p - y), (p - y).sum())


def test_logistic_is_at_the_optimum(frame):
    df, _ = frame
    fit = M.logistic_scaled(df, identity=["id"])
    rows = fit.scored.filter("split = 'train'").collect()
    x, y = np.array([[r[c] for c in fit.features] for r in rows]), np.array([r.label for r in rows])
    assert x.mean(0) == pytest.approx(np.zeros(5), abs=1e-9) and x.std(0) == pytest.approx(np.ones(5))
    assert np.abs(gradient(x, y, fit.model.coefficients.toArray(), fit.model.intercept, 0.1)).max() < 1e-3
    assert len(rows) in (319, 320)
    scores = {r.split: r.accuracy for r in fit.accuracy().collect()}
    assert scores["train"] > 0.85 and scores["test"] > 0.8
    table = fit.coefficients().collect()
    assert table[-1].feature == "(intercept)" and abs(table[0].coefficient) >= abs(table[1].coefficient)
    assert table[0].odds_ratio == pytest.approx(np.exp(table[0].coefficient))


def test_full_logistic_and_curve(frame):
    df, _ = frame
    fit = M.logistic_full(df)
    rows = fit.scored.collect()
    x, y = np.array([[r[c] for c in fit.features] for r in rows]), np.array([r.label for r in rows])
    assert np.abs(gradient(x, y, fit.model.coefficients.toArray(), fit.model.intercept, 1.0)).max() < 0.1
    curve = M.logit_curve(fit.scored).orderBy("point").collect()
    assert len(curve) == 500
    assert curve[0].logit == pytest.approx(min(r.logit for r in rows)) and curve[-1].logit == pytest.approx(max(r.logit for r in rows))


def test_forest_grid_uses_later_days_for_the_test(frame):
    df, _ = frame
    grid = {"numTrees": (3, 8), "maxDepth": (2, 4), "minInstancesPerNode": (1,)}
    found = M.rf_grid(df.drop("id"), target="avgStressLevel", grid=grid)
    assert set(found.params) == set(grid) and found.params["maxDepth"] == 4
    metrics = found.metrics.first()
    assert metrics.r2 > 0.5 and metrics.rmse >= metrics.mae > 0
    assert sum(v for _, v in found.importances) == pytest.approx(1.0)


def test_importance_needs_more_than_twenty_rows(frame):
    df, _ = frame
    data = df.withColumnRenamed("avgStressLevel", "avg_stress").withColumn("net_battery", F.col("charged") - F.col("drained"))
    assert M.rf_importance(data.orderBy("id").limit(20)).count() == 0
    rows = M.rf_importance(data.orderBy("id").limit(21), trees=5).collect()
    assert {r.feature for r in rows} == {"charged", "drained", "net_battery"}
    assert len(M.top_importances(M.rf_importance(data, trees=5), 2).collect()) == 2


def test_class_probabilities_add_up(spark):
    rows = [(f"p{i % 4}", float(i % 4) + (i % 3) / 10, float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "name string, a double, b double")
    model = M.fit_place_classifier(df, ["a", "b"], trees=10, depth=4)
    got = M.class_probabilities(model, df.select("a", "b").limit(5).withColumn("k", F.monotonically_increasing_id()), keys=["k"])
    sums = {r.k: (r.n, r.s) for r in got.groupBy("k").agg(F.count("*").alias("n"), F.sum("probability").alias("s")).collect()}
    assert all(n == 4 and s == pytest.approx(1.0) for n, s in sums.values()) and len(sums) == 5


def test_classifier_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(M, "_CLASSIFIER_ROWS", (100, 10), raising=False)
    seen, fit = [], M.Pipeline.fit
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, data: seen.append(data.rdd.getNumPartitions()) or fit(self, data))
    cores = spark.sparkContext.defaultParallelism
    for n in (10, 400, 2000):
        df = spark.range(n).selectExpr("concat('p', id % 4) as name", "double(id % 4) as a", "double(id % 5) as b").coalesce(1)
        M.fit_place_classifier(df, ["a", "b"], trees=2, depth=2)
    assert seen == [1, max(4, min(40, cores)), max(20, min(200, cores))]


def test_analysis_frame_names(spark):
    cols = ", ".join(f"{c} double" for c in FE.ANALYSIS_COLUMNS)
    rows = [(None, *[float(i) if i % 3 else None for _ in FE.ANALYSIS_COLUMNS], None if i < 6 else i, i >= 6) for i in range(10)]
    df = spark.createDataFrame(rows, f"date date, {cols}, steps bigint, has_steps_data boolean")
    got = FE.analysis_frame(df)
    assert "steps" not in got.columns and "avgStressLevel" in got.columns and "date" not in got.columns
    assert got.filter("avgStressLevel is null").count() == 0


def test_registered_grid_is_the_full_one(spark, folder, monkeypatch):
    from daystrata.plans import queries as Q

    fitted, whole = {}, M.rf_grid

    def few_trees(df, **given):
        fitted.update(given)
        return whole(df, **(given | {"grid": {"numTrees": (2,), "maxDepth": (2,)}}))

    monkeypatch.setattr(M, "rf_grid", few_trees)
    Q.rf_grid(spark, folder)
    assert fitted.get("grid", M.FULL_GRID) == M.FULL_GRID and len(M.FULL_GRID["numTrees"]) * len(M.FULL_GRID["maxDepth"]) * len(M.FULL_GRID["minInstancesPerNode"]) == 36
