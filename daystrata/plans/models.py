"""Model jobs on Spark ML: PCA, random forests, logistic regression.

Fitting reads the data, so these functions are eager; what comes back to the driver is the fitted model
(coefficients, loadings, trees), never rows.  Training input is persisted for the passes of the fit.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from daystrata.functions import categories as C
from daystrata.operators import features as FE, recommend as REC, series, stats
from daystrata.plans import forests
from daystrata.plans.views import cached

# Inputs of the importance job and of the stress classifier.
IMPORTANCE_FEATURES = (
    "charged", "drained", "net_battery", "resting_hr", "sleep_hours", "deep_sleep_hours", "rem_sleep_hours", "steps",
)
CLASSIFIER_FEATURES = ("bodyBatteryChange", "restingHeartRate", "charged", "drained", "maxStressLevel")
# Search grid of the regression forest.  30 is the deepest tree Spark grows and stands
# for unlimited depth; Spark has no minimum size for splitting a node, so that axis is absent.
FULL_GRID = {"numTrees": (100, 200, 300), "maxDepth": (5, 10, 20, 30), "minInstancesPerNode": (1, 2, 4)}


@contextmanager
def kept(df: DataFrame):
    held = cached(df)
    try:
        yield held
    finally:
        held.unpersist()


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


# ---------------------------------------------------------------- PCA
@dataclass
class PcaFit:
    features: list[str]
    loadings: list[list[float]]  # [feature][component]
    ratios: list[float]
    scaled: DataFrame

    def explained_variance(self) -> DataFrame:
        """(component, ratio, cumulative) of all components."""
        rows = [(i + 1, float(r)) for i, r in enumerate(self.ratios)]
        table = self.scaled.sparkSession.createDataFrame(rows, "component int, ratio double")
        running = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
        return table.withColumn("cumulative", F.sum("ratio").over(running))

    def loading_table(self, components: int = 2) -> DataFrame:
        """(feature, pc1, pc2, ...) rounded to 3 digits, by PC1 descending."""
        rows = [(f, *[float(x) for x in row[:components]]) for f, row in zip(self.features, self.loadings)]
        names = [f"pc{i + 1}" for i in range(components)]
        table = self.scaled.sparkSession.createDataFrame(rows, "feature string, " + ", ".join(f"{n} double" for n in names))
        return table.orderBy(F.desc("pc1")).select("feature", *[F.round(n, 3).alias(n) for n in names])

    def scores(self, carry: Sequence[str], components: int = 2) -> DataFrame:
        """Projection of every row; a dot product of columns, so no vector leaves the row format."""
        projected = [
            sum((F.col(f) * F.lit(float(row[i])) for f, row in zip(self.features, self.loadings)), F.lit(0.0)).alias(f"pc{i + 1}")
            for i in range(components)
        ]
        return self.scaled.select(*carry, *projected)


def pca_fit(df: DataFrame, *, target: str, exclude: Sequence[str] = (), carry: Sequence[str] = ()) -> PcaFit:
    """All components of the standardised numeric columns except the target.

    The sign of a component is free; here its largest loading is positive.
    """
    names = FE.numeric_columns(df, exclude=[target, *exclude])
    scaled = FE.standardize(df, names)
    with kept(assembled(scaled, names).select("features")) as vectors:
        model = PCA(k=len(names), inputCol="features", outputCol="scores").fit(vectors)
    matrix = model.pc.toArray().copy()
    for i in range(matrix.shape[1]):
        column = matrix[:, i]
        if column[abs(column).argmax()] < 0:
            matrix[:, i] = -column
    return PcaFit(names, matrix.tolist(), model.explainedVariance.toArray().tolist(), scaled)


# ---------------------------------------------------------------- random forest regression
@dataclass
class ForestSearch:
    model: object
    params: dict[str, int]
    metrics: DataFrame
    importances: list[tuple[str, float]]
    scores: DataFrame  # (numTrees, maxDepth, minInstancesPerNode, r2): mean over the folds, of every setting


#: Rows of a partition of the training data at least, so that short series don't pay for many tasks at each level.
_TRAIN_ROWS = 20_000
#: Rows times trees of a fit of the search at most, as the nodes of a fit, and their counts while it grows, are held at once.
_TREE_ROWS = 100_000


def rf_grid(df: DataFrame, *, target: str, features: Sequence[str] | None = None, ties: Sequence[str] = (),
            grid: dict[str, Iterable[int]] = FULL_GRID, folds: int = 3, seed: int = 42, parallelism: int = 6) -> ForestSearch:
    """Grid search over contiguous folds of the first 80 % of days, scored on the last 20 %.

    One forest for each fold and smallest leaf, with the most trees and the greatest depth of the grid, scores all
    settings (see :mod:`daystrata.plans.forests`); where it would get too large to be held at once, it is fitted as several
    forests with their own seeds, which hold its trees together.  The best by mean r2, the first of equals in the order of the grid,
    is fitted again on all training days.
    """
    names = list(features) if features is not None else FE.numeric_columns(df, exclude=[target, *ties])
    trees, depths, leaves = (sorted(grid.get(n, default)) for n, default in (("numTrees", (20,)), ("maxDepth", (5,)), ("minInstancesPerNode", (1,))))
    order = [F.col("date"), *[F.col(t) for t in ties]]
    buckets = [F.col("date"), *[F.floor(F.col(t) / 4096) for t in ties[:1]]]
    label = F.col(target).cast("double").alias("label")
    with kept(FE.chronological_split(df, ties=ties)) as split:
        placed = series.nth_partition_split(split.filter("split = 'train'"), order, buckets=buckets, parts=folds)
        with kept(assembled(placed, names).select("features", label, "fold", *names)) as data:
            days = data.count()
            few = data.coalesce(max(1, -(-days // _TRAIN_ROWS)))
            step = max(1, _TREE_ROWS // max(1, days))

            def fitted(rows: DataFrame, n: int, depth: int, leaf: int, first: int = 0):
                return RandomForestRegressor(
                    labelCol="label", featureSubsetStrategy="all", seed=seed + first, numTrees=n, maxDepth=depth, minInstancesPerNode=leaf, cacheNodeIds=True,
                ).fit(rows.select("features", "label"))

            def search(task: tuple[int, int]) -> list[tuple[int, int, int, int, float]]:
                fold, leaf = task
                rest = few.filter(F.col("fold") != fold)
                nodes = forests.joined([
                    forests.nodes_of(fitted(rest, min(step, trees[-1] - first), depths[-1], leaf, first), df.sparkSession)
                    for first in range(0, trees[-1], step)
                ])
                rows = forests.scored(few.filter(F.col("fold") == fold), names, nodes, depths, trees)
                found = stats.regression_metrics(rows, "prediction", "label", keys=["numTrees", "maxDepth"]).collect()
                return [(r["numTrees"], r["maxDepth"], leaf, fold, r["r2"]) for r in found]

            with ThreadPool(parallelism) as pool:
                each = pool.map(inheritable_thread_target(df.sparkSession)(search), [(fold, leaf) for fold in range(folds) for leaf in leaves])
            rows = [row for part in each for row in part]
            mean = {s: sum(r[-1] for r in rows if r[:3] == s) / folds for s in product(trees, depths, leaves)}
            best = max(mean, key=mean.get)
            model = fitted(few, *best)
        test = assembled(split.filter("split = 'test'"), names).select("features", label)
        metrics = stats.regression_metrics(model.transform(test), "prediction", "label").head()
    spark = df.sparkSession
    scores = spark.createDataFrame([(*s, r2) for s, r2 in mean.items()], "numTrees int, maxDepth int, minInstancesPerNode int, r2 double")
    table = spark.createDataFrame([tuple(metrics)], "r2 double, rmse double, mae double")
    params = dict(zip(("numTrees", "maxDepth", "minInstancesPerNode"), best))
    return ForestSearch(model, params, table, list(zip(names, model.featureImportances.toArray().tolist())), scores)


def rf_importance(df: DataFrame, *, target: str = "avg_stress", wanted: Sequence[str] = IMPORTANCE_FEATURES,
                  trees: int = 100, depth: int = 5, seed: int = 42, more_than: int = 20) -> DataFrame:
    """(feature, importance, corr, direction); no rows when there are not enough complete days."""
    names = FE.existing_columns(df, wanted)
    complete = FE.dropna_subset(df.select(*names, target), [*names, target])
    spark = df.sparkSession
    if complete.limit(more_than + 1).count() <= more_than:
        return spark.createDataFrame([], "feature string, importance double, corr double, direction string")
    with kept(complete) as data:
        vectors = assembled(data, names).select("features", F.col(target).cast("double").alias("label"))
        forest = RandomForestRegressor(numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed)
        model = forest.fit(vectors)
        row = data.agg(*[stats.correlation(F.col(n), F.col(target)).alias(n) for n in names]).head()
    rows = [(n, float(v), row[n]) for n, v in zip(names, model.featureImportances.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double, corr double")
    return table.withColumn("direction", C.direction(F.col("corr")))


def top_importances(importances: DataFrame, n: int = 3) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


# ---------------------------------------------------------------- logistic regression
@dataclass
class LogisticFit:
    features: list[str]
    model: LogisticRegressionModel
    scored: DataFrame  # scaled features, label, split, logit, probability, prediction

    def coefficients(self) -> DataFrame:
        """(feature, coefficient, odds_ratio), largest absolute coefficient first; then the intercept."""
        rows = [(n, float(c)) for n, c in zip(self.features, self.model.coefficients.toArray())]
        spark = self.scored.sparkSession
        table = spark.createDataFrame([*rows, ("(intercept)", float(self.model.intercept))], "feature string, coefficient double")
        table = table.withColumn("odds_ratio", C.odds_ratio(F.col("coefficient")))
        return table.orderBy(F.col("feature") == "(intercept)", F.abs("coefficient").desc())

    def accuracy(self) -> DataFrame:
        return stats.accuracy(self.scored, "prediction", "label", keys=["split"])


def _logistic(train: DataFrame, names: Sequence[str], c: float, iterations: int) -> LogisticRegressionModel:
    """L2 with strength C: the penalty on the mean loss is 1 / (C * rows)."""
    with kept(assembled(train, names).select("features", F.col("label").cast("double").alias("label"))) as data:
        rows = data.count()
        estimator = LogisticRegression(
            regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=1e-10
        )
        return estimator.fit(data)


def _score(df: DataFrame, names: Sequence[str], model: LogisticRegressionModel) -> DataFrame:
    """Scores as column arithmetic: no vectors needed."""
    weights = dict(zip(names, model.coefficients.toArray().tolist()))
    logit = C.linear_logit(weights, float(model.intercept))
    scored = df.withColumn("logit", logit).withColumn("probability", C.sigmoid(F.col("logit")))
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def logistic_scaled(df: DataFrame, *, identity: Sequence[str], target: str = "avgStressLevel",
                    wanted: Sequence[str] = CLASSIFIER_FEATURES, c: float = 0.1, iterations: int = 1000) -> LogisticFit:
    """High-stress classifier: stratified 80/20 split, scaler fitted on the training part only."""
    names = FE.existing_columns(df, wanted)
    labelled = df.select(*identity, *names, C.high_stress_label(F.col(target)).alias("label"))
    with kept(FE.stratified_split(labelled, "label", identity)) as split:
        scaled = FE.standardize(split, names, fit_on=split.filter("split = 'train'"))
        model = _logistic(scaled.filter("split = 'train'"), names, c, iterations)
    return LogisticFit(list(names), model, _score(scaled, names, model))


def logistic_full(df: DataFrame, *, target: str = "avgStressLevel", wanted: Sequence[str] = CLASSIFIER_FEATURES,
                  carry: Sequence[str] = (), iterations: int = 2000) -> LogisticFit:
    """The same on raw features with C = 1, fitted and scored on all rows."""
    names = FE.existing_columns(df, wanted)
    labelled = df.select(*carry, *names, C.high_stress_label(F.col(target)).alias("label"), F.lit("all").alias("split"))
    model = _logistic(labelled, names, 1.0, iterations)
    return LogisticFit(list(names), model, _score(labelled, names, model))


def logit_curve(scored: DataFrame, points: int = 500, logit: str = "logit") -> DataFrame:
    """The sigmoid at equally spaced logits between the smallest and the largest one."""
    ends = scored.select(F.struct(F.min(logit).alias("low"), F.max(logit).alias("high")).alias("e"))
    grid = scored.sparkSession.range(points).select(F.col("id"), ends.scalar().alias("e"))
    at = F.col("e.low") + (F.col("e.high") - F.col("e.low")) * F.col("id") / (points - 1)
    return grid.select(F.col("id").alias("point"), at.alias("logit")).withColumn("probability", C.sigmoid(F.col("logit")))


# ---------------------------------------------------------------- place classifier
#: Rows of a task of the classifier at most, and at least where there are cores for more tasks.
_CLASSIFIER_ROWS = (200_000, 20_000)


def _dealt(data: DataFrame) -> DataFrame:
    """Training rows in as many tasks as their number asks for: files cut by bytes leave cores idle at every level of
    the trees, while each task sends counts of all nodes, so there are no more tasks than cores unless they get too long."""
    rows, cores = data.count(), data.sparkSession.sparkContext.defaultParallelism
    most, least = (-(-rows // n) for n in _CLASSIFIER_ROWS)
    tasks = max(most, min(least, cores))
    return data.repartition(tasks) if tasks > data.rdd.getNumPartitions() else data


def fit_place_classifier(rows: DataFrame, features: Sequence[str], *, label: str = "name", trees: int = 100,
                         depth: int = 10, seed: int = 42):
    """Multi-class forest from feature rows to place names.  The model grows with the number of
    classes, which must be a short list."""
    stages = [
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed),
    ]
    with kept(rows.select(label, *features)) as data:
        return Pipeline(stages=stages).fit(_dealt(data))


def class_probabilities(model, contexts: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, name, probability): one row per context and class."""
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    scored = model.stages[2].transform(model.stages[1].transform(contexts))
    chances: Column = F.arrays_zip(names.alias("name"), vector_to_array("probability").alias("probability"))
    return scored.select(*keys, F.inline(chances))


def with_chances(users: DataFrame, model, *, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``chances``: place name to class probability for the user's mood and weather.

    The model scores each distinct context once: there are at most as many as moods times kinds of weather, however many
    users share one; the probabilities, a map as long as the short list of classes, then join the users by context.
    """
    features = list(REC.FEATURE_ORDER)
    own = [f"_{c}" for c in features]
    people = REC.mood_features(REC.with_weather_defaults(users), keys=users.columns).drop("mood")
    contexts = people.select(*features).distinct()
    scored = class_probabilities(model, contexts, keys=features)
    chances = scored.groupBy(*[F.col(c).alias(n) for c, n in zip(features, own)]).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "probability"))).alias("chances"))
    same = F.lit(True)
    for c, n in zip(features, own):
        same = same & (F.col(c) == F.col(n))
    return people.join(chances, same, "left").select(*users.columns, "chances")
