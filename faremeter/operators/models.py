"""Regression models over feature vectors, all MLlib estimators."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremeter.operators.aggregates import regression_metrics

# The parameter grid of the cross-validated search.
FULL_GRID = {"maxDepth": [5, 10], "maxBins": [25, 40], "maxIter": [10, 50]}


def linear(label: str = "time", **params) -> LinearRegression:
    """Elastic-net linear regression."""
    settings = {"maxIter": 2000, "regParam": 0.25, "elasticNetParam": 0.8, **params}
    return LinearRegression(featuresCol="features", labelCol=label, **settings)


def least_squares(label: str = "time") -> LinearRegression:
    """Linear regression without a penalty, solved by the normal equations."""
    return LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, elasticNetParam=0.0, solver="normal")


def boosted_trees(label: str = "time", **params) -> GBTRegressor:
    settings = {"maxIter": 200, "subsamplingRate": 0.8, "seed": 1024, **params}
    return GBTRegressor(featuresCol="features", labelCol=label, **settings)


def random_forest(label: str = "time", **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol=label, **{"seed": 1024, **params})


def fit(df: DataFrame, estimator: Estimator, label: str = "time") -> Model:
    """Fit on the rows that have a label."""
    return estimator.fit(df.dropna(subset=[label]))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add `prediction`; `df` needs the features the model was fitted on, but no label."""
    return model.transform(df)


def evaluate(predictions: DataFrame, label: str = "time") -> dict[str, float]:
    """mse, rmse and r2 of a prediction table, in one pass over it."""
    return regression_metrics(predictions, label, "prediction").first().asDict()


def indexed(inputs: Sequence[str], estimator: Estimator, max_categories: int = 4) -> Pipeline:
    """Vector assembly, indexing of low-cardinality features and an estimator as one MLlib Pipeline."""
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="raw_features")
    indexer = VectorIndexer(
        inputCol="raw_features", outputCol="features", maxCategories=max_categories, handleInvalid="keep"
    )
    return Pipeline(stages=[assembler, indexer, estimator])


def cross_validated(
    df: DataFrame,
    estimator: Estimator,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 3,
    seed: int = 1024,
    label: str = "time",
    parallelism: int = 4,
) -> Model:
    """Grid search by cross-validated RMSE; `grid` maps parameter names to values."""
    builder = ParamGridBuilder()
    for name, values in (FULL_GRID if grid is None else grid).items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return fit(df, search, label)


class Search(NamedTuple):
    """A fitted model, the point of the grid it was fitted with, and every point with its mean error over the folds."""

    model: Model
    best: dict
    points: list[tuple[dict, float]]


def staged_search(
    df: DataFrame,
    estimator: GBTRegressor,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 3,
    seed: int = 1024,
    label: str = "time",
    parallelism: int = 8,
) -> Search:
    """`cross_validated` for boosted trees with one fit for all values of maxIter.

    Iterations are fitted one after another with seeds of their own, so a model of few iterations is the beginning of one
    of many. The errors after each iteration of the longest model give every shorter point of the grid, exactly; each
    fold and each combination of the other parameters is fitted once. Folds, metric and choice are those of
    `cross_validated` (the first of equal points in its order).
    """
    names = list(FULL_GRID if grid is None else grid)
    values = [list((FULL_GRID if grid is None else grid)[n]) for n in names]
    points = [dict(zip(names, v, strict=True)) for v in product(*values)]
    lengths = sorted({p.get("maxIter", estimator.getMaxIter()) for p in points})
    others = [dict(t) for t in dict.fromkeys(tuple((n, v) for n, v in p.items() if n != "maxIter") for p in points)]
    labelled = df.dropna(subset=[label]).withColumn("_draw", F.rand(seed))

    def errors(task: tuple[int, dict]) -> list[float]:
        fold, params = task
        held = (F.col("_draw") >= fold / folds) & (F.col("_draw") < (fold + 1) / folds)
        longest = estimator.copy({estimator.getParam(n): v for n, v in {**params, "maxIter": lengths[-1]}.items()})
        losses = longest.fit(labelled.filter(~held)).evaluateEachIteration(labelled.filter(held), "squared")
        return [losses[n - 1] ** 0.5 for n in lengths]

    tasks = [(fold, params) for params in others for fold in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        found = dict(zip([(f, tuple(p.items())) for f, p in tasks], pool.map(errors, tasks, 1), strict=True))

    def mean_error(point: dict) -> float:
        rest = tuple((n, v) for n, v in point.items() if n != "maxIter")
        at = lengths.index(point.get("maxIter", estimator.getMaxIter()))
        return sum(found[fold, rest][at] for fold in range(folds)) / folds

    scored = [(p, mean_error(p)) for p in points]
    best = min(scored, key=lambda s: s[1])[0]
    model = estimator.copy({estimator.getParam(n): v for n, v in best.items()}).fit(df.dropna(subset=[label]))
    return Search(model, best, scored)


def in_task_sizes(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """The table in as many partitions as it has this many rows, for fits that pass over it hundreds of times.

    A stored table is read in pieces of a fixed number of bytes, which hold millions of rows where values compress well;
    such pieces are dealt out anew.
    """
    n = 1 + df.count() // rows
    return df.coalesce(n) if df.rdd.getNumPartitions() >= n else df.repartition(n)
