from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from faremeter.operators import features as X
from faremeter.operators import models as M
from faremeter.plans import learning
from faremeter.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(1, 1, 2), (2, 3, 1), (3, 2, 2)], "zone int, h int, v int")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src int, dst int")


@pytest.fixture(scope="module")
def trips(spark):
    n = F.col("id")
    return spark.range(400).select(
        ((n * 7) % 3 + 1).cast("int").alias("pickupid"),
        ((n * 5) % 3 + 1).cast("int").alias("dropoffid"),
        ((n * 37) % 101 / 10).alias("dist"),
    ).withColumn("duration", 120 * F.col("dist") + 300)


def test_features_leave_out_the_label(trips, edges, zones):
    built = X.trip_features(trips, edges, zones)
    assert X.feature_columns(built, "time") == ["dist", "near", "h_pu", "h_do", "v_pu", "v_do"]
    assert "time" not in X.feature_columns(built, "time", exclude=[]) and "duration" not in X.feature_columns(built, None)
    assert X.feature_columns(built, "dist", ["time"]) == ["pickupid", "dropoffid", "near", "h_pu", "h_do", "v_pu", "v_do"]
    assert built.filter("time <> duration / 60").count() == 0
    assert "time" not in X.trip_features(trips, edges, zones, label=None).columns


def test_linear_model_recovers_the_slope(trips, edges, zones):
    data = X.vectors(X.trip_features(trips, edges, zones), "time")
    model = M.fit(data, M.linear(regParam=0.0, elasticNetParam=0.0))
    assert model.coefficients[0] == pytest.approx(2.0, abs=1e-6)
    assert model.intercept == pytest.approx(5.0, abs=1e-4)
    assert M.evaluate(M.predict(model, data))["r2"] == pytest.approx(1.0)


def test_default_settings():
    lr = M.linear()
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam()) == (2000, 0.25, 0.8)
    gbt = M.boosted_trees()
    assert (gbt.getMaxIter(), gbt.getSubsamplingRate()) == (200, 0.8)
    assert M.FULL_GRID == {"maxDepth": [5, 10], "maxBins": [25, 40], "maxIter": [10, 50]}


def test_saved_model_predicts_the_same_without_a_label(trips, edges, zones, tmp_path):
    data = X.vectors(X.trip_features(trips, edges, zones), "time")
    model = M.fit(data, M.linear())
    path = str(tmp_path / "model")
    save_model(model, path)
    save_model(model, path)
    again = load_model(LinearRegressionModel, path)
    request = X.vectors(X.trip_features(trips.drop("duration"), edges, zones, label=None), None)
    want = sorted(r.prediction for r in M.predict(model, data).collect())
    assert sorted(r.prediction for r in M.predict(again, request).collect()) == pytest.approx(want)


def test_unknown_zone_is_an_error_unless_asked_otherwise(spark, edges, zones):
    trip = spark.createDataFrame([(1, 99, 2.0, 60.0)], "pickupid int, dropoffid int, dist double, duration double")
    built = X.trip_features(trip, edges, zones)
    assert built.first().near == 0 and built.first().h_do is None
    with pytest.raises(Exception):
        X.vectors(built, "time").collect()
    assert X.vectors(built, "time", invalid="skip").count() == 0
    assert X.vectors(built, "time", invalid="keep").count() == 1


def test_trees_indexing_and_search(trips, edges, zones):
    built = X.trip_features(trips, edges, zones)
    data = X.vectors(built, "time")
    rf = M.fit(data, M.random_forest(numTrees=3, maxDepth=4))
    assert M.evaluate(M.predict(rf, data))["r2"] > 0.5
    pipeline = M.indexed(["dist", "near", "h_pu"], M.boosted_trees(maxIter=2, maxDepth=3))
    assert M.predict(M.fit(built, pipeline), built).filter("prediction is null").count() == 0
    found = M.cross_validated(data, M.boosted_trees(), {"maxDepth": [1, 4], "maxIter": [2]}, folds=2)
    assert len(found.avgMetrics) == 2 and found.avgMetrics[1] < found.avgMetrics[0]


def test_queries_do_the_full_work(monkeypatch):
    """Without arguments the queries ask for all iterations and the whole grid."""
    asked = []
    monkeypatch.setattr(learning, "_split", lambda *_: (SimpleNamespace(drop=lambda *_: None),) * 2)
    monkeypatch.setattr(learning, "_predictions", lambda *_: None)
    monkeypatch.setattr(M, "predict", lambda *_: None)
    monkeypatch.setattr(M, "fit", lambda df, estimator: None)
    monkeypatch.setattr(M, "boosted_trees", lambda **params: asked.append(params))
    monkeypatch.setattr(M, "indexed", lambda *_: None)
    monkeypatch.setattr(M, "staged_search", lambda df, estimator, grid: asked.append(grid) or SimpleNamespace(model=None))
    learning.travel_time_gbt(None, "")
    learning.indexed_regression(None, "")
    learning.travel_time_cv(None, "")
    assert asked == [{"maxIter": 200, "maxDepth": 5}, {"maxIter": 20, "maxDepth": 5}, {}, M.FULL_GRID]


def test_staged_search_equals_the_plain_search(trips, edges, zones, monkeypatch):
    """Same errors at every point, same choice, same predictions, and one fit for all lengths."""
    data = X.vectors(X.trip_features(trips, edges, zones), "time").cache()
    grid = {"maxDepth": [1, 3], "maxBins": [8, 16], "maxIter": [2, 6]}
    plain = M.cross_validated(data, M.boosted_trees(), grid)
    fits, fit = [], M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, *a: fits.append(self.getMaxIter()) or fit(self, *a))
    staged = M.staged_search(data, M.boosted_trees(), grid)
    assert sorted(fits[:-1]) == [6] * 12 and len(fits) == 13
    points = [{p.name: v for p, v in m.items()} for m in plain.getEstimatorParamMaps()]
    want = {tuple(sorted(p.items())): e for p, e in zip(points, plain.avgMetrics, strict=True)}
    got = {tuple(sorted(p.items())): e for p, e in staged.points}
    assert got == pytest.approx(want, rel=1e-9)
    chosen = plain.bestModel
    assert {n: chosen.getOrDefault(n) for n in grid} == staged.best
    both = [sorted(r.prediction for r in M.predict(m, data).collect()) for m in (chosen, staged.model)]
    assert both[0] == pytest.approx(both[1])


def test_partitions_follow_the_rows(spark):
    assert M.in_task_sizes(spark.range(0, 250, numPartitions=8), 100).rdd.getNumPartitions() == 3
    assert M.in_task_sizes(spark.range(0, 0, numPartitions=2), 100).rdd.getNumPartitions() == 1


def test_large_pieces_are_cut_to_task_sizes(spark):
    """Two pieces of 5,000 rows become pieces of about a hundred; many small ones become fewer."""
    sizes = lambda df: [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
    cut = sizes(M.in_task_sizes(spark.range(0, 10_000, 1, 2), rows=100))
    assert len(cut) > 80 and max(cut) <= 200 and sum(cut) == 10_000
    assert len(sizes(M.in_task_sizes(spark.range(0, 100, 1, 20), rows=50))) <= 3
