"""Travel-time and price models on the trips, and their evaluation."""
from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from faremeter.functions import scalars as S
from faremeter.functions.calendar import calendar_features
from faremeter.operators import features as X
from faremeter.operators import models as M
from faremeter.operators.aggregates import regression_metrics
from faremeter.plans import views as V
from faremeter.plans.registry import query
from faremeter.sources import tables as io
from faremeter.sources.models import load_model, save_model
from faremeter.sources.scratch import scratch_root, stored

LINE_KEY = ", ".join(V.LINE_KEY)
# Keys, and the measures that a request does not carry (of which price is a label, too).
EXCLUDE = [*V.LINE_KEY, *X.KEYS, "event_id", "trip_distance", "passengers", "price"]
FEATURES = ["dist", "dow", "dom", "month", "hour", "minute", "near", "h_pu", "h_do", "v_pu", "v_do"]


def _vectors(spark, d):
    """Trips as feature vectors."""
    trips = calendar_features(V.trips(spark, d), "pickup")
    built = X.trip_features(trips, V.edges(spark, d), V.zones(spark, d), "time")
    return X.vectors(built.select(*V.LINE_KEY, "price", "time", *FEATURES), "time", EXCLUDE)


def _training(spark, d):
    """The vectors stored once, because a fit passes over them many times."""
    return M.in_task_sizes(stored(_vectors(spark, d).select(*V.LINE_KEY, "price", "time", "features", *FEATURES), "training"))


def _requests(spark, d):
    """One request per event: its time, zones and stated distance, and no duration."""
    asked = V.event_trips(spark, d).select(
        "event_id",
        "ts",
        "pickupid",
        ((F.col("event_id") * 7) % 25).cast("int").alias("dropoffid"),
        (F.col("price") / 10).alias("dist"),
    )
    built = X.trip_features(calendar_features(asked, "ts"), V.edges(spark, d), V.zones(spark, d), label=None)
    return X.vectors(built.select("event_id", *FEATURES), "time", EXCLUDE)


def _predictions(df, label="time"):
    return df.select(*V.LINE_KEY, F.col(label).cast("double").alias(label), "prediction")


@query(
    "trip_features",
    f"""select {LINE_KEY}, case when src is not null then 1 else 0 end as near, duration / 60 as time,
          a.h as h_pu, b.h as h_do, a.v as v_pu, b.v as v_do
        from trips left join edges on pickupid = src and dropoffid = dst
          left join zones a on pickupid = a.zone left join zones b on dropoffid = b.zone""",
    "trips edges zones",
)
def trip_features(spark, d):
    built = X.trip_features(V.trips(spark, d), V.edges(spark, d), V.zones(spark, d))
    return built.select(*V.LINE_KEY, "near", "time", "h_pu", "h_do", "v_pu", "v_do")


@query(
    "feature_vectors",
    f"""select {LINE_KEY}, dist as f0, isodow(pickup) * 1e0 as f1, day(pickup) * 1e0 as f2, month(pickup) * 1e0 as f3,
          hour(pickup) * 1e0 as f4, minute(pickup) * 1e0 as f5, case when src is not null then 1e0 else 0e0 end as f6,
          a.h * 1e0 as f7, b.h * 1e0 as f8, a.v * 1e0 as f9, b.v * 1e0 as f10
        from trips left join edges on pickupid = src and dropoffid = dst
          left join zones a on pickupid = a.zone left join zones b on dropoffid = b.zone""",
    "trips edges zones",
)
def feature_vectors(spark, d):
    values = vector_to_array("features")
    return _vectors(spark, d).select(*V.LINE_KEY, *[values[i].alias(f"f{i}") for i in range(len(FEATURES))])


@query(
    "travel_time_ols",
    """select round(regr_slope(duration / 60, dist), 6) as slope, round(regr_intercept(duration / 60, dist), 6)
         as intercept, round(regr_r2(duration / 60, dist), 6) as r2 from trips""",
    "trips",
)
def travel_time_ols(spark, d):
    y, x = S.minutes(F.col("duration")), F.col("dist")
    return V.trips(spark, d).agg(
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    )


# ---- a model of distance alone, which SQL can fit too; a fifth of the trips is held out


def _distance_model(spark, d, label="time", estimator=None):
    """(fitted model, held-out trips as feature vectors)."""
    trips = V.trips(spark, d).withColumn("time", S.minutes(F.col("duration")))
    data = X.vectors(stored(trips.select(*V.LINE_KEY, "dist", label), "by-distance"), label, V.LINE_KEY)
    return M.fit(data.filter(~V.held_out()), estimator or M.least_squares(label), label), data.filter(V.held_out())


def distance_predictions(spark, d):
    """Held-out trips with the predicted time."""
    model, held = _distance_model(spark, d)
    return M.predict(model, held)


_SQUARED = "avg((time - prediction) * (time - prediction))"


def _metrics(spark, d):
    return regression_metrics(distance_predictions(spark, d), "time", "prediction")


@query("eval_mse", f"select round({_SQUARED}, 4) as mse from predicted", "predicted")
def eval_mse(spark, d):
    return _metrics(spark, d).select(F.round("mse", 4).alias("mse"))


@query("eval_rmse", f"select round(sqrt({_SQUARED}), 4) as rmse from predicted", "predicted")
def eval_rmse(spark, d):
    return _metrics(spark, d).select(F.round("rmse", 4).alias("rmse"))


@query("eval_r2", f"select round(1 - {_SQUARED} / var_pop(time), 6) as r2 from predicted", "predicted")
def eval_r2(spark, d):
    return _metrics(spark, d).select(F.round("r2", 6).alias("r2"))


@query("sink_predictions", f"select {LINE_KEY}, round(prediction, 4) as prediction from predicted", "predicted")
def sink_predictions(spark, d):
    """Predictions of a fitted model, written as a table that replaces an older one."""
    path = f"{scratch_root(spark)}/predictions-{uuid.uuid4().hex}"
    io.replace(V.zones(spark, d), path)
    done = distance_predictions(spark, d).select(*V.LINE_KEY, F.round("prediction", 4).alias("prediction"))
    return io.replace(done, path)


@query("saved_model_predict", f"select {LINE_KEY}, round(prediction, 4) as prediction from predicted", "predicted")
def saved_model_predict(spark, d):
    """Fit, save, load, and apply to held-out trips without their label."""
    model, held = _distance_model(spark, d)
    path = f"{scratch_root(spark)}/by-distance-{uuid.uuid4().hex}"
    save_model(model, path)
    done = M.predict(load_model(LinearRegressionModel, path), held.drop("time"))
    return done.select(*V.LINE_KEY, F.round("prediction", 4).alias("prediction"))


@query(
    "request_by_distance",
    """select event_id, round(slope * (price / 10) + intercept, 4) as prediction from event_trips cross join fitted""",
    "event_trips fitted",
)
def request_by_distance(spark, d):
    """Requests, which have no duration, under the fitted model."""
    model, _ = _distance_model(spark, d)
    asked = V.event_trips(spark, d).select("event_id", (F.col("price") / 10).alias("dist"))
    return M.predict(model, X.vectors(asked, "time", ["event_id"])).select("event_id", F.round("prediction", 4).alias("prediction"))


@query(
    "price_by_distance",
    f"""select {LINE_KEY}, round(p.slope * dist + p.intercept, 4) as prediction
        from (select * from trips where {V.HELD_OUT}) t cross join (
          select regr_slope(price, dist) as slope, regr_intercept(price, dist) as intercept from trips
          where not {V.HELD_OUT}) p""",
    "trips",
)
def price_by_distance(spark, d):
    model, held = _distance_model(spark, d, "price")
    return M.predict(model, held).select(*V.LINE_KEY, F.round("prediction", 4).alias("prediction"))


@query(
    "elastic_net_by_distance",
    f"""select round(shrunk * sy / sx, 3) as slope, round(my - shrunk * sy / sx * mx, 3) as intercept from (
          select *, sign(r) * greatest(abs(r) * f - 0.25e0 * 0.8e0 / sy, 0) / (f + 0.25e0 * 0.2e0 / sy) as shrunk from (
            select corr(duration / 60, dist) as r, stddev_samp(duration / 60) as sy, stddev_samp(dist) as sx,
              avg(duration / 60) as my, avg(dist) as mx, (count(*) - 1) / count(*)::double as f
            from trips where not {V.HELD_OUT}) x) y""",
    "trips",
)
def elastic_net_by_distance(spark, d):
    """The elastic net of the travel-time model on one feature, where it has a closed form: a shrunk correlation."""
    model, _ = _distance_model(spark, d, estimator=M.linear(tol=1e-10))
    fitted = spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double")
    return fitted.select(F.round("slope", 3).alias("slope"), F.round("intercept", 3).alias("intercept"))


# ---- trees of a feature with few values: a leaf per value, whose prediction is the mean of its trips


def _by_value(feature, source):
    return f"""select {LINE_KEY}, round(m.mean, 4) as prediction
        from (select * from trips {source} where {V.HELD_OUT}) t join (
          select {feature} as value, avg(duration / 60) as mean from trips {source} where not {V.HELD_OUT}
          group by {feature}) m on m.value = {feature}"""


_NEAR = "left join edges on pickupid = src and dropoffid = dst"
_ROW_OF_ZONE = "join zones on pickupid = zone"


def _fitted_on(spark, d, feature, make):
    """Held-out trips under a model of one feature; `make` gives the estimator and the table it is fitted on."""
    estimator, data = make(_training(spark, d).select(*V.LINE_KEY, "time", feature))
    done = M.predict(M.fit(data.filter(~V.held_out()), estimator), data.filter(V.held_out()))
    return done.select(*V.LINE_KEY, F.round("prediction", 4).alias("prediction"))


@query("boosted_by_near", _by_value("case when src is not null then 1 else 0 end", _NEAR), "trips edges")
def boosted_by_near(spark, d):
    """Boosted trees of one split on `near`: the first tree finds both means, later ones nothing to add."""
    trees = M.boosted_trees(maxIter=5, maxDepth=1, subsamplingRate=1.0)
    return _fitted_on(spark, d, "near", lambda df: (trees, X.vectors(df, "time", V.LINE_KEY)))


@query("forest_by_zone_row", _by_value("h", _ROW_OF_ZONE), "trips zones")
def forest_by_zone_row(spark, d):
    """A forest of one tree without resampling, deep enough to part the rows of the zone grid."""
    forest = M.random_forest(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=5)
    return _fitted_on(spark, d, "h_pu", lambda df: (forest, X.vectors(df, "time", V.LINE_KEY)))


@query("indexed_by_zone_row", _by_value("h", _ROW_OF_ZONE), "trips zones")
def indexed_by_zone_row(spark, d):
    """The same means through the whole pipeline, which makes the rows of the grid categories."""
    trees = M.boosted_trees(maxIter=3, maxDepth=5, subsamplingRate=1.0)
    return _fitted_on(spark, d, "h_pu", lambda df: (M.indexed(["h_pu"], trees, max_categories=8), df))


# ---- models of all features: fitted without the held-out trips, which they then predict


def _split(spark, d):
    data = _training(spark, d)
    return data.filter(~V.held_out()), data.filter(V.held_out())


@query("travel_time_lr")
def travel_time_lr(spark, d):
    train, held = _split(spark, d)
    return _predictions(M.predict(M.fit(train, M.linear()), held))


@query("travel_time_gbt")
def travel_time_gbt(spark, d, iterations=200, depth=5):
    """Boosted trees of 200 iterations, each a pass over the trips."""
    train, held = _split(spark, d)
    return _predictions(M.predict(M.fit(train, M.boosted_trees(maxIter=iterations, maxDepth=depth)), held))


@query("travel_time_rf")
def travel_time_rf(spark, d):
    train, held = _split(spark, d)
    return _predictions(M.predict(M.fit(train, M.random_forest()), held))


@query("travel_time_predict")
def travel_time_predict(spark, d):
    """Fit, save, load and apply to trips without their label."""
    train, held = _split(spark, d)
    path = f"{scratch_root(spark)}/travel-time-{uuid.uuid4().hex}"
    save_model(M.fit(train, M.linear()), path)
    return M.predict(load_model(LinearRegressionModel, path), held.drop("time")).select(*V.LINE_KEY, "prediction")


@query("request_predict")
def request_predict(spark, d):
    model = M.fit(_training(spark, d), M.linear())
    return M.predict(model, _requests(spark, d)).select("event_id", "prediction")


@query("indexed_regression")
def indexed_regression(spark, d, iterations=20, depth=5):
    train, held = (x.drop("features") for x in _split(spark, d))
    pipeline = M.indexed(FEATURES, M.boosted_trees(maxIter=iterations, maxDepth=depth))
    return _predictions(M.predict(M.fit(train, pipeline), held))


@query("travel_time_cv")
def travel_time_cv(spark, d, grid=None):
    """Search over the eight points of `M.FULL_GRID` in three folds unless another grid is given."""
    train, held = _split(spark, d)
    return _predictions(M.predict(M.staged_search(train, M.boosted_trees(), grid or M.FULL_GRID).model, held))


@query("price_lr")
def price_lr(spark, d):
    train, held = _split(spark, d)
    return _predictions(M.predict(M.fit(train, M.linear("price"), "price"), held), "price")
