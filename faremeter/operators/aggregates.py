"""Group-bys. All are hash aggregations with a map-side partial step, so a hot key costs no more than the others."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremeter.functions import calendar
from faremeter.functions.predicates import is_number_ge

_AGGREGATES = {
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
}

_GRAINS = {
    "month": calendar.month_label,
    "dow": calendar.day_of_week,
    "3h": calendar.three_hour_bucket,
    "hour": F.hour,
    "year": F.year,
}


def pair_stats(
    trips: DataFrame,
    keys: Sequence[str] = ("pickupid", "dropoffid"),
    measure: str = "trip_distance",
    as_struct: bool = False,
) -> DataFrame:
    """Maximum, minimum and average of a non-negative measure per route.

    With ``as_struct`` the route is one struct column `_id`, else one column per key.
    """
    stats = (
        trips.filter(is_number_ge(measure, 0))
        .groupBy(*keys)
        .agg(F.max(measure).alias("max"), F.min(measure).alias("min"), F.avg(measure).alias("avg"))
    )
    return stats.select(F.struct(*keys).alias("_id"), "max", "min", "avg") if as_struct else stats


def adhoc_aggregate(df: DataFrame, dims: Sequence[str], measure: str, aggs: Sequence[str]) -> DataFrame:
    """Chosen aggregates of one measure by chosen dimensions; output columns are `<agg>_<measure>`."""
    unknown = [a for a in aggs if a not in _AGGREGATES]
    if unknown:
        raise ValueError(f"unknown aggregates {unknown}, expected some of {sorted(_AGGREGATES)}")
    return df.groupBy(*dims).agg(*[_AGGREGATES[a](measure).alias(f"{a}_{measure}") for a in aggs])


def bucket_counts(df: DataFrame, label: Column, name: str = "bucket", count: str = "n") -> DataFrame:
    """Row count per value of an expression."""
    return df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias(count))


def known_or(col: str, known: Sequence, other: str) -> Column:
    """The column as text, with every value outside `known` (NULL too) merged into one label."""
    return F.when(F.col(col).isin(*known), F.col(col).cast("string")).otherwise(F.lit(other))


def by_calendar(df: DataFrame, ts: str, grain: str, aggs: Mapping[str, Column], name: str | None = None) -> DataFrame:
    """Aggregates by month, dow, 3h, hour or year of a timestamp column."""
    label = _GRAINS[grain](F.col(ts)).alias(name or grain)
    return df.groupBy(label).agg(*[expr.alias(out) for out, expr in aggs.items()])


def histogram_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys have 1, 2, ... rows: (size, n), every size that occurs."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with mse, rmse and r2, from a single pass over the predictions."""
    residual = F.col(label) - F.col(prediction)
    sums = df.filter(residual.isNotNull()).agg(
        F.avg(residual * residual).alias("mse"),
        F.var_pop(label).alias("spread"),
    )
    return sums.select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
    )
