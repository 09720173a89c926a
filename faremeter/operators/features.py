"""Feature building for the travel-time and price models."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremeter.functions.scalars import minutes
from faremeter.operators.joins import near_flag, with_grid

#: Zone ids: numbers that are names.
KEYS = ("pickupid", "dropoffid")
#: Columns that `trip_features` makes its label of.
_LABEL_PARTS = ("duration",)


def trip_features(trips: DataFrame, edges: DataFrame, zones: DataFrame, label: str | None = "time") -> DataFrame:
    """Trips with near, the grid cells of both ends and, given a label name, `duration` in minutes under that name.

    Pass ``label=None`` for requests, which have no duration yet.
    """
    built = with_grid(near_flag(trips, edges), zones)
    return built.withColumn(label, minutes(F.col("duration"))) if label else built


def feature_columns(df: DataFrame, label: str | None, exclude: Sequence[str] = KEYS) -> list[str]:
    """The numeric columns that can be features: all but the label, what the label is made of, and `exclude`."""
    gone = {label, *_LABEL_PARTS, *exclude}
    return [f.name for f in df.schema.fields if f.name not in gone and isinstance(f.dataType, T.NumericType)]


def vectors(
    df: DataFrame, label: str | None, exclude: Sequence[str] = KEYS, output: str = "features", invalid: str = "error"
) -> DataFrame:
    """Assemble all numeric columns but the label and the excluded ones into one vector column.

    The label never becomes a feature; a table of requests, which has none, names the label of its model or None. A NULL
    feature, such as the cell of an unknown zone, is an error unless ``invalid`` says "skip" or "keep".
    """
    columns = feature_columns(df, label, exclude)
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=invalid).transform(df)
