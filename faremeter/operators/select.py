"""Projection, point lookup and top-n."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordering(order: Sequence[tuple[str, bool]], tie_break: Sequence[str] = ()) -> list[Column]:
    """Sort columns from (name, descending) pairs, then ascending tie-break columns."""
    cols = [F.col(name).desc() if descending else F.col(name).asc() for name, descending in order]
    return cols + [F.col(name).asc() for name in tie_break]


def project(df: DataFrame, outputs: Mapping[str, Column | str]) -> DataFrame:
    """Select expressions under the given output names."""
    return df.select(*[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in outputs.items()])


def without(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every column except the named ones."""
    return df.drop(*cols)


def top_n(df: DataFrame, order: Sequence[tuple[str, bool]], n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first n rows of an order; each task keeps its own n rows, so nothing is sorted globally."""
    return df.orderBy(*ordering(order, tie_break)).limit(n)


def lookup(df: DataFrame, keys: Mapping[str, object]) -> DataFrame:
    """Rows whose key columns equal the given values."""
    for name, value in keys.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df
