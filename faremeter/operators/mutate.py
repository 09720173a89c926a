"""Table rewrites for insert, update, delete and a sorted layout.

Plain file tables have no row-level change, so each function returns the new content as a DataFrame and the
caller writes it to a new place (`faremeter.sources.tables.replace`).
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremeter.operators.select import ordering


def insert_rows(df: DataFrame, rows: DataFrame | Sequence[Mapping[str, object]]) -> DataFrame:
    """Append rows given by column name; columns not named become NULL and types stay those of the table."""
    if not isinstance(rows, DataFrame):
        names = [f.name for f in df.schema.fields if any(f.name in row for row in rows)]
        unknown = {key for row in rows for key in row} - set(names)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        schema = T.StructType([T.StructField(n, df.schema[n].dataType, True) for n in names])
        rows = df.sparkSession.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)
    return df.unionByName(rows, allowMissingColumns=True).select(*df.columns)


def _typed(df: DataFrame, name: str, value) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast(df.schema[name].dataType)


def update_where(df: DataFrame, values: Mapping[str, object], pred: Column | None = None) -> DataFrame:
    """Set columns on the rows where `pred` is true (all rows without one); an unknown condition changes nothing."""
    hit = F.lit(True) if pred is None else F.coalesce(pred, F.lit(False))
    return df.withColumns({c: F.when(hit, _typed(df, c, v)).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, pred: Column | None = None) -> DataFrame:
    """Drop the rows where `pred` is true (all rows without one); rows with an unknown condition stay."""
    if pred is None:
        return df.filter(F.lit(False))
    return df.filter(~F.coalesce(pred, F.lit(False)))


def clustered(df: DataFrame, order: Sequence[tuple[str, bool]], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort rows so that Parquet min/max statistics can skip files and row groups.

    Rows with equal leading keys may share a range, so add a near-unique column to `order` when one key is hot.
    """
    cols = ordering(order)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)
