"""Ranks: leaderboards, top k per group, and positions inside groups of any size."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremeter.operators.select import ordering, top_n
from faremeter.sources.scratch import stored


def ranked_top(
    df: DataFrame, order: Sequence[tuple[str, bool]], n: int, tie_break: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """The first n rows with their rank; the window without partitions sees only those n rows."""
    best = top_n(df, order, n, tie_break)
    return best.withColumn(name, F.row_number().over(Window.orderBy(*ordering(order, tie_break))))


def top_k_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rnk") -> DataFrame:
    """The first k rows of each group. Spark cuts each task's groups to k rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def group_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    """Add the 1-based position of each row in its group; `keys + order` must identify a row.

    A `row_number` window would put a whole group into one task. Here the rows are sorted globally, so a group of any
    size spreads over many range partitions, and stored with their running id. A row's position is then its distance
    from the first row of its group in its partition, plus the group's rows in earlier partitions. Those offsets come
    from one small row per (partition, group).
    """
    row_id = F.monotonically_increasing_id()
    ranged = stored(df.orderBy(*keys, *order).withColumn("_row", row_id), "positions")
    part = F.shiftright("_row", 33).alias("_part")
    slices = ranged.groupBy(*keys, part).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same_key = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    joined = ranged.withColumn("_part", F.shiftright("_row", 33)).alias("r").join(
        offsets.alias("o"), [F.col("r._part") == F.col("o._part"), *same_key]
    )
    position = F.col("r._row") - F.col("o._first") + F.col("o._before") + 1
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], position.alias(name))


def call_batches(
    calls: DataFrame, period: str = "period", order: Sequence[str] = ("pickup", "call_id"), size: int = 50
) -> DataFrame:
    """Consecutive batches of `size` calls inside each period: adds batch_no and call_no, both from 0."""
    placed = group_positions(calls, [period], order, "_pos")
    return placed.select(
        *calls.columns,
        F.floor((F.col("_pos") - 1) / size).cast("long").alias("batch_no"),
        ((F.col("_pos") - 1) % size).cast("int").alias("call_no"),
    )
