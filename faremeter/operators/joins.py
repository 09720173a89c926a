"""Zone lookups and enrichment joins.

No broadcast is forced: the zone tables are broadcast when Spark's own size check
(`spark.sql.autoBroadcastJoinThreshold`, or adaptive execution at run time) finds them small, and joined by
shuffle with skew splitting otherwise.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def near_flag(trips: DataFrame, edges: DataFrame, pickup: str = "pickupid", dropoff: str = "dropoffid") -> DataFrame:
    """Add `near`: 1 when the drop-off zone is listed next to the pickup zone, else 0 (unknown zones too)."""
    known = edges.select(F.col("src").alias(pickup), F.col("dst").alias(dropoff)).distinct()
    tagged = trips.join(known.withColumn("near", F.lit(1)), [pickup, dropoff], "left")
    return tagged.select(*trips.columns, F.coalesce("near", F.lit(0)).alias("near"))


def with_grid(trips: DataFrame, zones: DataFrame, pickup: str = "pickupid", dropoff: str = "dropoffid") -> DataFrame:
    """Add the grid cells h_pu, v_pu, h_do, v_do of both ends; NULL for a zone without a cell."""
    start = zones.select(F.col("zone").alias(pickup), F.col("h").alias("h_pu"), F.col("v").alias("v_pu"))
    stop = zones.select(F.col("zone").alias(dropoff), F.col("h").alias("h_do"), F.col("v").alias("v_do"))
    return (
        trips.join(start, pickup, "left")
        .join(stop, dropoff, "left")
        .select(*trips.columns, "h_pu", "h_do", "v_pu", "v_do")
    )


def neighbourhood(edges: DataFrame, zones: DataFrame) -> DataFrame:
    """(zone, near_zone): every zone with its neighbours and itself, each pair once."""
    listed = edges.select(F.col("src").alias("zone"), F.col("dst").alias("near_zone"))
    itself = zones.select(F.col("zone"), F.col("zone").alias("near_zone"))
    return listed.union(itself).distinct()


def near_far(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """Add `near` to given pairs of call and taxi: 1 when locid or desid is in the neighbourhood of pickupid, else 0.

    Two equality joins, one per column, rather than one join on an OR.
    """
    here = near.select(F.col("zone").alias("pickupid"), F.col("near_zone").alias("locid"), F.lit(1).alias("_here"))
    there = near.select(F.col("zone").alias("pickupid"), F.col("near_zone").alias("desid"), F.lit(1).alias("_there"))
    joined = pairs.join(here, ["pickupid", "locid"], "left").join(there, ["pickupid", "desid"], "left")
    flag = F.when(F.col("_here").isNotNull() | F.col("_there").isNotNull(), 1).otherwise(0)
    return joined.select(*pairs.columns, flag.alias("near"))


def vs_pair_stats(trips: DataFrame, stats: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Trips with the average of their route and the difference from it; `stats` has one row per route."""
    joined = trips.join(stats.select(*keys, F.col("avg").alias("pair_avg")), keys, "inner")
    return joined.withColumn("vs_pair_avg", F.col(measure) - F.col("pair_avg"))
