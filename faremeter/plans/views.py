"""Trip, lodging and dispatch tables as views over the star schema.

Large tables are joined in the order that shuffles the largest one once: customers are attached to orders first, then
lines to orders. Suppliers and nations are broadcast when Spark's size check finds them small.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeter.operators.joins import neighbourhood
from faremeter.operators.ranking import call_batches

CALLS_PER_BATCH = 50
BATCHES_PER_SHIFT = 10
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]

# The fifth of the trips that models do not see, in arithmetic that any SQL engine shares.
HELD_OUT = "(l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber) % 5 = 0"

# Room for ten digits of batch number below the yyyymm period in one batch id.
_BATCH_SPAN = 10_000_000_000


def held_out() -> Column:
    return F.expr(HELD_OUT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("zone"),
        (F.col("n_regionkey") + 1).alias("h"),
        (F.col("n_nationkey") % 6 + 1).alias("v"),
    )


def edges(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    a = n.select(F.col("n_nationkey").alias("src"), "n_regionkey")
    b = n.select(F.col("n_nationkey").alias("dst"), "n_regionkey")
    return a.join(b, "n_regionkey").filter(F.col("src") != F.col("dst")).select("src", "dst")


def near(spark: SparkSession, d: str) -> DataFrame:
    return neighbourhood(edges(spark, d), zones(spark, d))


def _order_ends(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return table(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def trips(spark: SparkSession, d: str) -> DataFrame:
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, d, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    joined = lines.join(_order_ends(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    crossing = F.abs(F.col("s_nationkey") % 6 - F.col("c_nationkey") % 6)
    return joined.select(
        *LINE_KEY,
        F.col("o_orderdate").alias("pickup"),
        F.col("s_nationkey").alias("pickupid"),
        F.col("c_nationkey").alias("dropoffid"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_quantity") / 10).alias("dist"),
        F.col("l_linenumber").alias("passengers"),
        F.col("l_returnflag").alias("vendor"),
        F.col("l_extendedprice").alias("price"),
        (18.0 * F.col("l_quantity") + 60.0 * crossing + (F.col("l_partkey") * 7) % 240).alias("duration"),
    )


def event_trips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        (F.col("user_id") % 25).cast("int").alias("pickupid"),
        F.col("event_type").alias("vendor"),
        F.col("value").alias("price"),
        (F.col("user_id") % 4 + 1).cast("int").alias("passengers"),
    )


def listings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("listing_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("neighbourhood"),
        F.col("p_type").alias("room_type"),
        F.col("p_size").alias("rooms"),
        F.col("p_retailprice").alias("price"),
    )


def hosts(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer, with 0 orders if there are none; the orders are aggregated before the join, so a hot
    customer is one row."""
    activity = (
        table(spark, d, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").alias("host_since"),
            F.count(F.lit(1)).alias("total_listings_count"),
            F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("response_rate"),
        )
    )
    joined = people(spark, d).join(activity, F.col("host_id") == F.col("o_custkey"), "left")
    return joined.withColumn("total_listings_count", F.coalesce("total_listings_count", F.lit(0))).drop("o_custkey")


def people(spark: SparkSession, d: str) -> DataFrame:
    """The part of hosts that needs no orders."""
    nations = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("location"))
    joined = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("c_custkey").alias("host_id"),
        F.col("c_name").alias("host_name"),
        "location",
        F.when(F.col("c_acctbal") >= 5000, 1).otherwise(0).alias("superhost"),
    )


def reviews_per_order(spark: SparkSession, d: str) -> DataFrame:
    """Reviews counted per order, the grain that joins to the guest without moving every line."""
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("l_linenumber").alias("passengers")
    )


def calendar(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("day"),
        F.col("l_partkey").alias("unit"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("available"),
    )


def placed_calls(spark: SparkSession, d: str) -> DataFrame:
    """All orders as calls with their month, batch in the month and number in the batch."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("call_id"),
        F.col("o_custkey"),
        F.col("o_orderdate").alias("pickup"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("period"),
    )
    return call_batches(o, "period", ("pickup", "call_id"), CALLS_PER_BATCH)


def _call_columns(placed: DataFrame, spark: SparkSession, d: str, *keys) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return placed.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "call_id",
        *keys,
        F.col("c_nationkey").alias("pickupid"),
        ((F.col("call_id") * 7) % 25).cast("int").alias("dropoffid"),
        F.lit(0.0).alias("calltime"),
        (F.col("call_id") % 1800 + 60).cast("double").alias("duration"),
        ((F.col("call_id") % 60) / 10).alias("dist"),
        ((F.col("call_id") * 17) % 3).cast("int").alias("draw"),
    )


def calls(spark: SparkSession, d: str) -> DataFrame:
    """Every order is a call; a batch is 50 consecutive calls of a month."""
    batch = (F.col("period").cast("long") * _BATCH_SPAN + F.col("batch_no")).alias("batch")
    return _call_columns(placed_calls(spark, d), spark, d, batch)


def shift_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls by shift of ten batches; `step` is the batch inside the shift and calltime rises along the shift."""
    shift = (F.col("period").cast("long") * _BATCH_SPAN + F.floor(F.col("batch_no") / BATCHES_PER_SHIFT)).alias("shift")
    step = (F.col("batch_no") % BATCHES_PER_SHIFT).cast("int").alias("step")
    clock = (F.col("batch_no") % BATCHES_PER_SHIFT * 600 + F.col("call_no") * 12).cast("double").alias("clock")
    keyed = _call_columns(placed_calls(spark, d), spark, d, shift, step, clock)
    return keyed.withColumn("calltime", F.col("clock")).drop("clock")


def taxis(spark: SparkSession, d: str) -> DataFrame:
    """State of every taxi: one of five carries a passenger to `desid`; the others are free and have none."""
    s = F.col("s_suppkey")
    busy = s % 5 == 0
    return table(spark, d, "supplier").select(
        s.alias("taxi_id"),
        F.col("s_nationkey").alias("locid"),
        F.when(busy, 0.0).otherwise(((s * 37) % 601).cast("double")).alias("vacatime"),
        F.when(busy, 0).otherwise(1).alias("available"),
        F.when(busy, ((s * 3) % 25).cast("int")).alias("desid"),
        F.when(busy, (s % 900).cast("double")).otherwise(0.0).alias("endtime"),
        ((s * 31) % 3).cast("int").alias("draw"),
    )


def _lines_of(spark: SparkSession, d: str, calls_df: DataFrame, key: str) -> DataFrame:
    # Distinct before the join: partial aggregation shrinks an order with very many lines before any shuffle.
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("call_id"), F.col("l_suppkey").alias("taxi_id")
    ).distinct()
    return lines.join(calls_df.select("call_id", key), "call_id")


def served(spark: SparkSession, d: str, calls_df: DataFrame, key: str = "batch") -> DataFrame:
    """(batch, call_id, taxi_id): the suppliers of each order, each once."""
    return _lines_of(spark, d, calls_df, key).select(key, "call_id", "taxi_id")


def fleet(spark: SparkSession, d: str, calls_df: DataFrame, key: str = "batch") -> DataFrame:
    """Taxis on duty per batch: the suppliers of the batch's orders, in their state."""
    on_duty = _lines_of(spark, d, calls_df, key).select(key, "taxi_id").distinct()
    return on_duty.join(taxis(spark, d), "taxi_id").select(
        key, "taxi_id", "locid", "vacatime", "available", "desid", "endtime", "draw"
    )
