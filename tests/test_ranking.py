from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from faremeter.operators import ranking
from faremeter.operators.ranking import call_batches, group_positions, ranked_top, top_k_per
from faremeter.sources.scratch import stored


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows, one period holding most of them, with many equal timestamps and a NULL period."""
    n = F.col("id")
    period = F.when(n % 3 != 0, 202401).when(n % 50 == 0, F.lit(None)).otherwise(202400 - n % 40).cast("int")
    return spark.range(0, 20000, 1, 6).select(
        n.alias("call_id"), period.alias("period"), F.when(n % 2 == 0, 0).otherwise(n % 11).alias("pickup")
    )


def test_positions_equal_row_number(skewed):
    w = Window.partitionBy("period").orderBy("pickup", "call_id")
    want = skewed.withColumn("pos", F.row_number().over(w).cast("long"))
    got = group_positions(skewed, ["period"], ["pickup", "call_id"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_batches_are_full_and_numbered(skewed):
    got = call_batches(skewed, size=50)
    sizes = got.groupBy("period", "batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("call_no").alias("lo"), F.max("call_no").alias("hi"),
        F.count_distinct("call_no").alias("d"),
    )
    last = Window.partitionBy("period")
    checked = sizes.withColumn("last", F.max("batch_no").over(last))
    assert checked.filter("lo <> 0 or hi <> n - 1 or d <> n or (batch_no < last and n <> 50)").count() == 0


def test_positions_spread_a_hot_group(spark, skewed, monkeypatch):
    """The hot group's rows sit in several files of the stored table, so no task holds the whole group."""
    held = []
    monkeypatch.setattr(ranking, "stored", lambda df, label: held.append(stored(df, label)) or held[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranking.group_positions(skewed, ["period"], ["pickup", "call_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = held[0].filter("period = 202401").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 6000


def test_ranked_top_and_top_k(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9), ("d", 1)], "name string, n int")
    got = ranked_top(df, [("n", True)], 3, ["name"])
    assert [(r["rank"], r.name) for r in got.orderBy("rank").collect()] == [(1, "b"), (2, "c"), (3, "a")]
    per = top_k_per(df.withColumn("g", F.length("name")), ["g"], [F.col("n").desc(), F.col("name")], 2)
    assert sorted(r.name for r in per.collect()) == ["b", "c"]
