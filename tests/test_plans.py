"""Physical plans: what is pushed down, pruned, limited and partially aggregated."""
from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
Q = entry.queries()
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(autouse=True)
def long_plan_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(spark, name):
    return Q[name](spark, SF_DIR)._jdf.queryExecution().toString()


def test_flagship_pushes_filter_and_columns(spark):
    text = plan(spark, "pair_distance_stats")
    lines = [t for t in text.split("\n") if "FileScan" in t and "l_quantity" in t]
    assert lines and "GreaterThanOrEqual(l_quantity,0.0)" in lines[-1]
    assert "FileScan parquet [l_orderkey" in lines[-1] and lines[-1].split("Batched")[0].count("#") == 3
    assert "partial_avg" in text


@pytest.mark.parametrize("name", ["topn", "order_by_many", "earliest_trips", "top_guests", "top_reviewed_listings"])
def test_top_n_is_not_a_global_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["filter_eq", "filter_lt", "filter_nested", "filter_date_range", "filter_conjunction"])
def test_filters_reach_the_scan(spark, name):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(spark, name))
    assert pushed and pushed[-1].strip()


def test_pair_lookup_filters_before_joining(spark):
    text = plan(spark, "pair_lookup").split("== Physical Plan ==")[1]
    assert "EqualTo(s_nationkey,3)" in text and "EqualTo(c_nationkey,7)" in text


def test_stored_lookups_read_their_files_once(spark):
    df = Q["stored_pair_lookups"](spark, "/root/testdata/sf0.1" if Path("/root/testdata/sf0.1").exists() else SF_DIR)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "lineitem" not in text and "Join" not in text
    assert re.search(r"PartitionFilters: \[[^]]*_bucket#\d+ IN \(\d+,\d+,\d+\)", text)
    scan = df._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numFiles").value() <= 3


def test_zone_tables_are_broadcast_by_size(spark):
    assert plan(spark, "zone_grid").split("== Physical Plan ==")[1].count("BroadcastHashJoin") >= 2
    assert "hint" not in plan(spark, "near_flag").lower()


def test_candidates_cut_groups_before_the_shuffle(spark, monkeypatch):
    """In the table of each class's first taxis, which is stored before the candidates are looked up."""
    from faremeter.operators import dispatch

    plans, keep = {}, dispatch.stored

    def watched(df, label, by=None):
        plans[label] = df._jdf.queryExecution().toString()
        return keep(df, label, by)

    monkeypatch.setattr(dispatch, "stored", watched)
    plan(spark, "candidate_taxis")
    physical = plans["classes"].split("== Physical Plan ==")[1]
    assert physical.rindex("WindowGroupLimit") > physical.rindex("Exchange")


def test_whole_stage_codegen_spans_the_feature_plan(spark):
    df = Q["trip_features"](spark, SF_DIR)
    df.collect()
    assert "*(" in df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_order_is_split_in_the_trip_join(spark, tmp_path):
    """Half of all lines belong to one order; adaptive execution splits that key instead of one task joining it all."""
    from pyspark.sql import functions as F

    from faremeter.plans import views as V

    for name in ("orders", "customer", "supplier"):
        V.table(spark, SF_DIR, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = V.table(spark, SF_DIR, "lineitem")
    hot = F.when(F.col("l_partkey") % 2 == 0, F.lit(11).cast("bigint")).otherwise(F.col("l_orderkey"))
    spread = lines.withColumn("l_orderkey", hot).crossJoin(spark.range(10).drop("id")).repartition(16)
    spread.write.parquet(str(tmp_path / "lineitem.parquet"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = Q["pair_distance_stats"](spark, str(tmp_path))
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text.split("Initial Plan")[0]
