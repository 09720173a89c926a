from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faremeter.sources import catalog, schemas, scratch
from faremeter.sources import tables as io
from faremeter.sources.scratch import scratch_root, stored


def test_replace_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    io.replace(spark.range(5), path)
    assert io.replace(spark.range(3), path).count() == 3
    assert io.read(spark, path).count() == 3


def ids(df):
    return sorted(r.id for r in df.collect())


def test_replace_from_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    before = io.replace(spark.range(10), path)
    assert ids(io.replace(before.filter("id < 4"), path)) == [0, 1, 2, 3]


def test_a_failed_replace_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    io.replace(spark.range(5), path)
    broken = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        io.replace(broken, path)
    assert ids(io.read(spark, path)) == [0, 1, 2, 3, 4]
    assert ids(io.replace(spark.range(2), path)) == [0, 1]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_v-")]) == 2  # this version and the one before


def test_a_replace_ended_before_its_commit_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    io.replace(spark.range(5), path)
    monkeypatch.setattr(io, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        io.replace(spark.range(50), path)
    monkeypatch.undo()
    assert ids(io.read(spark, path)) == [0, 1, 2, 3, 4]


def test_readers_that_have_begun_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)  # a plain table, as another program leaves it
    plain = io.read(spark, path)
    first = io.replace(spark.range(5), path)
    assert ids(plain) == [0, 1, 2]
    io.replace(spark.range(7), path)
    assert ids(first) == [0, 1, 2, 3, 4] and ids(io.read(spark, path)) == list(range(7))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    got = io.replace(df, str(tmp_path / fmt), fmt)
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]


def test_csv_with_header_and_schema(spark, tmp_path):
    path = str(tmp_path / "listings")
    schema = "id bigint, listing_url string, price double"
    spark.createDataFrame([(1, "u, v", 9.5)], schema).write.csv(path, header=True)
    got = io.read_csv(spark, path, schema)
    assert got.schema.simpleString() == "struct<id:bigint,listing_url:string,price:double>"
    assert tuple(got.first()) == (1, "u, v", 9.5)


def test_request_row_is_replaced(spark, tmp_path):
    schema = schemas.REQUEST
    request = dict(dist=2.5, dow=1, dom=30, dropoffid=7, hour=8, minute=45, month=6, pickupid=3)
    path = str(tmp_path / "request")
    io.put_request(spark, request, schema, path)
    got = io.put_request(spark, {**request, "hour": 9}, schema, path)
    assert [r.hour for r in got.collect()] == [9]


def test_table_ddl_and_catalog(spark):
    catalog.create_database(spark, "abc")
    catalog.create_database(spark, "abc")
    catalog.create_table(spark, "abc.garages", "garage_id bigint, place varchar(40), spaces int, opened date")
    catalog.create_table(spark, "abc.ramps", "ramp int")
    assert spark.table("abc.garages").columns == ["garage_id", "place", "spaces", "opened"]
    listed = {tuple(r) for r in catalog.list_catalog(spark).collect()}
    assert {("abc", "garages"), ("abc", "ramps")} <= listed
    with pytest.raises(Exception, match="(?i)not empty|cascade"):
        catalog.drop_databases(spark, ["abc"])
    catalog.drop_tables(spark, ["abc.garages", "abc.ramps", "abc.never_there"])
    assert ("abc", None) in {tuple(r) for r in catalog.list_catalog(spark).collect()}
    catalog.drop_databases(spark, ["abc", "abc2"])
    assert "abc" not in {d.name for d in spark.catalog.listDatabases()}


def test_scratch_uses_the_session_setting(spark):
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/run-")
    assert scratch_root(spark) == scratch_root(spark)


def test_clear_scratch_removes_the_run(spark):
    from pathlib import Path

    folder = scratch_root(spark)
    held = stored(spark.range(3), "gone")
    assert held.count() == 3 and any(Path(folder).iterdir())
    scratch.clear_scratch(spark)
    assert not Path(folder).exists()
    assert scratch_root(spark) != folder


def test_a_dropped_table_is_gone_and_others_stay(spark):
    first, second = stored(spark.range(3), "first"), stored(spark.range(4), "second")
    scratch.drop_stored(first)
    assert second.count() == 4
    with pytest.raises(Exception):
        first.count()


def test_scratch_refuses_machine_local_folders_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())


def test_stored_cuts_lineage_and_keeps_content(spark):
    df = spark.range(100).withColumn("r", F.rand(1))
    held = stored(df, "test")
    assert held.schema["r"].dataType == df.schema["r"].dataType
    assert sorted(held.collect()) == sorted(held.collect())
    assert "FileScan parquet" in held._jdf.queryExecution().toString()


def test_schemas_are_valid(spark):
    for name in [n for n in dir(schemas) if n.isupper()]:
        assert spark.createDataFrame([], getattr(schemas, name)).columns


def test_ranking_pages_from_csv(spark, tmp_path):
    """The host page: a CSV sorted by listing count, with rank and the first three marked."""
    from faremeter.operators.ranking import ranked_top

    path = str(tmp_path / "host.csv")
    with open(path, "w") as f:
        f.write("host_id,host_name,total_listings_count\n")
        f.write("".join(f"{i},h{i},{c}\n" for i, c in enumerate([3, 50, 7, 50, 1])))
    hosts = io.read_csv(spark, path, schemas.HOSTS)
    top = ranked_top(hosts, [("total_listings_count", True)], 4, ["host_name"]).withColumn("top3", F.col("rank") <= 3)
    got = [(r["rank"], r.host_name, r.top3) for r in top.orderBy("rank").collect()]
    assert got == [(1, "h1", True), (2, "h3", True), (3, "h2", True), (4, "h0", False)]


def test_taxi_tables_from_csv_to_features(spark, tmp_path):
    """Adjacency and grid come as tables; a repeated edge and an unknown zone do no harm."""
    from faremeter.operators.aggregates import pair_stats
    from faremeter.operators.features import trip_features

    for name, text in {
        "edges": "src,dst\n1,2\n1,2\n5,6\n",
        "zones": "zone,h,v\n1,20,30\n2,21,31\n5,22,32\n6,23,33\n",
        "trips": "pickupid,dropoffid,trip_distance\n1,2,2.5\n1,2,0.5\n1,2,-1\n90,5,1\n",
    }.items():
        (tmp_path / name).write_text(text)
    edges = io.read_csv(spark, str(tmp_path / "edges"), schemas.EDGES)
    zones = io.read_csv(spark, str(tmp_path / "zones"), schemas.ZONES)
    trips = io.read_csv(spark, str(tmp_path / "trips"), schemas.TRIPS)
    stats = pair_stats(trips, ["pickupid", "dropoffid"])
    assert sorted(map(tuple, stats.collect())) == [(1, 2, 2.5, 0.5, 1.5), (90, 5, 1.0, 1.0, 1.0)]
    rows = trip_features(trips, edges, zones, label=None).orderBy("trip_distance").collect()
    assert [(r.near, r.h_pu, r.v_do) for r in rows] == [(1, 20, 31), (1, 20, 31), (0, None, 32), (1, 20, 31)]
