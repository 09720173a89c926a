"""Scans, projections, filters, sorts, limits, table rewrites and scalar functions on single tables."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from faremeter.functions import calendar as cal
from faremeter.functions import scalars as S
from faremeter.functions.predicates import all_of, any_of, compare, is_number_ge, like, within
from faremeter.operators import mutate
from faremeter.operators.aggregates import pair_stats
from faremeter.operators.select import lookup, project, top_n, without
from faremeter.plans import views as V
from faremeter.plans.registry import query
from faremeter.sources import tables as io
from faremeter.sources.scratch import scratch_root

LINE_KEY = ", ".join(V.LINE_KEY)
LISTINGS_CSV = "listing_id bigint, name string, neighbourhood string, room_type string, rooms int, price double"


def _new_path(spark, label):
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


# ---- scans and sinks


@query("scan_collection", "select * from orders")
def scan_collection(spark, d):
    return io.read(spark, f"{d}/orders.parquet")


@query("scan_drop_field", "select event_id, ts, user_id, event_type, value from events")
def scan_drop_field(spark, d):
    return without(io.read(spark, f"{d}/events.parquet"), ["props"])


@query("csv_roundtrip", "select * from listings", "listings")
def csv_roundtrip(spark, d):
    path = _new_path(spark, "listings-csv")
    V.listings(spark, d).write.csv(path, header=True)
    return io.read_csv(spark, path, LISTINGS_CSV)


@query(
    "sink_replace",
    'select pickupid, dropoffid, "max", "min", "avg" from pair_stats',
    "pair_stats",
)
def sink_replace(spark, d):
    """The table exists with other content before it is replaced."""
    path = _new_path(spark, "dist")
    io.replace(V.zones(spark, d), path)
    return io.replace(pair_stats(V.trips(spark, d)), path)


# ---- projections


@query("select_star", "select * from part")
def select_star(spark, d):
    return V.table(spark, d, "part").select("*")


@query("select_columns", "select o_orderkey, o_totalprice from orders")
def select_columns(spark, d):
    return V.table(spark, d, "orders").select("o_orderkey", "o_totalprice")


@query("select_alias", "select o_orderkey as id, o_custkey as customer from orders")
def select_alias(spark, d):
    return project(V.table(spark, d, "orders"), {"id": "o_orderkey", "customer": "o_custkey"})


@query(
    "select_except",
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate from lineitem",
)
def select_except(spark, d):
    return without(V.table(spark, d, "lineitem"), ["l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@query(
    "project_then_filter",
    """select o_orderkey as id, o_totalprice as total, o_orderstatus from orders where o_totalprice <= 100000
       order by total desc, id limit 100""",
)
def project_then_filter(spark, d):
    named = project(
        V.table(spark, d, "orders"), {"id": "o_orderkey", "total": "o_totalprice", "o_orderstatus": "o_orderstatus"}
    )
    return top_n(named.filter(compare("total", "<=", 100000)), [("total", True)], 100, ["id"])


@query(
    "pair_lookup",
    """select pickupid, dropoffid, "max", "min", "avg" from pair_stats
       where pickupid = 3 and dropoffid = 7""",
    "pair_stats",
)
def pair_lookup(spark, d):
    return lookup(pair_stats(V.trips(spark, d)), {"pickupid": 3, "dropoffid": 7})


@query(
    "stored_pair_lookups",
    """select pickupid, dropoffid, "max", "min", "avg" from pair_stats
       where (pickupid = 3 and dropoffid = 7) or (pickupid = 3 and dropoffid = 24) or (pickupid = 11 and dropoffid = 0)""",
    "pair_stats",
)
def stored_pair_lookups(spark, d, buckets=64):
    """Three routes in one read of the statistics, which are stored once for all lookups."""
    stats, keys = pair_stats(V.trips(spark, d)), ["pickupid", "dropoffid"]
    kept = io.store_for_lookups(stats, _new_path(spark, "pairs"), keys, buckets)
    routes = [(3, 7), (3, 24), (11, 0)]
    return io.lookup_stored(kept, [dict(zip(keys, route, strict=True)) for route in routes], buckets)


# ---- filters

_ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where "


def _orders(spark, d, *preds):
    kept = V.table(spark, d, "orders").filter(all_of(*preds))
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("filter_eq", _ORDERS + "o_orderstatus = 'F'")
def filter_eq(spark, d):
    return _orders(spark, d, compare("o_orderstatus", "=", "F"))


@query("filter_lt", _ORDERS + "o_totalprice < 50000")
def filter_lt(spark, d):
    return _orders(spark, d, compare("o_totalprice", "<", 50000))


@query("filter_gt", _ORDERS + "o_totalprice > 300000")
def filter_gt(spark, d):
    return _orders(spark, d, compare("o_totalprice", ">", 300000))


@query("filter_le", _ORDERS + "o_totalprice <= 30000")
def filter_le(spark, d):
    return _orders(spark, d, compare("o_totalprice", "<=", 30000))


@query("filter_ge", f"select {LINE_KEY}, l_quantity from lineitem where l_quantity >= 25 and not isnan(l_quantity)")
def filter_ge(spark, d):
    return V.table(spark, d, "lineitem").filter(is_number_ge("l_quantity", 25)).select(*V.LINE_KEY, "l_quantity")


@query("filter_ne_nullsafe", _ORDERS + "o_orderstatus is distinct from 'F'")
def filter_ne_nullsafe(spark, d):
    return _orders(spark, d, compare("o_orderstatus", "!=", "F", null_safe=True))


@query("filter_and", _ORDERS + "o_orderstatus = 'O' and o_totalprice > 200000")
def filter_and(spark, d):
    return _orders(spark, d, compare("o_orderstatus", "=", "O") & compare("o_totalprice", ">", 200000))


@query("filter_or", _ORDERS + "o_orderstatus = 'P' or o_totalprice < 20000")
def filter_or(spark, d):
    return _orders(spark, d, any_of(compare("o_orderstatus", "=", "P"), compare("o_totalprice", "<", 20000)))


@query(
    "filter_nested",
    _ORDERS + "(o_orderstatus = 'F' or (o_totalprice > 400000 and o_orderpriority = '1-URGENT')) and o_totalprice >= 10000",
)
def filter_nested(spark, d):
    large = all_of(compare("o_totalprice", ">", 400000), compare("o_orderpriority", "=", "1-URGENT"))
    return _orders(
        spark, d, any_of(compare("o_orderstatus", "=", "F"), large), compare("o_totalprice", ">=", 10000)
    )


@query(
    "filter_conjunction",
    _ORDERS + "o_orderstatus = 'F' and o_totalprice > 50000 and o_totalprice <= 250000 and o_orderpriority != '5-LOW'",
)
def filter_conjunction(spark, d):
    return _orders(
        spark,
        d,
        compare("o_orderstatus", "=", "F"),
        compare("o_totalprice", ">", 50000),
        compare("o_totalprice", "<=", 250000),
        compare("o_orderpriority", "!=", "5-LOW"),
    )


@query("filter_like", "select p_partkey, p_name from part where p_name like '%ring%'")
def filter_like(spark, d):
    return V.table(spark, d, "part").filter(like("p_name", "%ring%")).select("p_partkey", "p_name")


@query(
    "filter_date_range",
    """select o_orderkey, o_orderdate from orders
       where o_orderdate between timestamp '1997-06-01' and timestamp '1997-12-31'""",
)
def filter_date_range(spark, d):
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in ("1997-06-01 00:00:00", "1997-12-31 00:00:00"))
    kept = V.table(spark, d, "orders").filter(within("o_orderdate", lo, hi))
    return kept.select("o_orderkey", "o_orderdate")


# ---- sorts and limits


@query("order_by_one", "select p_partkey, p_retailprice from part order by p_partkey asc limit 200")
def order_by_one(spark, d):
    return top_n(V.table(spark, d, "part"), [("p_partkey", False)], 200).select("p_partkey", "p_retailprice")


@query(
    "order_by_many",
    """select o_orderkey, o_orderstatus, o_totalprice from orders
       order by o_orderstatus asc, o_totalprice desc, o_orderkey asc limit 200""",
)
def order_by_many(spark, d):
    picked = V.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return top_n(picked, [("o_orderstatus", False), ("o_totalprice", True)], 200, ["o_orderkey"])


@query("limit_n", "select c_custkey, c_name from customer order by c_custkey limit 50")
def limit_n(spark, d):
    return V.table(spark, d, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(50)


@query(
    "topn",
    f"""select {LINE_KEY}, l_extendedprice from lineitem
        order by l_extendedprice desc nulls last, {LINE_KEY} limit 100""",
)
def topn(spark, d):
    picked = V.table(spark, d, "lineitem").select(*V.LINE_KEY, "l_extendedprice")
    return top_n(picked, [("l_extendedprice", True)], 100, V.LINE_KEY)


@query(
    "earliest_trips",
    "select o_orderkey, o_orderdate as pickup from orders order by o_orderdate nulls first, o_orderkey limit 500",
)
def earliest_trips(spark, d):
    named = project(V.table(spark, d, "orders"), {"o_orderkey": "o_orderkey", "pickup": "o_orderdate"})
    return top_n(named, [("pickup", False)], 500, ["o_orderkey"])


@query(
    "call_batches",
    """select call_id, cast(period as int) as period, cast(pos // 50 as bigint) as batch_no,
         cast(pos % 50 as int) as call_no from placed""",
    "placed",
)
def call_batches_query(spark, d):
    return V.placed_calls(spark, d).select("call_id", "period", "batch_no", "call_no")


# ---- table rewrites

_CUSTOMERS = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


@query(
    "insert_rows",
    _CUSTOMERS + " union all select -1, 'Harbour Cafe', null, null, 'TERRACE'",
)
def insert_rows(spark, d):
    row = {"c_custkey": -1, "c_name": "Harbour Cafe", "c_mktsegment": "TERRACE"}
    return mutate.insert_rows(V.table(spark, d, "customer"), [row])


@query(
    "update_where",
    """select c_custkey, case when c_mktsegment = 'MACHINERY' then 'renamed' else c_name end as c_name, c_nationkey,
         case when c_mktsegment = 'MACHINERY' then 0e0 else c_acctbal end as c_acctbal, c_mktsegment from customer""",
)
def update_where(spark, d):
    changed = {"c_name": "renamed", "c_acctbal": 0}
    return mutate.update_where(V.table(spark, d, "customer"), changed, compare("c_mktsegment", "=", "MACHINERY"))


@query("update_all", "select c_custkey, 'everyone' as c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def update_all(spark, d):
    return mutate.update_where(V.table(spark, d, "customer"), {"c_name": "everyone"})


@query("delete_where", _CUSTOMERS + " where c_acctbal >= 0 or c_acctbal is null")
def delete_where(spark, d):
    return mutate.delete_where(V.table(spark, d, "customer"), compare("c_acctbal", "<", 0))


@query(
    "delete_all",
    "select count(*) as rows_before, count(*) filter (where false) as rows_after from customer",
)
def delete_all(spark, d):
    before = V.table(spark, d, "customer")
    marked = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        mutate.delete_where(before).select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return marked.agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"))


@query("clustered_layout", "select * from lineitem")
def clustered_layout(spark, d):
    return mutate.clustered(
        V.table(spark, d, "lineitem"), [("l_shipdate", True), ("l_suppkey", False), ("l_orderkey", False)]
    )


# ---- scalar functions


@query("trip_minutes", f"select {LINE_KEY}, duration / 60 as minutes from trips", "trips")
def trip_minutes(spark, d):
    return V.trips(spark, d).select(*V.LINE_KEY, S.minutes(F.col("duration")).alias("minutes"))


@query(
    "calendar_features",
    """select event_id, cast(isodow(ts) as int) as dow, cast(day(ts) as int) as dom, cast(month(ts) as int) as month,
         cast(hour(ts) as int) as hour, cast(minute(ts) as int) as minute from events""",
)
def calendar_features(spark, d):
    stamped = V.table(spark, d, "events").select("event_id", "ts")
    return cal.calendar_features(stamped, "ts").drop("ts")


@query(
    "time_text_parts",
    """select event_id, cast(substr(strftime(ts, '%H:%M'), 1, 2) as int) as hour,
         cast(substr(strftime(ts, '%H:%M'), 4, 2) as int) as minute from events""",
)
def time_text_parts(spark, d):
    hour, minute = cal.clock_parts(cal.clock_text(F.col("ts")))
    return V.table(spark, d, "events").select("event_id", hour.alias("hour"), minute.alias("minute"))


@query("parse_date", "select o_orderkey, cast(strftime(o_orderdate, '%Y-%m-%d') as date) as day from orders")
def parse_date(spark, d):
    text = cal.date_text(F.col("o_orderdate"))
    return V.table(spark, d, "orders").select("o_orderkey", cal.parse_date(text).alias("day"))


@query("parse_timestamp", "select event_id, date_trunc('second', ts) as at from events")
def parse_timestamp(spark, d):
    text = cal.timestamp_text(F.col("ts"))
    return V.table(spark, d, "events").select("event_id", cal.parse_timestamp(text).alias("at"))


@query(
    "seconds_in_hour",
    "select event_id, cast(minute(ts) * 60 + second(ts) as int) as second_of_hour from events",
)
def seconds_in_hour(spark, d):
    return V.table(spark, d, "events").select("event_id", cal.second_of_hour(F.col("ts")).alias("second_of_hour"))


@query(
    "request_cast",
    "select o_orderkey, cast(o_custkey as bigint) as pickup, o_totalprice as dist from orders",
)
def request_cast(spark, d):
    text = V.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("c"), F.col("o_totalprice").cast("string").alias("p")
    )
    return text.select(
        "o_orderkey", F.col("c").try_cast("bigint").alias("pickup"), F.col("p").try_cast("double").alias("dist")
    )


@query(
    "strip_quotes",
    "select c_custkey, trim('''' || c_name || '''', '''') as name from customer",
)
def strip_quotes(spark, d):
    quoted = F.concat(F.lit("'"), F.col("c_name"), F.lit("'"))
    return V.table(spark, d, "customer").select("c_custkey", S.strip_quotes(quoted).alias("name"))
