"""Zone lookups, route statistics and joins."""
from __future__ import annotations

from pyspark.sql import functions as F

from faremeter.operators import joins
from faremeter.operators.aggregates import adhoc_aggregate, pair_stats
from faremeter.plans import views as V
from faremeter.plans.registry import query
from faremeter.sources.scratch import stored

LINE_KEY = ", ".join(V.LINE_KEY)
PAIR = ["pickupid", "dropoffid"]


@query(
    "pair_distance_stats",
    'select pickupid, dropoffid, "max", "min", "avg" from pair_stats',
    "pair_stats",
)
def pair_distance_stats(spark, d):
    return pair_stats(V.trips(spark, d))


@query(
    "adhoc_group_by",
    """select vendor, pickupid, avg(trip_distance) as avg_trip_distance, min(trip_distance) as min_trip_distance,
         max(trip_distance) as max_trip_distance from trips group by vendor, pickupid""",
    "trips",
)
def adhoc_group_by(spark, d):
    return adhoc_aggregate(V.trips(spark, d), ["vendor", "pickupid"], "trip_distance", ["avg", "min", "max"])


@query(
    "near_flag",
    f"""select {LINE_KEY}, pickupid, dropoffid, case when src is not null then 1 else 0 end as near
        from trips left join edges on pickupid = src and dropoffid = dst""",
    "trips edges",
)
def near_flag(spark, d):
    picked = V.trips(spark, d).select(*V.LINE_KEY, *PAIR)
    return joins.near_flag(picked, V.edges(spark, d))


@query(
    "zone_grid",
    f"""select {LINE_KEY}, pickupid, dropoffid, a.h as h_pu, b.h as h_do, a.v as v_pu, b.v as v_do
        from trips left join zones a on pickupid = a.zone left join zones b on dropoffid = b.zone""",
    "trips zones",
)
def zone_grid(spark, d):
    picked = V.trips(spark, d).select(*V.LINE_KEY, *PAIR)
    return joins.with_grid(picked, V.zones(spark, d))


@query("neighbourhood_set", "select zone, near_zone from nearby", "nearby")
def neighbourhood_set(spark, d):
    return V.near(spark, d)


@query(
    "trip_vs_pair_avg",
    f"""select {LINE_KEY}, "avg" as pair_avg, trip_distance - "avg" as vs_pair_avg
        from trips join pair_stats using (pickupid, dropoffid)""",
    "trips pair_stats",
)
def trip_vs_pair_avg(spark, d):
    picked = V.trips(spark, d).select(*V.LINE_KEY, *PAIR, "trip_distance")
    # As a stored table the few statistics have a known size, so the trips are not shuffled by route to meet them.
    stats = stored(pair_stats(picked), "dist")
    compared = joins.vs_pair_stats(picked, stats, PAIR, "trip_distance")
    return compared.select(*V.LINE_KEY, "pair_avg", "vs_pair_avg")


@query(
    "two_table_join",
    "select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey",
)
def two_table_join(spark, d):
    orders, customers = V.table(spark, d, "orders"), V.table(spark, d, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.select("o_orderkey", "c_name", "o_totalprice")
