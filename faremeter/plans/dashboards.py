"""Leaderboards, histograms and calendar series of the trip and lodging pages."""
from __future__ import annotations

from pyspark.sql import functions as F

from faremeter.operators.aggregates import bucket_counts, by_calendar, histogram_of_counts, known_or
from faremeter.operators.ranking import ranked_top
from faremeter.operators.select import top_n
from faremeter.plans import views as V
from faremeter.plans.registry import query


def _count():
    return F.count(F.lit(1))


# Prices are added up in whole cents as decimals, which are exact at any size, so that a result does not depend on the
# order in which tasks finish.
def _cents():
    return F.sum(F.rint(F.col("price") * 100).cast("decimal(18,0)")).cast("double")


def _mean_price():
    return _cents() / F.count("price") / 100


def _total_price():
    return _cents() / 100


_CENTS = "cast(sum(cast(round(price * 100) as decimal(18, 0))) as double)"


# ---- lodging


@query(
    "calendar_by_month",
    f"""select strftime(day, '%Y-%m') as month, count(distinct case when available = 1 then unit end) as units,
         {_CENTS} / count(price) / 100 as avg_price from calendar group by 1""",
    "calendar",
)
def calendar_by_month(spark, d):
    free_unit = F.when(F.col("available") == 1, F.col("unit"))
    aggs = {"units": F.count_distinct(free_unit), "avg_price": _mean_price()}
    return by_calendar(V.calendar(spark, d), "day", "month", aggs)


@query(
    "price_by_dow",
    f"select cast(isodow(day) as int) as dow, {_CENTS} / count(price) / 100 as avg_price from calendar group by 1",
    "calendar",
)
def price_by_dow(spark, d):
    return by_calendar(V.calendar(spark, d), "day", "dow", {"avg_price": _mean_price()})


@query(
    "rooms_histogram",
    """select case when rooms <= 4 then cast(rooms as varchar) else 'Others' end as rooms, count(*) as listings
       from listings group by 1""",
    "listings",
)
def rooms_histogram(spark, d):
    return bucket_counts(V.listings(spark, d), known_or("rooms", [1, 2, 3, 4], "Others"), "rooms", "listings")


@query("room_type_counts", "select room_type, count(*) as listings from listings group by room_type", "listings")
def room_type_counts(spark, d):
    return bucket_counts(V.listings(spark, d), F.col("room_type"), "room_type", "listings")


@query(
    "neighbourhood_stats",
    f"""select neighbourhood, count(*) as units, {_CENTS} / count(price) / 100 as avg_price from listings
       group by neighbourhood""",
    "listings",
)
def neighbourhood_stats(spark, d):
    return V.listings(spark, d).groupBy("neighbourhood").agg(
        _count().alias("units"), _mean_price().alias("avg_price")
    )


@query(
    "top_reviewed_listings",
    "select listing_id, count(*) as cnt from reviews group by listing_id order by cnt desc, listing_id limit 10",
    "reviews",
)
def top_reviewed_listings(spark, d):
    # The guest is not needed, so orders are not joined.
    reviews = V.table(spark, d, "lineitem").withColumnRenamed("l_partkey", "listing_id")
    return top_n(reviews.groupBy("listing_id").agg(_count().alias("cnt")), [("cnt", True)], 10, ["listing_id"])


@query(
    "top_guests",
    "select guest_id, count(*) as reviews from reviews group by guest_id order by reviews desc, guest_id limit 10",
    "reviews",
)
def top_guests(spark, d):
    orders = V.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("guest_id"))
    per_order = V.reviews_per_order(spark, d).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return top_n(per_order.groupBy("guest_id").agg(F.sum("reviews").alias("reviews")), [("reviews", True)], 10,
                 ["guest_id"])


@query(
    "hosts_by_year",
    """select cast(year(host_since) as int) as year, count(*) as hosts,
         count(*) filter (where superhost = 1) as superhosts
       from hosts group by 1""",
    "hosts",
)
def hosts_by_year(spark, d):
    aggs = {"hosts": _count(), "superhosts": F.count_if(F.col("superhost") == 1)}
    return by_calendar(V.hosts(spark, d), "host_since", "year", aggs)


@query("superhost_split", "select superhost, count(*) as hosts from hosts group by superhost", "hosts")
def superhost_split(spark, d):
    return bucket_counts(V.people(spark, d), F.col("superhost"), "superhost", "hosts")


@query(
    "listings_per_host_hist",
    """select size, count(*) as n from (select o_custkey, count(*) as size from orders group by o_custkey) x
       group by size""",
)
def listings_per_host_hist(spark, d):
    return histogram_of_counts(V.table(spark, d, "orders"), "o_custkey")


@query(
    "hosts_by_location",
    "select location, count(*) as hosts from hosts group by location",
    "hosts",
)
def hosts_by_location(spark, d):
    return bucket_counts(V.people(spark, d), F.col("location"), "location", "hosts")


_TOP_HOSTS = """select cast(row_number() over (order by total_listings_count desc, host_id) as int) as rank, host_id,
    host_name, location, response_rate, total_listings_count from hosts"""


def _top_hosts(spark, d, n):
    ranked = ranked_top(V.hosts(spark, d), [("total_listings_count", True)], n, ["host_id"])
    return ranked.select(
        "rank", "host_id", "host_name", "location", "response_rate",
        "total_listings_count",
    )


@query("ranked_top_hosts", f"select * from ({_TOP_HOSTS}) x where rank <= 10", "hosts")
def ranked_top_hosts(spark, d):
    return _top_hosts(spark, d, 10)


@query(
    "top3_flag",
    f"""select rank, host_id, case when rank <= 3 then 1 else 0 end as top3
        from ({_TOP_HOSTS}) x where rank <= 10""",
    "hosts",
)
def top3_flag(spark, d):
    top3 = F.when(F.col("rank") <= 3, 1).otherwise(0).alias("top3")
    return _top_hosts(spark, d, 10).select("rank", "host_id", top3)


@query(
    "top_expensive_listings",
    """select cast(row_number() over (order by price desc, listing_id) as int) as rank, listing_id, neighbourhood,
         room_type, price
       from listings order by price desc, listing_id limit 10""",
    "listings",
)
def top_expensive_listings(spark, d):
    ranked = ranked_top(V.listings(spark, d), [("price", True)], 10, ["listing_id"])
    return ranked.select("rank", "listing_id", "neighbourhood", "room_type", "price")


@query(
    "listing_cards",
    """select l.listing_id, name, neighbourhood as location, score
       from listings l join (select l_partkey, avg(l_quantity) as score from lineitem group by l_partkey) s
         on l.listing_id = s.l_partkey
       order by score desc, l.listing_id limit 12""",
    "listings",
)
def listing_cards(spark, d):
    scores = V.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.avg("l_quantity").alias("score"))
    cards = V.listings(spark, d).join(scores, F.col("listing_id") == F.col("l_partkey"))
    shown = cards.select("listing_id", "name", F.col("neighbourhood").alias("location"), "score")
    return top_n(shown, [("score", True)], 12, ["listing_id"])


# ---- trips


@query(
    "trips_by_vendor",
    """select case when vendor in ('A', 'N') then vendor else 'Unknown' end as vendor, count(*) as trips
       from trips group by 1""",
    "trips",
)
def trips_by_vendor(spark, d):
    return bucket_counts(
        V.table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "vendor"),
        known_or("vendor", ["A", "N"], "Unknown"), "vendor", "trips",
    )


def _trips_and_passengers(spark, d, grain):
    orders = V.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("pickup"))
    per_order = V.reviews_per_order(spark, d).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return by_calendar(
        per_order, "pickup", grain, {"trips": F.sum("reviews"), "passengers": F.sum("passengers")}
    )


@query(
    "trips_by_month",
    """select strftime(pickup, '%Y-%m') as month, count(*) as trips, cast(sum(passengers) as bigint) as passengers
       from trips group by 1""",
    "trips",
)
def trips_by_month(spark, d):
    return _trips_and_passengers(spark, d, "month")


@query(
    "trips_by_dow",
    """select cast(isodow(pickup) as int) as dow, count(*) as trips, cast(sum(passengers) as bigint) as passengers
       from trips group by 1""",
    "trips",
)
def trips_by_dow(spark, d):
    return _trips_and_passengers(spark, d, "dow")


@query(
    "trips_by_3h",
    f"""select cast(hour(ts) // 3 as int) as bucket, count(*) as trips,
          cast(sum(passengers) as bigint) as passengers, {_CENTS} / 100 as volume from event_trips group by 1""",
    "event_trips",
)
def trips_by_3h(spark, d):
    aggs = {"trips": _count(), "passengers": F.sum("passengers"), "volume": _total_price()}
    return by_calendar(V.event_trips(spark, d), "ts", "3h", aggs, "bucket")


@query(
    "room_type_volume",
    f"select room_type, {_CENTS} / 100 as volume from listings group by room_type",
    "listings",
)
def room_type_volume(spark, d):
    return V.listings(spark, d).groupBy("room_type").agg(_total_price().alias("volume"))


@query(
    "popular_zones",
    "select pickupid, count(*) as trips from trips group by pickupid order by trips desc, pickupid limit 5",
    "trips",
)
def popular_zones(spark, d):
    # The lines are counted per supplier before the join, so the join moves one row per supplier.
    per_supplier = V.table(spark, d, "lineitem").groupBy("l_suppkey").agg(_count().alias("n"))
    suppliers = V.table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("pickupid"))
    joined = per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return top_n(joined.groupBy("pickupid").agg(F.sum("n").alias("trips")), [("trips", True)], 5, ["pickupid"])


@query(
    "popular_hours",
    """select cast(hour(ts) as int) as hour, count(*) as trips from event_trips group by 1
       order by trips desc, hour limit 5""",
    "event_trips",
)
def popular_hours(spark, d):
    counted = by_calendar(V.event_trips(spark, d), "ts", "hour", {"trips": _count()})
    return top_n(counted, [("trips", True)], 5, ["hour"])
