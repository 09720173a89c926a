"""Fixed schemas of input tables, for readers that would otherwise infer them."""
from __future__ import annotations

TRIPS = "pickupid int, dropoffid int, trip_distance double"
REQUEST = "dist double, dow int, dom int, dropoffid int, hour int, minute int, month int, pickupid int"
EDGES = "src int, dst int"
ZONES = "zone int, h int, v int"
HOSTS = "host_id bigint, host_name string, total_listings_count bigint"
