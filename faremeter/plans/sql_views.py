"""The logical views as SQL, used only to state expected results; the queries build theirs with DataFrames."""
from __future__ import annotations

from faremeter.plans.views import HELD_OUT
from faremeter.plans.views import LINE_KEY as LINE_KEYS

# Score part of a call and a taxi that depends on the call, and the order in which a call picks among its taxis.
PULL = """case when near = 1 then 8e-1 else 5e-1 end * pow((8 + (taxi_id * 31 + call_id * 17) % 3) / 10e0,
  exp(-(((dist - 3) / 5e-1) * ((dist - 3) / 5e-1))))"""
LINE_KEY = ", ".join(LINE_KEYS)
PICK = "(taxi_id * 7919 + call_id * 104729) % 1000003"

VIEWS: dict[str, tuple[str, str]] = {
    "zones": ("", "select n_nationkey as zone, n_regionkey + 1 as h, n_nationkey % 6 + 1 as v from nation"),
    "edges": (
        "",
        """select a.n_nationkey as src, b.n_nationkey as dst from nation a join nation b
           on a.n_regionkey = b.n_regionkey and a.n_nationkey <> b.n_nationkey""",
    ),
    "nearby": (
        "zones edges",
        "select src as zone, dst as near_zone from edges union select zone, zone as near_zone from zones",
    ),
    "trips": (
        "",
        """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate as pickup,
             s_nationkey as pickupid, c_nationkey as dropoffid, l_quantity as trip_distance,
             l_quantity / 10e0 as dist, l_linenumber as passengers, l_returnflag as vendor, l_extendedprice as price,
             18e0 * l_quantity + 60e0 * abs(s_nationkey % 6 - c_nationkey % 6) + (l_partkey * 7) % 240 as duration
           from lineitem join orders on l_orderkey = o_orderkey
             join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey""",
    ),
    "event_trips": (
        "",
        """select event_id, ts, cast(user_id % 25 as int) as pickupid, event_type as vendor, value as price,
             cast(user_id % 4 + 1 as int) as passengers from events""",
    ),
    "listings": (
        "",
        """select p_partkey as listing_id, p_name as name, p_brand as neighbourhood, p_type as room_type,
             p_size as rooms, p_retailprice as price from part""",
    ),
    "reviews": (
        "",
        """select l_orderkey, l_linenumber, l_shipdate, l_partkey as listing_id, o_custkey as guest_id
           from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "hosts": (
        "",
        """select c_custkey as host_id, c_name as host_name, n_name as location,
             case when c_acctbal >= 5000 then 1 else 0 end as superhost, min(o_orderdate) as host_since,
             count(o_orderkey) as total_listings_count,
             avg(case when o_orderstatus = 'F' then 1e0 when o_orderkey is not null then 0e0 end) as response_rate
           from customer join nation on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey
           group by c_custkey, c_name, n_name, c_acctbal""",
    ),
    "calendar": (
        "",
        """select l_shipdate as day, l_partkey as unit, l_extendedprice as price,
             case when l_linestatus = 'O' then 1 else 0 end as available from lineitem""",
    ),
    "pair_stats": (
        "trips",
        """select pickupid, dropoffid, max(trip_distance) as "max", min(trip_distance) as "min",
             avg(trip_distance) as "avg" from trips where trip_distance >= 0 group by pickupid, dropoffid""",
    ),
    "fitted": (
        "trips",
        f"""select regr_slope(duration / 60, dist) as slope, regr_intercept(duration / 60, dist) as intercept
            from trips where not {HELD_OUT}""",
    ),
    "predicted": (
        "trips fitted",
        f"""select {LINE_KEY}, duration / 60 as time, slope * dist + intercept as prediction
            from trips cross join fitted where {HELD_OUT}""",
    ),
    "placed": (
        "",
        """select o_orderkey as call_id, o_custkey, year(o_orderdate) * 100 + month(o_orderdate) as period,
             row_number() over (partition by year(o_orderdate), month(o_orderdate)
                                order by o_orderdate, o_orderkey) - 1 as pos from orders""",
    ),
    "calls": (
        "placed",
        """select call_id, cast(period * 10000000000 + pos // 50 as bigint) as batch, c_nationkey as pickupid,
             cast((call_id * 7) % 25 as int) as dropoffid, 0e0 as calltime,
             cast(call_id % 1800 + 60 as double) as duration, (call_id % 60) / 10e0 as dist
           from placed join customer on o_custkey = c_custkey""",
    ),
    "taxis": (
        "",
        """select s_suppkey as taxi_id, s_nationkey as locid,
             case when s_suppkey % 5 = 0 then 0e0 else cast((s_suppkey * 37) % 601 as double) end as vacatime,
             case when s_suppkey % 5 = 0 then 0 else 1 end as available,
             case when s_suppkey % 5 = 0 then cast((s_suppkey * 3) % 25 as int) end as desid,
             case when s_suppkey % 5 = 0 then cast(s_suppkey % 900 as double) else 0e0 end as endtime from supplier""",
    ),
    "served": (
        "calls",
        """select distinct batch, call_id, l_suppkey as taxi_id from lineitem join calls on l_orderkey = call_id""",
    ),
    "fleet": (
        "served taxis",
        "select s.batch, t.* from (select distinct batch, taxi_id from served) s join taxis t on s.taxi_id = t.taxi_id",
    ),
    "tagged": (
        "calls fleet nearby",
        """select c.batch, c.call_id, c.pickupid, c.calltime, c.duration, c.dist, t.taxi_id, t.vacatime, t.available,
             t.endtime, case when a.zone is not null or b.zone is not null then 1 else 0 end as near
           from calls c join fleet t on c.batch = t.batch
             left join nearby a on a.zone = c.pickupid and a.near_zone = t.locid
             left join nearby b on b.zone = c.pickupid and b.near_zone = t.desid""",
    ),
    "pairs": (
        "tagged",
        f"""select *, 2e-1 * sqrt(vacatime) / sqrt(600e0) + pull as p from (
             select batch, call_id, taxi_id, near, vacatime, available, endtime,
               case when available = 1 then calltime else endtime end + duration as eta, {PULL} as pull
             from tagged) x""",
    ),
    "assigned": (
        "pairs",
        """select batch, taxi_id, call_id, near, p, eta from (
             select *, row_number() over (partition by batch, taxi_id order by round(pull, 9) desc, call_id) as rn
             from pairs) x where rn = 1""",
    ),
    "service": (
        "calls accepted",
        """select c.batch, count(*) as n_calls, avg(case when a.eta is null then 1e0 else 0e0 end) as failure_rate,
             coalesce(sum(a.eta), 0e0) / count(*) / 60 as mean_wait
           from calls c left join accepted a on c.batch = a.batch and c.call_id = a.call_id group by c.batch""",
    ),
}


# Rounds after which no batch of the test tables still moves; `moves_left` shows that none does.
ROUNDS = 24


def _add_rounds(calls: str, pairs: str, assigned: str, prefix: str, rounds: int) -> str:
    """Views of reassignment over a first assignment; returns the name of the last assignment.

    Of each round: loads, offered, scored, moves, and the assignment after it.
    """
    for i in range(rounds):
        suffix = prefix + (str(i) if i else "")
        loads, offered, scored, moves = (f"{v}{suffix}" for v in ("loads", "offered", "scored", "moves"))
        _add_load(loads, calls, assigned)
        VIEWS[offered] = (
            f"{pairs} {loads} {assigned}",
            f"""select * from (
                  select p.batch, p.call_id, p.taxi_id, p.near, p.p, p.eta, l.n_drivers, l.log_miss, l.hours,
                    a.call_id as from_call, a.p as from_p, a.eta as from_eta, round(p.eta / 60 * p.p, 9) as value,
                    row_number() over (partition by p.batch, p.call_id order by round(p.eta / 60 * p.p, 9),
                      case when p.available = 1 then p.vacatime else p.endtime end, p.taxi_id) as rnk
                  from {pairs} p join {loads} l on p.batch = l.batch and p.call_id = l.call_id
                    join {assigned} a on a.batch = p.batch and a.taxi_id = p.taxi_id
                  where l.n_drivers < 3 and a.call_id <> p.call_id) x where rnk <= 3""",
        )
        VIEWS[scored] = (
            f"{offered} {loads}",
            f"""select * from (
                  select o.batch, o.taxi_id, o.from_call, o.call_id as to_call, o.near, o.p, o.eta,
                    (1 - exp(o.log_miss + ln(greatest(1 - o.p, 1e-300))) + 6 * exp(-(o.hours + o.eta / 3600)))
                    - (1 - exp(o.log_miss) + 6 * exp(-o.hours))
                    + (1 - exp(l.log_miss - ln(greatest(1 - o.from_p, 1e-300)))
                       + 6 * exp(-(l.hours - o.from_eta / 3600)))
                    - (1 - exp(l.log_miss) + 6 * exp(-l.hours)) as delta
                  from {offered} o join {loads} l on l.batch = o.batch and l.call_id = o.from_call
                  where l.n_drivers > 1) x where round(delta, 9) > 0""",
        )
        # The moves that are best for both calls they touch.
        VIEWS[moves] = (
            scored,
            f"""select s.* from {scored} s join (
                  select batch, taxi_id, to_call from (
                    select batch, taxi_id, to_call, row_number() over (partition by batch, side
                      order by round(delta, 9) desc, taxi_id, to_call) as rn
                    from (select *, from_call as side from {scored} union all
                          select *, to_call as side from {scored}) u) r
                  where rn = 1 group by batch, taxi_id, to_call having count(*) = 2) k
                on s.batch = k.batch and s.taxi_id = k.taxi_id and s.to_call = k.to_call""",
        )
        after = f"after{prefix}{i + 1}"
        VIEWS[after] = (
            f"{assigned} {moves}",
            f"""select a.batch, a.taxi_id, coalesce(m.to_call, a.call_id) as call_id, coalesce(m.near, a.near) as near,
                  coalesce(m.p, a.p) as p, coalesce(m.eta, a.eta) as eta
                from {assigned} a left join {moves} m on a.batch = m.batch and a.taxi_id = m.taxi_id""",
        )
        assigned = after
    return assigned


def _add_load(name: str, calls: str, assigned: str) -> None:
    VIEWS[name] = (
        f"{calls} {assigned}",
        f"""select c.batch, c.call_id, coalesce(n, 0) as n_drivers, coalesce(lq, 0e0) as log_miss,
              coalesce(h, 0e0) as hours
            from {calls} c left join (
              select batch, call_id, count(*) as n, sum(ln(greatest(1 - p, 1e-300))) as lq, sum(eta) / 3600 as h
              from {assigned} group by batch, call_id) a on c.batch = a.batch and c.call_id = a.call_id""",
    )


def _add_accepted(name: str, assigned: str) -> None:
    VIEWS[name] = (
        assigned,
        f"""select batch, call_id, taxi_id, p, eta from (
             select *, row_number() over (partition by batch, call_id order by {PICK}, taxi_id) as rn
             from {assigned}) x where rn = 1""",
    )


_END = _add_rounds("calls", "pairs", "assigned", "", ROUNDS)
_add_load("loads_end", "calls", _END)
_add_accepted("accepted", _END)

# Every batch at eleven fleet sizes (in tenths), each a dispatch problem of its own.
VIEWS["sweep_calls"] = (
    "calls",
    """select ratio, batch * 11 + ratio - 5 as batch, call_id, pickupid, calltime, duration, dist from calls
       cross join (values (5), (6), (7), (8), (9), (10), (11), (12), (13), (14), (15)) v(ratio)""",
)
VIEWS["sweep_pairs"] = (
    "pairs fleet",
    """select p.batch * 11 + ratio - 5 as batch, call_id, p.taxi_id, near, p.vacatime, p.available, p.endtime, eta, pull, p
       from pairs p join (
           select batch, taxi_id, row_number() over (partition by batch order by taxi_id) as taxi_rank,
             count(*) over (partition by batch) as n_taxis from fleet) k
         on k.batch = p.batch and k.taxi_id = p.taxi_id
         cross join (values (5), (6), (7), (8), (9), (10), (11), (12), (13), (14), (15)) v(ratio)
       where k.taxi_rank <= k.n_taxis * ratio // 15""",
)
VIEWS["sweep_assigned"] = (
    "sweep_pairs",
    """select batch, taxi_id, call_id, near, p, eta from (
         select *, row_number() over (partition by batch, taxi_id order by round(pull, 9) desc, call_id) as rn
         from sweep_pairs) x where rn = 1""",
)
_add_accepted("sweep_accepted", _add_rounds("sweep_calls", "sweep_pairs", "sweep_assigned", "_sweep", ROUNDS))


def with_views(sql: str, names: list[str]) -> str:
    """Prefix `sql` with the views it names and the views those need, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        needs, _ = VIEWS[name]
        for need in needs.split():
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{n} as materialized ({VIEWS[n][1]})" for n in ordered) + "\n" + sql
