"""Dispatch of taxis to batches of calls, without a row per call and taxi.

Tables (names are fixed, extra columns are ignored):

* ``calls``: batch, call_id, pickupid, dropoffid, calltime, duration, dist, draw
* ``fleet``: batch, taxi_id, locid, vacatime, available (0/1), desid (NULL: none), endtime, draw
* ``near``: zone, near_zone, from `faremeter.operators.joins.neighbourhood`

A batch is one dispatch problem: its calls and the taxis on duty for it. The score of a call and a taxi is
``idle(taxi) + pull(call, near or far, draw)``. For a given taxi only the second part varies over calls, and it depends
on the taxi through its zone, its destination and its draw alone. So the best call is looked up per zone, counts and
sums come from taxis counted per zone, and candidate lists from the few best taxis of each zone. Work grows with the
calls and the taxis, not with their product, and every shuffle is keyed by batch or finer.

A batch has a bounded number of calls (fifty, as `call_batches` makes them) and any number of taxis. Rows that hold a
list are bounded by the calls of a batch, never by its taxis.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from faremeter.functions import scalars as S
from faremeter.operators import fleets
from faremeter.operators.joins import near_far
from faremeter.operators.ranking import group_positions, top_k_per
from faremeter.operators.rounds import Problem
from faremeter.sources.scratch import drop_stored, stored

# The fleet sizes that the service level is reported for.
FLEET_RATIOS = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4, 1.5)
_FLEET_COLUMNS = ["batch", "taxi_id", "locid", "vacatime", "available", "desid", "endtime", "draw"]
#: Taxis of a class that a batch keeps for its far lists; a list as long as this may be cut.
_HEAD = 128
#: Rounds of reassignment after which batches that have come to rest are left out.
_ROUNDS_PER_JOB = 32


def _prepared(fleet: DataFrame) -> DataFrame:
    """The fleet with zero vacancy for taxis that carry a passenger."""
    idle = S.idle_seconds(F.col("available"), F.col("vacatime"))
    return fleet.select(*[c for c in _FLEET_COLUMNS if c != "vacatime"], idle.alias("vacatime"))


def _draws() -> range:
    return range(S.DRAWS)


def _pull(near: int, taxi_draw: int) -> Column:
    return S.pull_part(F.col("dist"), near, S.draw_weight(F.lit(taxi_draw), F.col("draw")))


# --------------------------------------------------------------------------- pairs


def _with_reach(taxis: DataFrame, near: DataFrame) -> DataFrame:
    """Add `reach`, the zones a taxi is near to: those with its position or its destination in their neighbourhood."""
    served = near.groupBy(F.col("near_zone").alias("_at")).agg(F.collect_set("zone").alias("_zones"))
    here = served.select(F.col("_at").alias("locid"), F.col("_zones").alias("_from_here"))
    there = served.select(F.col("_at").alias("desid"), F.col("_zones").alias("_from_there"))
    nothing = F.array().cast("array<int>")
    zones = F.array_union(F.coalesce("_from_here", nothing), F.coalesce("_from_there", nothing))
    joined = taxis.join(here, "locid", "left").join(there, "desid", "left")
    return joined.select(*taxis.columns, zones.alias("reach"))


def near_counts(fleet: DataFrame, near: DataFrame) -> DataFrame:
    """Taxis near each zone: (batch, zone, near_0, near_1, near_2), one count per taxi draw."""
    reached = _with_reach(fleet.select("batch", "locid", "desid", "draw"), near)
    return reached.select("batch", "draw", F.explode("reach").alias("zone")).groupBy("batch", "zone").agg(
        *[F.count_if(F.col("draw") == d).alias(f"near_{d}") for d in _draws()]
    )


def fleet_totals(fleet: DataFrame) -> DataFrame:
    """Per batch: taxis by draw, free and busy counts, sum of the idle score and the busy taxis' end times."""
    taxis = _prepared(fleet)
    busy_end = F.when(F.col("available") != 1, F.col("endtime"))
    return taxis.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_taxis"),
        F.count_if(F.col("available") == 1).alias("n_free"),
        F.sum(S.idle_part(F.col("vacatime"))).alias("idle_sum"),
        F.max(S.idle_part(F.col("vacatime"))).alias("idle_max"),
        F.coalesce(F.sum(busy_end), F.lit(0.0)).alias("busy_end_sum"),
        F.min(busy_end).alias("busy_end_min"),
        *[F.count_if(F.col("draw") == d).alias(f"taxis_{d}") for d in _draws()],
    )


def near_far_counts(calls: DataFrame, fleet: DataFrame, near: DataFrame) -> DataFrame:
    """Near and far taxis of each call: (batch, call_id, n_near, n_far), for batches that have taxis."""
    found = calls.join(
        near_counts(fleet, near).withColumnRenamed("zone", "pickupid"), ["batch", "pickupid"], "left"
    ).join(fleet.groupBy("batch").agg(F.count(F.lit(1)).alias("n_taxis")), "batch")
    n_near = sum((F.coalesce(F.col(f"near_{d}"), F.lit(0)) for d in _draws()), F.lit(0))
    return found.select("batch", "call_id", n_near.alias("n_near"), (F.col("n_taxis") - n_near).alias("n_far"))


def pair_totals(calls: DataFrame, fleet: DataFrame, near: DataFrame) -> DataFrame:
    """Per batch, over all its pairs of call and taxi: their number, near pairs, sum of p, sum and minimum of eta."""
    found = calls.join(
        near_counts(fleet, near).withColumnRenamed("zone", "pickupid"), ["batch", "pickupid"], "left"
    ).join(fleet_totals(fleet), "batch")
    n_near = [F.coalesce(F.col(f"near_{d}"), F.lit(0)) for d in _draws()]
    pulls = sum(
        (n_near[d] * _pull(1, d) + (F.col(f"taxis_{d}") - n_near[d]) * _pull(0, d) for d in _draws()), F.lit(0.0)
    )
    free_eta = F.col("n_free") * F.col("calltime") + F.col("n_taxis") * F.col("duration") + F.col("busy_end_sum")
    first_free = F.when(F.col("n_free") > 0, F.col("calltime") + F.col("duration"))
    return found.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.max("n_taxis").alias("n_taxis"),
        F.sum("n_taxis").alias("n_pairs"),
        F.sum(sum(n_near, F.lit(0))).alias("near_pairs"),
        F.sum(pulls + F.col("idle_sum")).alias("sum_p"),
        F.sum(free_eta).alias("sum_eta"),
        F.min(F.least(first_free, F.col("busy_end_min") + F.col("duration"))).alias("min_eta"),
    )


def score_served(served: DataFrame, calls: DataFrame, fleet: DataFrame, near: DataFrame) -> DataFrame:
    """Near flag, p and eta of given pairs (batch, call_id, taxi_id)."""
    pairs = served.join(calls.withColumnRenamed("draw", "call_draw"), ["batch", "call_id"]).join(
        _prepared(fleet), ["batch", "taxi_id"]
    )
    weight = S.draw_weight(F.col("draw"), F.col("call_draw"))
    return near_far(pairs, near).select(
        "batch",
        "call_id",
        "taxi_id",
        "near",
        S.acceptance(F.col("vacatime"), F.col("dist"), F.col("near"), weight).alias("p"),
        S.eta(F.col("available"), F.col("calltime"), F.col("endtime"), F.col("duration")).alias("eta"),
    )


# --------------------------------------------------------------------------- first assignment


def _offer(near: int, taxi_draw: int) -> Column:
    """One call as seen by a taxi class; the greatest offer is the best call, the lowest call_id among equals."""
    pull = _pull(near, taxi_draw)
    return F.struct(
        S.billionths(pull).alias("score"),
        (-F.col("call_id")).alias("neg_call_id"),
        F.lit(near).alias("near"),
        pull.alias("pull"),
        "calltime",
        "duration",
        "dropoffid",
    )


def best_offers(calls: DataFrame, near: DataFrame) -> DataFrame:
    """Best call per batch for a far taxi, and per taxi zone for a near one: (batch, far[draw], near{zone: [draw]})."""
    seen = calls.join(near, calls["pickupid"] == near["zone"])
    per_zone = seen.groupBy("batch", "near_zone").agg(
        F.array(*[F.max(_offer(1, d)) for d in _draws()]).alias("offers")
    )
    zone_map = per_zone.groupBy("batch").agg(
        F.map_from_entries(F.collect_list(F.struct("near_zone", "offers"))).alias("near")
    )
    far = calls.groupBy("batch").agg(F.array(*[F.max(_offer(0, d)) for d in _draws()]).alias("far"))
    return far.join(zone_map, "batch", "left")


def _with_best_offer(calls: DataFrame, fleet: DataFrame, near: DataFrame, key: str = "batch") -> DataFrame:
    """The fleet with its extra columns, each taxi's best offer `o`, p and eta.

    Calls are grouped by `key`, which both tables have; several fleets may share the calls of one.
    Far offers include calls that are near the taxi; those are never chosen wrongly, because the same call has a
    strictly larger near offer.
    """
    idle = S.idle_seconds(F.col("available"), F.col("vacatime"))
    offers = best_offers(calls.withColumn("batch", F.col(key)), near)
    taxis = fleet.withColumn("vacatime", idle).join(
        offers.withColumnsRenamed({"batch": key, "near": "_near", "far": "_far"}), key
    )
    at_position = F.try_element_at("_near", F.col("locid"))
    at_destination = F.try_element_at("_near", F.col("desid"))
    offers = [F.get(side, F.col("draw")) for side in (at_position, at_destination, F.col("_far"))]
    return taxis.select(*fleet.columns, F.greatest(*offers).alias("o")).withColumns(
        {
            "call_id": -F.col("o.neg_call_id"),
            "p": S.idle_part(F.col("vacatime")) + F.col("o.pull"),
            "eta": S.eta(F.col("available"), F.col("o.calltime"), F.col("endtime"), F.col("o.duration")),
        }
    )


def assign_best(calls: DataFrame, fleet: DataFrame, near: DataFrame) -> DataFrame:
    """Each taxi with its most likely call: the fleet columns plus call_id, near, p and eta."""
    best = _with_best_offer(calls, fleet.select(*_FLEET_COLUMNS), near)
    return best.select(*_FLEET_COLUMNS, "call_id", F.col("o.near").alias("near"), "p", "eta")


def call_load(calls: DataFrame, assignments: DataFrame) -> DataFrame:
    """Every call with its number of taxis, sum of ln(1-p) and total hours (0 for a call without a taxi)."""
    sums = assignments.groupBy("batch", "call_id").agg(
        F.count(F.lit(1)).alias("n_drivers"),
        F.sum(S.log_refusal(F.col("p"))).alias("log_miss"),
        (F.sum("eta") / S.SECONDS_PER_HOUR).alias("hours"),
    )
    zero = F.lit(0.0)
    return calls.join(sums, ["batch", "call_id"], "left").withColumns(
        {
            "n_drivers": F.coalesce("n_drivers", F.lit(0)),
            "log_miss": F.coalesce("log_miss", zero),
            "hours": F.coalesce("hours", zero),
        }
    )


def objective(load: DataFrame) -> DataFrame:
    """Mean value of a batch's calls: (batch, n_calls, objective).

    A call without a taxi is worth 6 (chance 0, no time), so the measure favours unanswered calls; read it next to
    the failure rate.
    """
    return load.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.avg(S.call_value(F.col("log_miss"), F.col("hours"))).alias("objective"),
    )


# --------------------------------------------------------------------------- reassignment


_CLASS = ["batch", "available", "draw"]


def _cut_classes(classes: DataFrame) -> DataFrame:
    """(batch, available, draw, ends) of the classes that may be cut, each found in the row that holds its batch's taxis."""

    def own(kind: Column) -> Column:
        return F.filter("taxis", lambda t: t["available"].eqNullSafe(kind["available"]) & t["draw"].eqNullSafe(kind["draw"]))

    kinds = F.array_distinct(F.transform("taxis", lambda t: F.struct(t["available"].alias("available"), t["draw"].alias("draw"))))
    ends = lambda kind: F.transform(own(kind), lambda t: F.struct(t["locid"].alias("locid"), t["desid"].alias("desid")))
    full = F.transform(
        F.filter(kinds, lambda k: F.size(own(k)) == _HEAD),
        lambda k: F.struct(k["available"].alias("available"), k["draw"].alias("draw"), ends(k).alias("ends")),
    )
    return classes.filter(F.col("longest") == _HEAD).select("batch", F.inline(full))


def first_taxis(calls: DataFrame, fleet: DataFrame, near: DataFrame, depth: int) -> DataFrame:
    """The taxis of each batch among which every call finds the `depth` with the least eta/60*p: the fleet with `step`.

    Taxis of one state and draw that are all near a zone, or all far from it, differ for its calls in one number only
    (vacancy if free, end time if busy), and the measure rises with it: `step`. So the first `depth` of each such class
    hold the exact answer.

    They are looked for among the first `_HEAD` taxis of each class of the batch. Where a class has more taxis and its
    head too few of them, they are added from all of the class: near ones by the positions and destinations around the
    zone, far ones from the first of each position and destination.
    """
    order = [F.col("step"), F.col("taxi_id")]
    step = F.when(F.col("available") == 1, F.col("vacatime")).otherwise(F.col("endtime"))
    taxis = fleet.withColumn("step", step)
    heads = top_k_per(taxis, _CLASS, order, _HEAD)
    facts = F.struct(*[c for c in heads.columns if c not in ("batch", "rnk")])
    by_batch = heads.groupBy("batch").agg(F.collect_list(facts).alias("taxis"), F.max("rnk").alias("longest"))
    classes = stored(by_batch, "classes")
    heads, cut = classes.select("batch", F.inline("taxis")), stored(_cut_classes(classes), "cut")
    if cut.isEmpty():
        return heads
    around = near.groupBy(F.col("zone").alias("pickupid")).agg(F.collect_set("near_zone").alias("around"))
    asked = calls.select("batch", "pickupid").distinct().join(around, "pickupid", "left")

    def is_near(t: Column | None = None) -> Column:
        ends = [F.col(end) if t is None else t[end] for end in ("locid", "desid")]
        found = [F.coalesce(F.array_contains(F.col("around"), end), F.lit(False)) for end in ends]
        return found[0] | found[1]

    n_near = F.size(F.filter("ends", is_near))
    lacks = F.filter(
        F.array(F.struct(F.lit(1).alias("side"), n_near.alias("n")), F.struct(F.lit(0).alias("side"), (F.size("ends") - n_near).alias("n"))),
        lambda c: c["n"] < depth,
    )
    short = stored(
        asked.filter("pickupid is not null").join(cut, "batch").select("pickupid", "around", *_CLASS, F.explode(lacks).alias("c")).select(
            "pickupid", "around", *_CLASS, "c.side"
        ),
        "short",
    )
    if short.isEmpty():
        return heads
    deep = taxis.join(short.select(*_CLASS).distinct(), _CLASS, "left_semi")
    close = short.filter("side = 1").drop("around").join(
        near.select(F.col("zone").alias("pickupid"), F.col("near_zone").alias("_at")), "pickupid"
    )
    kept = [*_CLASS, "pickupid", "side", *[c for c in taxis.columns if c not in _CLASS]]
    here = [close.join(deep.withColumn("_at", F.col(end)), [*_CLASS, "_at"]).select(*kept) for end in ("locid", "desid")]
    corners = top_k_per(deep, [*_CLASS, "locid", "desid"], order, depth).drop("rnk")
    away = short.filter("side = 0").join(corners, _CLASS).filter(~is_near()).select(*kept)
    # a taxi near by both its ends is there twice, hence twice the depth
    found = top_k_per(reduce(DataFrame.unionByName, [*here, away]), [*_CLASS, "pickupid", "side"], order, 2 * depth)
    more = found.select(*heads.columns).distinct().join(heads.select("batch", "taxi_id"), ["batch", "taxi_id"], "left_anti")
    return heads.unionByName(more.select(*heads.columns).alias("_more"))


_HOLDER = ["call_id", "p", "eta"]
_LOAD = ["n_drivers", "log_miss", "hours"]
#: Calls that a task handles together; all of a batch are.
_CALLS_TOGETHER = 5_000


def _by_problems(load: DataFrame, assignments: DataFrame, near: DataFrame, max_res: int, run, schema: str) -> DataFrame:
    """`run` over problems of some batches each, with the `2 * max_res - 1` first taxis of every call.

    A task gets the calls of some batches and their first taxis, both bounded by the calls. Calls without a zone take no
    part.
    """
    depth = 2 * max_res - 1
    n = 1 + load.select("batch").count() // _CALLS_TOGETHER
    part = F.pmod(F.xxhash64("batch"), F.lit(n)).alias("part")
    around = near.groupBy(F.col("zone").alias("pickupid")).agg(F.collect_set("near_zone").alias("around"))
    pulls = [_pull(flag, d).alias(f"pull_{flag}_{d}") for flag in (0, 1) for d in _draws()]
    calls = load.filter("pickupid is not null").join(around, "pickupid", "left").select(
        part, "batch", "call_id", *_LOAD, "calltime", "duration", *pulls, F.coalesce("around", F.array().cast("array<int>")).alias("around")
    )
    idle = S.idle_part(S.idle_seconds(F.col("available"), F.col("vacatime"))).alias("idle")
    held = [F.col("call_id").alias("held_call"), F.col("p").alias("held_p"), F.col("eta").alias("held_eta")]
    taxis = first_taxis(load, assignments, near, depth).select(
        part, "batch", "taxi_id", "step", idle, "available", "endtime", "draw", "locid", "desid", *held
    )

    # values, not the module of them: an executor has no copy of it
    scale = depth, S.DRAWS, S.SECONDS_PER_HOUR, S.PROMPTNESS_WEIGHT

    def solve(own: pa.Table, their: pa.Table) -> pa.Table:
        return run(Problem(own, their, *scale))

    return calls.groupBy("part").cogroup(taxis.groupBy("part")).applyInArrow(solve, schema)


def candidates(load: DataFrame, assignments: DataFrame, near: DataFrame, max_res: int = 3) -> DataFrame:
    """For each call below `max_res` taxis, the `max_res` other taxis with the least eta/60*p.

    Such a call has up to `max_res-1` taxis of its own, so its first `2*max_res-1` taxis hold the answer.
    """

    def run(x: Problem) -> pa.Table:
        return x.candidates(max_res)

    schema = (
        "batch long, call_id long, n_drivers long, log_miss double, hours double, rnk int, value double, taxi_id long, near int,"
        " p double, eta double, from_call long, from_p double, from_eta double"
    )
    return _by_problems(load, assignments, near, max_res, run, schema)


def improving_moves(load: DataFrame, assignments: DataFrame, near: DataFrame, max_res: int = 3) -> DataFrame:
    """One round of reassignment: (batch, taxi_id, from_call, to_call, delta, near, p, eta).

    Moving a taxi changes the terms of two calls only, so its effect is a closed formula. A call's last taxi is never
    taken. Of the moves that improve the objective, each call keeps its best as source or target, and a move stands
    when both its calls keep it; the standing moves share no call, so their effects add up.
    """
    source = load.select(
        "batch",
        F.col("call_id").alias("from_call"),
        F.col("n_drivers").alias("from_n"),
        F.col("log_miss").alias("from_miss"),
        F.col("hours").alias("from_hours"),
    )
    offered = candidates(load, assignments, near, max_res).join(
        source.filter(F.col("from_n") > 1), ["batch", "from_call"]
    )
    eta_hours, from_eta_hours = F.col("eta") / S.SECONDS_PER_HOUR, F.col("from_eta") / S.SECONDS_PER_HOUR
    gain = _gain(F.col("log_miss"), F.col("hours"), S.log_refusal(F.col("p")), eta_hours)
    loss = _gain(F.col("from_miss"), F.col("from_hours"), -S.log_refusal(F.col("from_p")), -from_eta_hours)
    moves = (
        offered.withColumn("delta", gain + loss)
        .withColumn("delta_key", S.billionths(F.col("delta")))
        .filter(F.col("delta_key") > 0)
        .select("batch", "taxi_id", "from_call", F.col("call_id").alias("to_call"), "delta", "delta_key",
                "near", "p", "eta")
    )
    # A batch has at most max_res moves per call, so these windows are small whatever the fleet.
    sides = moves.withColumn("side", F.explode(F.array("from_call", "to_call")))
    by_call = Window.partitionBy("batch", "side").orderBy(F.col("delta_key").desc(), "taxi_id", "to_call")
    kept = sides.withColumn("_rn", F.row_number().over(by_call)).filter(F.col("_rn") == 1)
    both = kept.withColumn(
        "_sides", F.count(F.lit(1)).over(Window.partitionBy("batch", "taxi_id", "to_call"))
    ).filter((F.col("_sides") == 2) & (F.col("side") == F.col("to_call")))
    return both.select("batch", "taxi_id", "from_call", "to_call", "delta", "near", "p", "eta")


def apply_moves(assignments: DataFrame, moves: DataFrame) -> DataFrame:
    """Assignments after the moves; every taxi keeps exactly one call."""
    change = moves.select(
        "batch", "taxi_id",
        F.col("to_call").alias("_call_id"), F.col("near").alias("_near"),
        F.col("p").alias("_p"), F.col("eta").alias("_eta"),
    )
    joined = assignments.join(change, ["batch", "taxi_id"], "left")
    moved = {c: F.when(F.col("_call_id").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c))
             for c in ("call_id", "near", "p", "eta")}
    return joined.withColumns(moved).select(*assignments.columns)


def reassign_round(calls: DataFrame, assignments: DataFrame, near: DataFrame, max_res: int = 3) -> DataFrame:
    """Assignments after one round. Pass a stored table: the round reads it three times."""
    load = stored(call_load(calls, assignments), "load")
    return apply_moves(assignments, improving_moves(load, assignments, near, max_res))


def optimise(
    calls: DataFrame, fleet: DataFrame, near: DataFrame, max_res: int = 3, rounds: int | None = None
) -> DataFrame:
    """First assignment improved round by round until no move stands, or for at most `rounds` rounds."""
    return improve(calls, stored(assign_best(calls, fleet, near), "assigned"), near, max_res, rounds)


def improve(
    calls: DataFrame, assignments: DataFrame, near: DataFrame, max_res: int = 3, rounds: int | None = None
) -> DataFrame:
    """Rounds of moves on a stored assignment until none stands, or for at most `rounds` rounds.

    Which taxis a call can be offered does not depend on the assignment, so they are ranked once. A round then needs
    only the loads of the calls and who holds the offered taxis, both bounded by the batch's calls. A task takes the
    rounds of some batches together, each batch by itself, and gives the last move of each taxi; the taxis themselves are
    read once more, when the moves are applied.

    Every standing move raises its batch's objective by at least half a billionth, so the rounds end.
    """
    if rounds == 0:
        return assignments

    def run(x: Problem) -> pa.Table:
        x.improve(max_res, rounds, every)
        return x.states()

    every = _ROUNDS_PER_JOB
    schema = "batch long, moves array<struct<taxi_id: long, to_call: long, near: int, p: double, eta: double>>"
    load = stored(call_load(calls, assignments), "load")
    states = stored(_by_problems(load, assignments, near, max_res, run, schema), "states")
    return apply_moves(assignments, states.select("batch", F.inline("moves")))


def _gain(log_miss: Column, hours: Column, miss: Column, more_hours: Column) -> Column:
    """What a call's value changes by when its sums do."""
    return S.call_value(log_miss + miss, hours + more_hours) - S.call_value(log_miss, hours)


# --------------------------------------------------------------------------- acceptance and service level


def pick_key(taxi: Column, call: Column, seed: int = 0) -> Column:
    """Repeatable stand-in for drawing one of a call's taxis at random."""
    return F.xxhash64(taxi, call, F.lit(seed))


def accept(
    assignments: DataFrame, key: Column | None = None, carry: Sequence[str] = (), seed: int = 0
) -> DataFrame:
    """One taxi per call, the one with the least pick key: (batch, call_id, taxi_id, p, eta) and columns to carry."""
    order = pick_key(F.col("taxi_id"), F.col("call_id"), seed) if key is None else key
    first = F.min(F.struct(order.alias("key"), "taxi_id", "p", "eta", *carry)).alias("w")
    return assignments.groupBy("batch", "call_id").agg(first).select(
        "batch", "call_id", "w.taxi_id", "w.p", "w.eta", *[f"w.{c}" for c in carry]
    )


def service_metrics(calls: DataFrame, accepted: DataFrame) -> DataFrame:
    """Per batch: calls, failure rate and mean wait in minutes, the wait over all calls."""
    joined = calls.join(accepted.select("batch", "call_id", "eta"), ["batch", "call_id"], "left")
    return joined.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.avg(F.when(F.col("eta").isNull(), 1.0).otherwise(0.0)).alias("failure_rate"),
        (F.coalesce(F.sum("eta"), F.lit(0.0)) / F.count(F.lit(1)) / 60).alias("mean_wait"),
    )


def _fleet_size(ratio: Column, largest: float) -> Column:
    """Taxis on duty at a ratio when all `n_taxis` are on duty at the largest; rounding hides float noise only."""
    return F.floor(F.round(F.col("n_taxis") * ratio / F.lit(float(largest)), 6))


#: A call's choice of its taxi: a column, or a function of taxi and call ids that takes columns and arrays alike.
PickKey = Column | Callable | None
#: Taxis of a shift that one task may hold, and the taxis and calls that it handles together.
_FLEET_TOGETHER = 50_000
_TAXIS_TOGETHER = 100_000
_CALLS_CARRIED = 2_500
_MOST_PARTITIONS = 2_000


def _column_key(key: PickKey) -> Column | None:
    return key(F.col("taxi_id"), F.col("call_id")) if callable(key) else key


def _per_run(
    calls: DataFrame, fleet: DataFrame, near: DataFrame, steps: int, ratios: Sequence[float], key: PickKey, max_res: int,
    rounds: int | None, by_jobs: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """(shift, at, step, n, failure, wait) of every shift and fleet size; `at` is the place of its ratio.

    A task takes the calls and taxis of some shifts and carries all their fleets through all steps (`operators/fleets.py`):
    the fleets of a shift differ in few taxis, so neither they nor what they hold is stored or shuffled. `by_jobs` does the
    shifts that a task does not take, step by step over tables: those with too many taxis, with repeated ids or with
    values missing, and all if the key is a column.
    """
    if not callable(key):
        return by_jobs(calls, fleet)
    sizes = fleet.groupBy("shift").agg(F.count(F.lit(1)).alias("n_taxis"))
    n_taxis, largest = sizes.agg(F.sum("n_taxis"), F.max("n_taxis")).first()
    n = 1 + max(calls.count() // _CALLS_CARRIED, (n_taxis or 0) // _TAXIS_TOGETHER)
    part = F.pmod(F.xxhash64("shift"), F.lit(n)).alias("part")
    large = sizes.filter((F.col("n_taxis") > _FLEET_TOGETHER) | F.col("shift").isNull()).select("shift")
    some_large = (largest or 0) > _FLEET_TOGETHER
    small = lambda df: df.join(large, "shift", "left_anti") if some_large else df
    around = near.groupBy(F.col("zone").alias("pickupid")).agg(F.collect_set("near_zone").alias("around"))
    pulls = [_pull(flag, d).alias(f"pull_{flag}_{d}") for flag in (0, 1) for d in _draws()]
    asked = small(calls.filter("shift is not null")).join(around, "pickupid", "left").select(
        part, "shift", "step", "call_id", "pickupid", "dropoffid", "calltime", "duration", *pulls,
        F.coalesce("around", F.array().cast("array<int>")).alias("around"),
    )
    taxis = small(fleet.filter("shift is not null")).select(part, "shift", *[c for c in _FLEET_COLUMNS if c != "batch"])
    settings = fleets.Settings(
        [float(r) / float(max(ratios)) for r in ratios], steps, key, max_res, rounds, _ROUNDS_PER_JOB, S.DRAWS, S.SECONDS_PER_HOUR,
        S.PROMPTNESS_WEIGHT, S.IDLE_SHARE, float(S.IDLE_FULL_SECONDS),
    )
    simulate = fleets.simulate

    def run(own: pa.Table, their: pa.Table) -> pa.Table:
        return simulate(own, their, settings)

    # dealt out by number, so that few rows do not end up in few tasks
    dealt = [df.repartition(min(n, _MOST_PARTITIONS), "part").groupBy("part") for df in (asked, taxis)]
    found = stored(dealt[0].cogroup(dealt[1]).applyInArrow(run, fleets.SCHEMA), "runs")
    done, left = found.filter("at >= 0"), found.filter("at < 0").select("shift")
    others = [left, large] if some_large else [left]
    if calls.filter("shift is null").isEmpty() and all(x.isEmpty() for x in others):
        return done
    # a null shift has calls and no fleet
    gone = reduce(DataFrame.unionByName, others).distinct()
    rest = [df.join(gone, df["shift"].eqNullSafe(gone["shift"]), "left_semi") for df in (calls, fleet)]
    return done.unionByName(by_jobs(rest[0].unionByName(calls.filter("shift is null")), rest[1]))


def ratio_sweep(
    calls: DataFrame,
    fleet: DataFrame,
    near: DataFrame,
    ratios: Sequence[float] = FLEET_RATIOS,
    key: PickKey = None,
    max_res: int = 3,
    rounds: int | None = None,
) -> DataFrame:
    """Failure rate and mean wait by fleet size: (ratio, n_batches, failure_rate, mean_wait).

    The whole fleet of a batch stands for the largest ratio; a smaller one keeps the first taxis by taxi_id. Every batch
    and ratio is a dispatch problem of its own; all are assigned and improved in the same jobs. A batch without taxis
    answers no call. With a function as key a task works out all fleets of some batches (`_per_run`).
    """
    renamed = [df.withColumnRenamed("batch", "shift") for df in (calls, fleet)]
    per_run = _per_run(
        renamed[0].withColumn("step", F.lit(0)), renamed[1], near, 1, ratios, key, max_res, rounds,
        lambda own, their: _swept(own, their, near, ratios, _column_key(key), max_res, rounds),
    )
    per_batch = per_run.filter("shift is not null")
    return _at_ratios(per_batch, ratios).groupBy("ratio").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.avg("failure").alias("failure_rate"),
        F.avg("wait").alias("mean_wait"),
    )


def _at_ratios(per_run: DataFrame, ratios: Sequence[float]) -> DataFrame:
    return per_run.withColumn("ratio", F.get(F.array(*[F.lit(float(r)) for r in ratios]), F.col("at")))


def _scenarios(ratios: Sequence[float]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("at"), F.lit(float(r)).alias("ratio")) for i, r in enumerate(ratios)])


def _swept(
    calls: DataFrame, fleet: DataFrame, near: DataFrame, ratios: Sequence[float], key: Column | None, max_res: int, rounds: int | None
) -> DataFrame:
    """`_per_run` of a sweep over tables that hold every batch and ratio."""
    calls, fleet = (df.withColumnRenamed("shift", "batch") for df in (calls.drop("step"), fleet))
    n = len(ratios)
    sizes = fleet.groupBy("batch").agg(F.count(F.lit(1)).alias("n_taxis"))
    placed = group_positions(fleet.select(*_FLEET_COLUMNS), ["batch"], ["taxi_id"], "taxi_rank").join(sizes, "batch")
    scenarios = _scenarios(ratios)
    fits = F.filter(scenarios, lambda r: F.col("taxi_rank") <= _fleet_size(r["ratio"], max(ratios)))
    problem = (F.col("batch") * n + F.col("_s.at")).alias("batch")
    # a taxi's best call is the same in every fleet it belongs to
    best = stored(_with_best_offer(calls, placed, near).withColumn("near", F.col("o.near")).drop("o"), "sweep-best")
    others = [c for c in best.columns if c not in ("batch", "taxi_rank", "n_taxis")]
    assigned = stored(best.withColumn("_s", F.explode(fits)).select(problem, *others), "sweep-assigned")
    facts = [c for c in calls.columns if c != "batch"]
    spread = calls.withColumn("_s", F.explode(scenarios)).select(
        problem, F.col("batch").alias("shift"), F.col("_s.at").alias("at"), *facts
    )
    asked = stored(spread, "sweep-calls")
    accepted = accept(improve(asked.drop("shift", "at"), assigned, near, max_res, rounds), key)
    of_batch = asked.select("batch", "shift", "at").distinct()
    return service_metrics(asked, accepted).join(of_batch, "batch").select(
        "shift", "at", F.lit(0).alias("step"), F.col("n_calls").alias("n"), F.col("failure_rate").alias("failure"), F.col("mean_wait").alias("wait")
    )


# --------------------------------------------------------------------------- fleet state over time


def roll_forward(fleet: DataFrame, winners: DataFrame, now: Column) -> DataFrame:
    """Fleet state after a batch.

    `winners` has batch, taxi_id, calltime, duration, dropoffid for the taxis that took a call: they become busy until
    the trip ends. A busy taxi whose trip ended before `now` becomes free at its destination, vacant since then.
    """
    trips = winners.select(
        "batch", "taxi_id",
        (F.col("calltime") + F.col("duration")).alias("_end"), F.col("dropoffid").alias("_to"),
    )
    joined = fleet.join(trips, ["batch", "taxi_id"], "left")
    won = F.col("_end").isNotNull()
    busy = joined.withColumns(
        {
            "available": F.when(won, 0).otherwise(F.col("available")),
            "vacatime": F.when(won, 0.0).otherwise(F.col("vacatime")),
            "endtime": F.when(won, F.col("_end")).otherwise(F.col("endtime")),
            "desid": F.when(won, F.col("_to")).otherwise(F.col("desid")),
        }
    )
    done = (F.col("endtime") < now) & (F.col("available") == 0)
    return busy.withColumns(
        {
            "vacatime": F.when(done, now - F.col("endtime")).otherwise(F.col("vacatime")),
            "available": F.when(done, 1).otherwise(F.col("available")),
            "locid": F.when(done, F.coalesce("desid", "locid")).otherwise(F.col("locid")),
            "desid": F.when(done, F.lit(None).cast("int")).otherwise(F.col("desid")),
        }
    ).select(*fleet.columns)


def run_shifts(
    calls: DataFrame,
    fleet: DataFrame,
    near: DataFrame,
    steps: int,
    ratios: Sequence[float] = FLEET_RATIOS,
    max_res: int = 3,
    rounds: int | None = None,
    key: PickKey = None,
) -> DataFrame:
    """Carry the fleet through `steps` successive batches: (ratio, step, n_calls, failure_rate, mean_wait).

    Each step improves its assignment until no move stands; `rounds` bounds that, and 0 leaves the first assignment.

    `calls` has shift (bigint) and step (from 0) instead of batch, `fleet` has shift. Every shift and ratio is a run of
    its own. With a function as key a task carries all fleets of some shifts through all steps (`_per_run`). Rates are
    means over the runs of a ratio.
    """
    per_run = _per_run(
        calls, fleet, near, steps, ratios, key, max_res, rounds,
        lambda own, their: _run_by_steps(own, their, near, steps, ratios, max_res, rounds, _column_key(key)),
    )
    return _at_ratios(per_run, ratios).groupBy("ratio", "step").agg(
        F.sum("n").alias("n_calls"), F.avg("failure").alias("failure_rate"), F.avg("wait").alias("mean_wait")
    )


def _run_by_steps(
    calls: DataFrame, fleet: DataFrame, near: DataFrame, steps: int, ratios: Sequence[float], max_res: int, rounds: int | None,
    key: Column | None,
) -> DataFrame:
    """`_per_run` step by step over tables that hold every shift and ratio.

    The calls are stored by step, so a step reads its own only; the runs of a shift share one table of best offers. A step
    leaves the accepted calls and the new fleet state as stored tables.
    """
    n = len(ratios)
    sizes = fleet.groupBy("shift").agg(F.count(F.lit(1)).alias("n_taxis"))
    facts = ["shift", *[c for c in _FLEET_COLUMNS if c != "batch"]]
    ranked = group_positions(fleet.select(*facts), ["shift"], ["taxi_id"], "taxi_rank").join(sizes, "shift")
    scenarios = _scenarios(ratios)
    fits = F.filter(scenarios, lambda r: F.col("taxi_rank") <= _fleet_size(r["ratio"], max(ratios)))
    run = (F.col("shift") * n + F.col("_s.at")).alias("batch")
    state = stored(ranked.withColumn("_s", F.explode(fits)).select(run, *facts), "shift-fleet")
    asked = stored(calls, "shift-calls", by="step")
    trip = ["calltime", "duration", "dropoffid"]
    accepted = []
    for step in range(steps):
        shared = asked.filter(F.col("step") == step).drop("step")
        current = shared.withColumn("_s", F.explode(scenarios)).select(run, *[c for c in shared.columns if c != "shift"])
        best, passed = _with_best_offer(shared, state, near, "shift"), [state]
        if rounds != 0:
            first = best.select(*_FLEET_COLUMNS, "call_id", F.col("o.near").alias("near"), "p", "eta")
            passed.append(stored(first, "assigned"))
            moved = improve(current, passed[-1], near, max_res, rounds)
            assigned = moved.join(current.select("batch", "call_id", *trip), ["batch", "call_id"])
        else:
            assigned = best.withColumns({c: F.col(f"o.{c}") for c in trip})
        won = stored(accept(assigned, key, trip), "accepted")
        accepted.append(won)
        if step < steps - 1:
            clock = shared.groupBy("shift").agg(F.max("calltime").alias("_now"))
            timed = state.join(clock, "shift", "left")
            state = stored(roll_forward(timed, won, F.col("_now")).drop("_now"), "shift-fleet")
        for old in passed:
            drop_stored(old)  # the accepted calls and the new state are all that later steps read
    answers = reduce(DataFrame.unionByName, [won.select("batch", "call_id", "eta") for won in accepted])
    return (
        asked.withColumn("_s", F.explode(scenarios))
        .select(run, "shift", F.col("_s.at").alias("at"), "step", "call_id")
        .join(answers, ["batch", "call_id"], "left")
        .groupBy("batch", "shift", "at", "step")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.when(F.col("eta").isNull(), 1.0).otherwise(0.0)).alias("failure"),
            (F.coalesce(F.sum("eta"), F.lit(0.0)) / F.count(F.lit(1)) / 60).alias("wait"),
        )
        .drop("batch")
    )
