"""The best call of each taxi when every pair of taxi and call has a draw of its own.

With a draw per pair the score no longer splits into a taxi's part and a call's part, so no lookup by class gives the
best call. What stays known per call is a bound: its score at the largest draw. Each taxi goes through the calls in
falling order of that bound, a block at a time, and stops at the first block whose bound is below the best score it has
found (a threshold algorithm). A third of the draws are the largest, so few blocks are read.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremeter.functions import scalars as S
from faremeter.sources.scratch import stored

_FACTS = ["call_id", "calltime", "duration"]
_EVERYWHERE = -1


def _weight(draw: Column) -> Column:
    return (F.lit(S.LOWEST_DRAW_TENTHS) + draw) / F.lit(10.0)


def seeded_draw(seed: int = 0) -> Callable[[Column, Column], Column]:
    """A repeatable draw from 0, 1, 2 for each pair of taxi and call."""
    return lambda taxi, call: F.pmod(F.xxhash64(taxi, call, F.lit(seed)), F.lit(S.DRAWS)).cast("int")


def _blocks(calls: DataFrame, near: DataFrame, size: int) -> DataFrame:
    """The calls of a batch near each position of a taxi, and all of them as far ones, in blocks by falling bound.

    (batch, near, at, block, calls, next_bound, next_call): the last two are of the block after it.
    """
    around = near.select(F.col("zone").alias("pickupid"), F.col("near_zone").alias("at"))
    lists = [
        calls.join(around, "pickupid").select("batch", F.lit(1).alias("near"), "at", *_FACTS, "dist"),
        calls.select("batch", F.lit(0).alias("near"), F.lit(_EVERYWHERE).alias("at"), *_FACTS, "dist"),
    ]
    # a call's score at each draw, worked out here once and not for every taxi that looks at it
    pulls = F.array(*[S.pull_part(F.col("dist"), F.col("near"), _weight(F.lit(d))) for d in range(S.DRAWS)])
    listed = lists[0].unionByName(lists[1]).withColumn("pulls", pulls)
    listed = listed.withColumn("bound", S.billionths(F.get("pulls", F.lit(S.DRAWS - 1))))
    # a list holds calls of one batch, which are few
    by_bound = Window.partitionBy("batch", "near", "at").orderBy(F.col("bound").desc(), "call_id")
    placed = listed.withColumn("place", F.row_number().over(by_bound) - 1)
    blocks = placed.withColumn("block", F.floor(F.col("place") / size).cast("int")).groupBy("batch", "near", "at", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "bound", *_FACTS, "pulls"))).alias("calls")
    )
    following = F.lead(F.get("calls", F.lit(0))).over(Window.partitionBy("batch", "near", "at").orderBy("block"))
    return blocks.withColumn("_next", following).select(
        "batch", "near", "at", "block", "calls", F.col("_next.bound").alias("next_bound"), F.col("_next.call_id").alias("next_call")
    )


def _probed(cursors: DataFrame, blocks: DataFrame, draw: Callable[[Column, Column], Column]) -> DataFrame:
    """(batch, taxi_id, best): the best call of each cursor (batch, taxi_id, near, at); a cursor without calls is left out."""

    def scored(c: Column) -> Column:
        pull = F.get(c["pulls"], draw(F.col("taxi_id"), c["call_id"]))
        return F.struct(
            S.billionths(pull).alias("score"), (-c["call_id"]).alias("neg_call_id"), F.col("near").alias("near"),
            pull.alias("pull"), c["calltime"].alias("calltime"), c["duration"].alias("duration"),
        )

    shape = "struct<score:double,neg_call_id:bigint,near:int,pull:double,calltime:double,duration:double>"
    open_ = cursors.withColumns({"block": F.lit(0), "best": F.lit(None).cast(shape)})
    done = []
    while True:
        best = F.greatest("best", F.array_max(F.transform("calls", scored)))
        # a later call can still win with a higher score, or with an equal one and a lower number
        equal = (F.col("next_bound") == F.col("best.score")) & (F.col("next_call") < -F.col("best.neg_call_id"))
        more = F.coalesce((F.col("next_bound") > F.col("best.score")) | equal, F.lit(False))
        step = open_.join(blocks, ["batch", "near", "at", "block"]).withColumn("best", best)
        kept = stored(step.select("batch", "taxi_id", "near", "at", "block", "best", more.alias("more")), "probed")
        done.append(kept.filter("not more").select("batch", "taxi_id", "best"))
        open_ = kept.filter("more").select("batch", "taxi_id", "near", "at", (F.col("block") + 1).alias("block"), "best")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)


def best_calls(
    calls: DataFrame, fleet: DataFrame, near: DataFrame, draw: Callable[[Column, Column], Column] | None = None, block: int = 8
) -> DataFrame:
    """(batch, taxi_id, call_id, near, p, eta): each taxi's most likely call, the lowest number among equals.

    `draw` gives 0, 1 or 2 for a taxi and a call; without it, a seeded hash of both. Tables are those of
    `faremeter.operators.dispatch`; their own draws are not used. Near calls come first; a taxi looks at the far ones only
    if one of them could still beat its best near call.
    """
    draw = draw or seeded_draw()
    blocks = stored(_blocks(calls, near, block), "blocks")
    taxi = fleet.select("batch", "taxi_id", F.explode(F.array_distinct(F.array("locid", "desid"))).alias("at"))
    here = _probed(taxi.filter("at is not null").withColumn("near", F.lit(1)), blocks, draw)
    near_best = stored(here.groupBy("batch", "taxi_id").agg(F.max("best").alias("best")), "near-best")
    far_bound = blocks.filter("near = 0 and block = 0").select("batch", F.get("calls", F.lit(0))["bound"].alias("bound"))
    rest = fleet.select("batch", "taxi_id").join(far_bound, "batch").join(near_best, ["batch", "taxi_id"], "left")
    rest = rest.filter(F.col("best").isNull() | (F.col("bound") >= F.col("best.score")))
    cursors = rest.select("batch", "taxi_id", F.lit(0).alias("near"), F.lit(_EVERYWHERE).alias("at"))
    both = near_best.unionByName(_probed(cursors, blocks, draw))
    best = both.groupBy("batch", "taxi_id").agg(F.max("best").alias("o"))
    idle = S.idle_seconds(F.col("available"), F.col("vacatime"))
    return fleet.join(best, ["batch", "taxi_id"]).select(
        "batch", "taxi_id", (-F.col("o.neg_call_id")).alias("call_id"), F.col("o.near").alias("near"),
        (S.idle_part(idle) + F.col("o.pull")).alias("p"),
        S.eta(F.col("available"), F.col("o.calltime"), F.col("endtime"), F.col("o.duration")).alias("eta"),
    )
