"""Dispatch of all orders, as calls in batches of fifty, to the suppliers on duty for each batch."""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremeter.functions import scalars as S
from faremeter.operators import dispatch as D
from faremeter.operators import pairdraws
from faremeter.operators.aggregates import regression_metrics
from faremeter.plans import views as V
from faremeter.plans.learning import distance_predictions
from faremeter.plans.registry import query
from faremeter.plans.sql_views import PICK
from faremeter.sources.scratch import stored

class Inputs(NamedTuple):
    calls: DataFrame
    fleet: DataFrame
    near: DataFrame


def _inputs(spark, d) -> Inputs:
    """Calls and fleet as stored tables, since every dispatch plan reads them several times."""
    calls = stored(V.calls(spark, d), "calls")
    return Inputs(calls, stored(V.fleet(spark, d, calls), "fleet"), V.near(spark, d))


def _pick():
    """Pick order in arithmetic that any SQL engine shares."""
    return _picked()(F.col("taxi_id"), F.col("call_id"))


def _picked():
    """The same as a function of columns, or of arrays in a task; made here, so that it is shipped whole."""

    def number(taxi, call):
        found = taxi * 7919 + call * 104729
        return np.fmod(found, 1000003) if isinstance(found, np.ndarray) else found % 1000003

    return number


def _assigned(spark, d) -> tuple[Inputs, DataFrame]:
    i = _inputs(spark, d)
    return i, D.assign_best(*i)


def _load(spark, d) -> DataFrame:
    i, assigned = _assigned(spark, d)
    return D.call_load(i.calls, assigned)


def _accepted(spark, d) -> tuple[Inputs, DataFrame]:
    """One taxi per call, picked after reassignment has come to its end."""
    i = _inputs(spark, d)
    return i, D.accept(D.optimise(*i), _pick())


# ---- pairs


@query(
    "call_taxi_pairs",
    """select batch, count(distinct call_id) as n_calls, count(distinct taxi_id) as n_taxis, count(*) as n_pairs
       from tagged group by batch""",
    "tagged",
)
def call_taxi_pairs(spark, d):
    i = _inputs(spark, d)
    calls = i.calls.groupBy("batch").agg(F.count(F.lit(1)).alias("n_calls"))
    taxis = i.fleet.groupBy("batch").agg(F.count(F.lit(1)).alias("n_taxis"))
    return calls.join(taxis, "batch").withColumn("n_pairs", F.col("n_calls") * F.col("n_taxis"))


@query(
    "near_far_tag",
    """select batch, call_id, count(*) filter (where near = 1) as n_near, count(*) filter (where near = 0) as n_far
       from tagged
       group by batch, call_id""",
    "tagged",
)
def near_far_tag(spark, d):
    return D.near_far_counts(*_inputs(spark, d))


@query(
    "scored_pairs",
    """select batch, count(distinct call_id) as n_calls, count(distinct taxi_id) as n_taxis, count(*) as n_pairs,
         cast(sum(near) as bigint) as near_pairs, round(sum(p), 4) as sum_p, round(sum(eta), 2) as sum_eta,
         round(min(eta), 4) as min_eta from pairs group by batch""",
    "pairs",
)
def scored_pairs(spark, d):
    totals = D.pair_totals(*_inputs(spark, d))
    return totals.withColumns(
        {"sum_p": F.round("sum_p", 4), "sum_eta": F.round("sum_eta", 2), "min_eta": F.round("min_eta", 4)}
    )


_SERVED = "from served s join pairs p on s.batch = p.batch and s.call_id = p.call_id and s.taxi_id = p.taxi_id"


def _served_scores(spark, d):
    i = _inputs(spark, d)
    return D.score_served(V.served(spark, d, i.calls), *i)


@query(
    "acceptance_score",
    f"select p.batch, p.call_id, p.taxi_id, near, round(p.p, 6) as p {_SERVED}",
    "served pairs",
)
def acceptance_score(spark, d):
    scored = _served_scores(spark, d)
    return scored.select("batch", "call_id", "taxi_id", "near", F.round("p", 6).alias("p"))


@query(
    "pair_eta",
    f"select p.batch, p.call_id, p.taxi_id, eta {_SERVED}",
    "served pairs",
)
def pair_eta(spark, d):
    return _served_scores(spark, d).select("batch", "call_id", "taxi_id", "eta")


# ---- first assignment


@query(
    "best_call_per_taxi",
    "select batch, taxi_id, call_id, near, round(p, 6) as p, eta from assigned",
    "assigned",
)
def best_call_per_taxi(spark, d):
    _, assigned = _assigned(spark, d)
    return assigned.select("batch", "taxi_id", "call_id", "near", F.round("p", 6).alias("p"), "eta")


@query(
    "best_call_pair_draw",
    f"""select batch, taxi_id, call_id, near, round(2e-1 * sqrt(vacatime) / sqrt(600e0) + pull, 6) as p, eta from (
          select *, row_number() over (partition by batch, taxi_id order by round(pull, 9) desc, call_id) as rn from (
            select batch, call_id, taxi_id, near, vacatime,
              case when available = 1 then calltime else endtime end + duration as eta,
              case when near = 1 then 8e-1 else 5e-1 end * pow((8 + {PICK} % 3) / 10e0,
                exp(-(((dist - 3) / 5e-1) * ((dist - 3) / 5e-1)))) as pull
            from tagged) x) y where rn = 1""",
    "tagged",
)
def best_call_pair_draw(spark, d):
    """The best call of each taxi with a draw for every pair, in arithmetic that does not split into a draw per side."""
    i = _inputs(spark, d)

    def draw(taxi, call):
        return ((taxi * 7919 + call * 104729) % 1000003 % 3).cast("int")

    best = pairdraws.best_calls(*i, draw=draw)
    return best.select("batch", "taxi_id", "call_id", "near", F.round("p", 6).alias("p"), "eta")


@query("drivers_per_call", "select batch, call_id, n_drivers from loads", "loads")
def drivers_per_call(spark, d):
    return _load(spark, d).select("batch", "call_id", "n_drivers")


@query(
    "call_response_prob",
    "select batch, call_id, round(1 - exp(log_miss), 6) as response_prob from loads",
    "loads",
)
def call_response_prob(spark, d):
    return _load(spark, d).select("batch", "call_id", F.round(1 - F.exp("log_miss"), 6).alias("response_prob"))


@query("call_total_time", "select batch, call_id, hours from loads", "loads")
def call_total_time(spark, d):
    return _load(spark, d).select("batch", "call_id", "hours")


_OBJECTIVE = "round(avg(1 - exp(log_miss) + 6 * exp(-hours)), 6) as objective"


@query(
    "fleet_objective",
    f"select batch, count(*) as n_calls, {_OBJECTIVE} from loads group by batch",
    "loads",
)
def fleet_objective(spark, d):
    return D.objective(_load(spark, d)).withColumn("objective", F.round("objective", 6))


@query(
    "initial_dispatch",
    f"""select batch, count(*) as n_calls, cast(sum(n_drivers) as bigint) as n_taxis,
          count(*) filter (where n_drivers > 0) as n_answered, {_OBJECTIVE} from loads group by batch""",
    "loads",
)
def initial_dispatch(spark, d):
    value = S.call_value(F.col("log_miss"), F.col("hours"))
    return _load(spark, d).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.sum("n_drivers").alias("n_taxis"),
        F.count_if(F.col("n_drivers") > 0).alias("n_answered"),
        F.round(F.avg(value), 6).alias("objective"),
    )


@query(
    "matched_calls",
    "select c.batch, c.call_id from calls c where exists (select 1 from assigned a where a.call_id = c.call_id)",
    "calls assigned",
)
def matched_calls(spark, d):
    i, assigned = _assigned(spark, d)
    return i.calls.join(assigned, ["batch", "call_id"], "left_semi").select("batch", "call_id")


@query(
    "unmatched_calls",
    "select c.batch, c.call_id from calls c where not exists (select 1 from assigned a where a.call_id = c.call_id)",
    "calls assigned",
)
def unmatched_calls(spark, d):
    i, assigned = _assigned(spark, d)
    return i.calls.join(assigned, ["batch", "call_id"], "left_anti").select("batch", "call_id")


# ---- reassignment


@query(
    "candidate_taxis",
    "select batch, call_id, taxi_id, cast(rnk as int) as rnk, near, round(value, 6) as value from offered",
    "offered",
)
def candidate_taxis(spark, d):
    i, assigned = _assigned(spark, d)
    held = stored(assigned, "assigned")
    offered = D.candidates(D.call_load(i.calls, held), held, i.near)
    return offered.select("batch", "call_id", "taxi_id", "rnk", "near", F.round("value", 6).alias("value"))


@query(
    "reassign_round",
    "select batch, taxi_id, from_call, to_call, round(delta, 6) as delta from moves",
    "moves",
)
def reassign_round(spark, d):
    i, assigned = _assigned(spark, d)
    held = stored(assigned, "assigned")
    moves = D.improving_moves(D.call_load(i.calls, held), held, i.near)
    return moves.select("batch", "taxi_id", "from_call", "to_call", F.round("delta", 6).alias("delta"))


@query(
    "dispatch_optimised",
    f"select batch, count(*) as n_calls, {_OBJECTIVE} from loads_end group by batch",
    "loads_end",
)
def dispatch_optimised(spark, d):
    i = _inputs(spark, d)
    final = D.optimise(*i)
    return D.objective(D.call_load(i.calls, final)).withColumn("objective", F.round("objective", 6))


@query(
    "moves_left",
    """select batch, count(*) as n_calls, 0 as improving_moves from calls group by batch""",
    "calls",
)
def moves_left(spark, d):
    """Improving moves that stand after reassignment has ended: none in any batch."""
    i = _inputs(spark, d)
    final = stored(D.optimise(*i), "final")
    left = D.improving_moves(D.call_load(i.calls, final), final, i.near).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    sizes = i.calls.groupBy("batch").agg(F.count(F.lit(1)).alias("n_calls"))
    return sizes.join(left, "batch", "left").select("batch", "n_calls", F.coalesce("n", F.lit(0)).cast("int").alias("improving_moves"))


# ---- acceptance, service level, fleet state


@query("accepted_taxi", "select batch, call_id, taxi_id, round(p, 6) as p from accepted", "accepted")
def accepted_taxi(spark, d):
    _, accepted = _accepted(spark, d)
    return accepted.select("batch", "call_id", "taxi_id", F.round("p", 6).alias("p"))


@query(
    "assigned_wait",
    """select a.batch, a.call_id, a.taxi_id,
         (case when f.available = 1 then c.calltime else f.endtime end + c.duration) / 60 as wait_minutes
       from accepted a join calls c on c.batch = a.batch and c.call_id = a.call_id
         join fleet f on f.batch = a.batch and f.taxi_id = a.taxi_id""",
    "accepted calls fleet",
)
def assigned_wait(spark, d):
    i, accepted = _accepted(spark, d)
    scored = D.score_served(accepted.select("batch", "call_id", "taxi_id"), *i)
    return scored.select("batch", "call_id", "taxi_id", (F.col("eta") / 60).alias("wait_minutes"))


@query(
    "failure_rate",
    "select count(*) as n_batches, round(avg(failure_rate), 6) as failure_rate from service",
    "service",
)
def failure_rate(spark, d):
    i, accepted = _accepted(spark, d)
    return D.service_metrics(i.calls, accepted).agg(
        F.count(F.lit(1)).alias("n_batches"), F.round(F.avg("failure_rate"), 6).alias("failure_rate")
    )


@query(
    "mean_wait",
    "select batch, n_calls, mean_wait from service",
    "service",
)
def mean_wait(spark, d):
    i, accepted = _accepted(spark, d)
    return D.service_metrics(i.calls, accepted).select("batch", "n_calls", "mean_wait")


_NOW = 1200.0


@query(
    "fleet_rollforward",
    f"""select batch, taxi_id, case when done then coalesce(to_zone, locid) else locid end as locid,
          case when done then {_NOW} - ends when won then 0e0 else vacatime end as vacatime,
          case when done then 1 when won then 0 else available end as available,
          case when done then null else to_zone end as desid, ends as endtime
        from (select *, ends < {_NOW} and busy as done from (
          select f.batch, f.taxi_id, f.locid, f.vacatime, f.available, c.call_id is not null as won,
            case when c.call_id is not null then c.calltime + c.duration else f.endtime end as ends,
            case when c.call_id is not null then c.dropoffid else f.desid end as to_zone,
            c.call_id is not null or f.available = 0 as busy
          from fleet f left join accepted a on a.batch = f.batch and a.taxi_id = f.taxi_id
            left join calls c on c.call_id = a.call_id) x) y""",
    "fleet accepted calls",
)
def fleet_rollforward(spark, d):
    i, accepted = _accepted(spark, d)
    facts = i.calls.select("batch", "call_id", "calltime", "duration", "dropoffid")
    winners = accepted.join(facts, ["batch", "call_id"])
    return D.roll_forward(i.fleet, winners, F.lit(_NOW)).drop("draw")


@query(
    "fleet_ratio_sweep",
    """select ratio / 10e0 as ratio, count(*) as n_batches, round(avg(failure), 6) as failure_rate,
         round(avg(wait), 6) as mean_wait
       from (
         select c.ratio, c.batch, avg(case when w.eta is null then 1e0 else 0e0 end) as failure,
           coalesce(sum(w.eta), 0e0) / count(*) / 60 as wait
         from sweep_calls c left join sweep_accepted w on w.batch = c.batch and w.call_id = c.call_id
         group by c.ratio, c.batch) z
       group by ratio""",
    "sweep_calls sweep_accepted",
)
def fleet_ratio_sweep(spark, d):
    swept = D.ratio_sweep(*_inputs(spark, d), key=_picked())
    return swept.select(
        "ratio",
        "n_batches",
        F.round("failure_rate", 6).alias("failure_rate"),
        F.round("mean_wait", 6).alias("mean_wait"),
    )


@query("shift_simulation")
def shift_simulation(spark, d):
    """Ten successive batches with the fleet carried on; too many rounds to write out as SQL, so it is tested by loops."""
    calls = stored(V.shift_calls(spark, d), "shift-calls")
    fleet = stored(V.fleet(spark, d, calls, "shift"), "shift-taxis")
    run = D.run_shifts(calls, fleet, V.near(spark, d), V.BATCHES_PER_SHIFT, key=_picked())
    return run.withColumns(
        {"failure_rate": F.round("failure_rate", 6), "mean_wait": F.round("mean_wait", 6)}
    )


@query(
    "kpi_row",
    """select round(m.mse, 4) as mse, round(m.r2, 6) as r2, round(1 - s.failure_rate, 6) as response_rate,
         round(s.mean_wait, 6) as mean_wait
       from (select avg((time - prediction) * (time - prediction)) as mse,
               1 - avg((time - prediction) * (time - prediction)) / var_pop(time) as r2 from predicted) m
         cross join (select avg(failure_rate) as failure_rate, avg(mean_wait) as mean_wait from service) s""",
    "predicted service",
)
def kpi_row(spark, d):
    model = regression_metrics(distance_predictions(spark, d), "time", "prediction")
    i, accepted = _accepted(spark, d)
    service = D.service_metrics(i.calls, accepted).agg(
        F.avg("failure_rate").alias("failure_rate"), F.avg("mean_wait").alias("mean_wait")
    )
    # Two one-row tables, put side by side by an aggregation over their union.
    rows = model.select("mse", "r2").unionByName(service, allowMissingColumns=True)
    return rows.agg(
        F.round(F.max("mse"), 4).alias("mse"),
        F.round(F.max("r2"), 6).alias("r2"),
        F.round(1 - F.max("failure_rate"), 6).alias("response_rate"),
        F.round(F.max("mean_wait"), 6).alias("mean_wait"),
    )
