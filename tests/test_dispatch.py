from __future__ import annotations

import random
import subprocess
import sys

import brute
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from faremeter.operators import dispatch as D
from faremeter.operators import pairdraws
from faremeter.plans import dispatching
from faremeter.plans import views as V

CALLS = (
    "batch bigint, call_id bigint, pickupid int, dropoffid int, calltime double, duration double, dist double, draw int"
)
FLEET = (
    "batch bigint, taxi_id bigint, locid int, vacatime double, available int, desid int, endtime double, draw int"
)
ZONES = 12


def _around():
    rng = random.Random(5)
    return {z: {z, *rng.sample(range(ZONES), 2)} for z in range(ZONES)}


def _make(batches=6, seed=3):
    rng = random.Random(seed)
    calls, fleet = [], []
    for b in range(batches):
        for i in range(rng.randint(1, 15)):
            calls.append(dict(
                batch=b, call_id=b * 100 + i, pickupid=rng.randrange(ZONES + 1), dropoffid=rng.randrange(ZONES),
                calltime=float(rng.choice([0, 30, 90])), duration=float(rng.choice([0, 300, 900, 2000])),
                dist=rng.choice([0.5, 2.5, 2.9, 3.0, 3.3, 7.0]), draw=rng.randrange(3),
            ))
        for i in range(rng.choice([0, 3, 40, 80]) if b else 60):
            busy = rng.random() < 0.3
            fleet.append(dict(
                batch=b, taxi_id=b * 1000 + i, locid=rng.randrange(ZONES), vacatime=float(rng.choice([0, 60, 250, 600])),
                available=0 if busy else 1, desid=rng.randrange(ZONES) if busy else None,
                endtime=float(rng.choice([100, 500, 900])) if busy else 0.0, draw=rng.randrange(3),
            ))
    return calls, fleet


@pytest.fixture(scope="module")
def world(spark):
    calls, fleet = _make()
    around = {**_around(), ZONES: {ZONES}}
    near = spark.createDataFrame([(z, n) for z, s in around.items() for n in s], "zone int, near_zone int")
    order_c = [c.split()[0] for c in CALLS.split(", ")]
    order_f = [c.split()[0] for c in FLEET.split(", ")]
    return dict(
        calls=spark.createDataFrame([tuple(c[k] for k in order_c) for c in calls], CALLS),
        fleet=spark.createDataFrame([tuple(t[k] for k in order_f) for t in fleet], FLEET),
        near=near, rows=(calls, fleet), around=around,
    )


def by_batch(world):
    calls, fleet = world["rows"]
    for b in sorted({c["batch"] for c in calls}):
        cs, ts = [c for c in calls if c["batch"] == b], [t for t in fleet if t["batch"] == b]
        if ts:
            yield b, cs, ts, brute.scores(cs, ts, world["around"])


def inputs(world):
    return world["calls"], world["fleet"], world["near"]


@pytest.fixture(scope="module")
def assigned(world):
    return D.stored(D.assign_best(*inputs(world)), "test-assigned")


def test_best_call_equals_loops(world, assigned):
    got = {(r.batch, r.taxi_id): r for r in assigned.collect()}
    want = 0
    for b, cs, ts, pairs in by_batch(world):
        for taxi, call in brute.best_calls(cs, ts, pairs).items():
            r = got[b, taxi]
            assert (r.call_id, r.near) == (call, pairs[call, taxi]["near"])
            assert (r.p, r.eta) == (pytest.approx(pairs[call, taxi]["p"]), pairs[call, taxi]["eta"])
            want += 1
    assert len(got) == want


def test_pair_totals_and_near_far_equal_loops(world):
    totals = {r.batch: r for r in D.pair_totals(*inputs(world)).collect()}
    tags = {(r.batch, r.call_id): (r.n_near, r.n_far) for r in D.near_far_counts(*inputs(world)).collect()}
    for b, cs, ts, pairs in by_batch(world):
        r = totals[b]
        assert (r.n_calls, r.n_taxis, r.n_pairs) == (len(cs), len(ts), len(pairs))
        assert r.near_pairs == sum(s["near"] for s in pairs.values())
        assert r.sum_p == pytest.approx(sum(s["p"] for s in pairs.values()))
        assert r.sum_eta == pytest.approx(sum(s["eta"] for s in pairs.values()))
        assert r.min_eta == min(s["eta"] for s in pairs.values())
        for c in cs:
            n = sum(pairs[c["call_id"], t["taxi_id"]]["near"] for t in ts)
            assert tags[b, c["call_id"]] == (n, len(ts) - n)


def test_objective_equals_loops(world, assigned):
    got = {r.batch: r.objective for r in D.objective(D.call_load(world["calls"], assigned)).collect()}
    for b, cs, ts, pairs in by_batch(world):
        assert got[b] == pytest.approx(brute.objective(cs, brute.best_calls(cs, ts, pairs), pairs))
    empty = {c["batch"] for c in world["rows"][0]} - {t["batch"] for t in world["rows"][1]}
    assert empty and all(got[b] == 6.0 for b in empty)


@pytest.mark.parametrize("max_res", [1, 2, 3])
def test_candidates_equal_loops(world, assigned, max_res):
    load = D.call_load(world["calls"], assigned)
    got = {}
    for r in sorted(D.candidates(load, assigned, world["near"], max_res).collect(), key=lambda r: r.rnk):
        got.setdefault((r.batch, r.call_id), []).append(r.taxi_id)
    want = {}
    for b, cs, ts, pairs in by_batch(world):
        for call, taxis in brute.candidates(cs, ts, brute.best_calls(cs, ts, pairs), pairs, max_res).items():
            if taxis:
                want[b, call] = taxis
    assert got == want


def test_candidates_of_cut_classes_equal_loops(world, assigned, monkeypatch):
    """Heads so short that many zones find too few near or far taxis in them and look among the whole class."""
    load = D.call_load(world["calls"], assigned)
    for head, max_res in ((5, 3), (7, 3), (2, 1)):
        monkeypatch.setattr(D, "_HEAD", head)
        got = {}
        found = D.candidates(load, assigned, world["near"], max_res)
        assert "_more" in found._jdf.queryExecution().analyzed().toString()
        for r in sorted(found.collect(), key=lambda r: r.rnk):
            got.setdefault((r.batch, r.call_id), []).append(r.taxi_id)
        want = {}
        for b, cs, ts, pairs in by_batch(world):
            for call, taxis in brute.candidates(cs, ts, brute.best_calls(cs, ts, pairs), pairs, max_res).items():
                if taxis:
                    want[b, call] = taxis
        assert got == want


def test_cut_classes_are_found_without_a_shuffle(world, assigned, monkeypatch):
    """Which classes are as long as a head is read from the stored rows; their taxis are not grouped again."""
    head, plans, stored = 4, {}, D.stored

    def watch(df, label, by=None):
        done = stored(df, label, by)
        plans[label] = df._jdf.queryExecution().executedPlan().toString(), done
        return done

    monkeypatch.setattr(D, "_HEAD", head)
    monkeypatch.setattr(D, "stored", watch)
    fleet = assigned.withColumn("draw", F.when(F.col("taxi_id") % 7 > 0, F.col("draw")))
    D.first_taxis(world["calls"], fleet, world["near"], 3)
    plan, cut = plans["cut"]
    assert "Exchange" not in plan
    sizes = {(r.batch, r.available, r.draw): r["count"] for r in fleet.groupBy(*D._CLASS).count().collect()}
    got = {(r.batch, r.available, r.draw): len(r.ends) for r in cut.collect()}
    assert got == {k: head for k, n in sizes.items() if n >= head} and 0 < len(got) < len(sizes)


def test_a_batch_of_very_many_taxis_keeps_small_rows(spark, world, monkeypatch):
    """A hundred thousand taxis for one batch: no stored list grows with them."""
    n = F.col("id")
    fleet = spark.range(100_000).select(
        F.lit(1).cast("bigint").alias("batch"), n.alias("taxi_id"), (n * 7 % ZONES).cast("int").alias("locid"),
        (n * 37 % 601).cast("double").alias("vacatime"), F.when(n % 5 == 0, 0).otherwise(1).alias("available"),
        F.when(n % 5 == 0, (n * 3 % ZONES).cast("int")).alias("desid"), (n % 900).cast("double").alias("endtime"),
        (n * 31 % 3).cast("int").alias("draw"),
    )
    calls = world["calls"].filter("batch = 1").limit(50)
    kept, stored = [], D.stored

    def watch(df, label, by=None):
        done = stored(df, label, by)
        if label in ("classes", "states"):
            size = done.select(F.max(F.length(F.to_json(F.struct("*"))))).first()[0]
            kept.append((label, done.count(), size))
        return done

    monkeypatch.setattr(D, "stored", watch)
    final = D.optimise(calls, fleet, world["near"])
    assert final.count() == 100_000
    assert {label for label, _, _ in kept} == {"classes", "states"}
    for label, rows, size in kept:
        assert rows == 1 and size < 250_000, (label, size)
    classes = D.top_k_per(fleet.withColumn("step", F.col("vacatime")), D._CLASS, [F.col("step"), F.col("taxi_id")], D._HEAD)
    assert classes.count() <= 6 * D._HEAD < fleet.count()
    assert "WindowGroupLimit" in classes._jdf.queryExecution().toString()


def test_round_equals_loops_and_gains_add_up(world, assigned):
    load = D.call_load(world["calls"], assigned)
    moves = D.improving_moves(load, assigned, world["near"]).collect()
    got = {(r.batch, r.taxi_id, r.from_call, r.to_call): r.delta for r in moves}
    after = D.objective(
        D.call_load(world["calls"], D.reassign_round(world["calls"], assigned, world["near"]))
    )
    after = {r.batch: r.objective for r in after.collect()}
    seen = 0
    for b, cs, ts, pairs in by_batch(world):
        start = brute.best_calls(cs, ts, pairs)
        want = brute.round_of_moves(cs, ts, start, pairs)
        mine = {k[1:]: v for k, v in got.items() if k[0] == b}
        assert set(mine) == set(want)
        assert mine == pytest.approx(want, abs=1e-9)
        moved = {**start, **{taxi: to for taxi, _, to in want}}
        assert after[b] == pytest.approx(brute.objective(cs, moved, pairs))
        gain = after[b] - brute.objective(cs, start, pairs)
        assert gain * len(cs) == pytest.approx(sum(want.values()), abs=1e-9)
        seen += len(want)
    assert seen > 0


def test_rounds_never_lower_the_objective_and_keep_one_call_per_taxi(world):
    best = []
    for rounds in (0, 1, 3):
        final = D.optimise(*inputs(world), rounds=rounds)
        assert final.groupBy("batch", "taxi_id").count().filter("count > 1").count() == 0
        assert final.count() == world["fleet"].count()
        best.append({r.batch: r.objective for r in D.objective(D.call_load(world["calls"], final)).collect()})
    for b in best[0]:
        assert best[0][b] <= best[1][b] + 1e-12 <= best[2][b] + 2e-12


def _pick(taxi, call):
    return (taxi * 7919 + call * 104729) % 1000003


def _problems(world):
    """(calls, taxis by id) of every batch that has calls."""
    calls, fleet = world["rows"]
    return {
        b: ([c for c in calls if c["batch"] == b], sorted((t for t in fleet if t["batch"] == b), key=lambda t: t["taxi_id"]))
        for b in {c["batch"] for c in calls}
    }


def _pick_column():
    return _pick(F.col("taxi_id"), F.col("call_id"))


def test_reassignment_to_its_end_equals_loops(world):
    final = D.optimise(*inputs(world))
    got = {(r.batch, r.taxi_id): r.call_id for r in final.collect()}
    want = {}
    for calls, taxis in _problems(world).values():
        if calls and taxis:
            pairs = brute.scores(calls, taxis, world["around"])
            want |= {(calls[0]["batch"], t): c for t, c in brute.to_the_end(calls, taxis, pairs).items()}
    assert got == want
    left = D.improving_moves(D.call_load(world["calls"], final), final, world["near"])
    assert left.count() == 0


def test_rounds_in_several_jobs_equal_rounds_in_one(world, monkeypatch):
    at_once = sorted((r.batch, r.taxi_id, r.call_id) for r in D.optimise(*inputs(world)).collect())
    monkeypatch.setattr(D, "_ROUNDS_PER_JOB", 1)
    assert sorted((r.batch, r.taxi_id, r.call_id) for r in D.optimise(*inputs(world)).collect()) == at_once
    stepwise = D.stored(D.assign_best(*inputs(world)), "test-assigned")
    for rounds in (1, 2):
        stepwise = D.stored(D.reassign_round(world["calls"], stepwise, world["near"]), "test-round")
        some = D.optimise(*inputs(world), rounds=rounds)
        assert {(r.batch, r.taxi_id, r.call_id) for r in some.collect()} == {(r.batch, r.taxi_id, r.call_id) for r in stepwise.collect()}


def test_sweep_looks_for_best_calls_once(world, monkeypatch):
    asked, best = [], D.best_offers
    monkeypatch.setattr(D, "best_offers", lambda *a: asked.append(1) or best(*a))
    D.ratio_sweep(*inputs(world), ratios=(0.5, 1.0, 1.5), key=_pick_column())
    assert len(asked) == 1


def test_sweep_equals_loops_and_counts_batches_without_taxis(world):
    ratios = (0.5, 1.0, 1.5)
    got = {r.ratio: r for r in D.ratio_sweep(*inputs(world), ratios=ratios, key=_pick_column()).collect()}
    problems = _problems(world)
    assert any(not taxis for _, taxis in problems.values())
    for ratio in ratios:
        each = []
        for calls, taxis in problems.values():
            some = taxis[: int(round(len(taxis) * ratio / 1.5, 6))]
            pairs = brute.scores(calls, some, world["around"])
            assigned = brute.to_the_end(calls, some, pairs) if some else {}
            each.append(brute.service(calls, assigned, pairs, _pick))
        assert got[ratio].n_batches == len(each)
        assert got[ratio].failure_rate == pytest.approx(sum(f for f, _ in each) / len(each))
        assert got[ratio].mean_wait == pytest.approx(sum(w for _, w in each) / len(each))
    whole = D.service_metrics(world["calls"], D.accept(D.optimise(*inputs(world)), _pick_column())).agg(F.avg("failure_rate")).first()[0]
    assert got[1.5].failure_rate == pytest.approx(whole)


def test_a_last_taxi_is_never_taken(world, assigned):
    before = D.call_load(world["calls"], assigned).filter("n_drivers > 0").select("batch", "call_id")
    final = D.optimise(*inputs(world), rounds=3)
    lost = before.join(final, ["batch", "call_id"], "left_anti")
    assert lost.count() == 0
    grown = D.call_load(world["calls"], final).join(
        D.call_load(world["calls"], assigned).select("batch", "call_id", F.col("n_drivers").alias("n0")),
        ["batch", "call_id"],
    )
    assert grown.filter("n_drivers > greatest(n0, 3)").count() == 0


def test_acceptance_and_service(world, assigned):
    key = F.col("taxi_id") * -1
    won = D.accept(assigned, key)
    service = {r.batch: r for r in D.service_metrics(world["calls"], won).collect()}
    picks = {(r.batch, r.call_id): r.taxi_id for r in won.collect()}
    for b, cs, ts, pairs in by_batch(world):
        start = brute.best_calls(cs, ts, pairs)
        want = {}
        for taxi, call in start.items():
            want[call] = max(taxi, want.get(call, taxi))
        assert {k[1]: v for k, v in picks.items() if k[0] == b} == want
        assert service[b].failure_rate == pytest.approx(1 - len(want) / len(cs))
        wait = sum(pairs[c, t]["eta"] for c, t in want.items()) / len(cs) / 60
        assert service[b].mean_wait == pytest.approx(wait)
    seeded = D.accept(assigned)
    assert seeded.count() == won.count() and sorted(seeded.collect()) == sorted(D.accept(assigned).collect())


@pytest.mark.parametrize("block", [1, 3, 100])
def test_best_calls_by_pair_draw_equal_loops(spark, world, block):
    def draw(taxi, call):
        return (taxi * 7919 + call * 104729) % 1000003 % 3

    found = pairdraws.best_calls(*inputs(world), draw=lambda t, c: draw(t, c).cast("int"), block=block)
    got = {(r.batch, r.taxi_id): (r.call_id, r.near, r.p, r.eta) for r in found.collect()}
    want = {}
    for b, cs, ts, _ in by_batch(world):
        for t in ts:
            pairs = {c["call_id"]: brute.score(c, {**t, "draw": draw(t["taxi_id"], c["call_id"]) - c["draw"]}, world["around"]) for c in cs}
            best = min(pairs, key=lambda c: (-round(pairs[c]["pull"], 9), c))
            want[b, t["taxi_id"]] = (best, pairs[best]["near"], pytest.approx(pairs[best]["p"]), pairs[best]["eta"])
    assert got == want
    seeded = {(r.batch, r.taxi_id): r.call_id for r in pairdraws.best_calls(*inputs(world)).collect()}
    assert seeded.keys() == want.keys() and seeded != {k: v[0] for k, v in want.items()}


def test_pair_draws_read_few_blocks(spark, monkeypatch):
    """Near calls at every taxi: of 40 blocks a taxi reads a few, and never the far ones."""
    calls = spark.range(40).select(
        F.lit(1).cast("bigint").alias("batch"), F.col("id").alias("call_id"), F.lit(1).alias("pickupid"), F.lit(1).alias("dropoffid"),
        F.lit(0.0).alias("calltime"), F.lit(60.0).alias("duration"), F.lit(3.0).alias("dist"), F.lit(0).alias("draw"),
    )
    fleet = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("batch"), F.col("id").alias("taxi_id"), F.lit(1).alias("locid"), F.lit(10.0).alias("vacatime"),
        F.lit(1).alias("available"), F.lit(None).cast("int").alias("desid"), F.lit(0.0).alias("endtime"), F.lit(0).alias("draw"),
    )
    near, reads, keep = spark.createDataFrame([(1, 1)], "zone int, near_zone int"), [], pairdraws.stored
    monkeypatch.setattr(pairdraws, "stored", lambda df, label: (out := keep(df, label), reads.append((label, out.count())))[0])
    assert pairdraws.best_calls(calls, fleet, near, block=1).count() == 1000
    probes = [n for label, n in reads if label == "probed"]
    assert probes[0] == 1000 and sum(probes) < 5 * 1000 and probes[-1] == 0


def test_certain_answer(spark):
    near = spark.createDataFrame([(1, 1)], "zone int, near_zone int")
    calls = spark.createDataFrame([(1, 1, 1, 1, 0.0, 60.0, 3.0, 0)], CALLS)
    fleet = spark.createDataFrame([(1, 1, 1, 600.0, 1, None, 0.0, 2)], FLEET)
    got = D.assign_best(calls, fleet, near)
    assert got.first().p == pytest.approx(1.0)
    assert D.call_load(calls, got).select((1 - F.exp("log_miss")).alias("p")).first().p == pytest.approx(1.0)


def test_equal_calls_go_to_the_lower_id(spark):
    near = spark.createDataFrame([(1, 1)], "zone int, near_zone int")
    calls = spark.createDataFrame([(1, i, 1, 1, 0.0, 60.0, 2.0, 0) for i in (9, 4, 7)], CALLS)
    fleet = spark.createDataFrame([(1, 1, 1, 10.0, 1, None, 0.0, 2)], FLEET)
    assert D.assign_best(calls, fleet, near).first().call_id == 4


def test_roll_forward(spark):
    fleet = spark.createDataFrame(
        [(1, 1, 5, 40.0, 1, None, 0.0, 0), (1, 2, 6, 0.0, 0, 9, 300.0, 0), (1, 3, 7, 11.0, 1, None, 0.0, 0),
         (1, 4, 8, 0.0, 0, 2, 5000.0, 0), (1, 5, 8, 3.0, 1, None, 0.0, 0)],
        FLEET,
    )
    won = spark.createDataFrame(
        [(1, 1, 900.0, 600.0, 3), (1, 5, 0.0, 100.0, 4)],
        "batch bigint, taxi_id bigint, calltime double, duration double, dropoffid int",
    )
    got = {r.taxi_id: r for r in D.roll_forward(fleet, won, F.lit(1000.0)).collect()}
    state = {k: (r.locid, r.vacatime, r.available, r.desid, r.endtime) for k, r in got.items()}
    assert state == {
        1: (5, 0.0, 0, 3, 1500.0),  # took a call
        2: (9, 700.0, 1, None, 300.0),  # trip finished
        3: (7, 11.0, 1, None, 0.0),  # untouched
        4: (8, 0.0, 0, 2, 5000.0),  # still busy
        5: (4, 900.0, 1, None, 100.0),  # took a call that ended before now
    }


def _loop_shift(calls, taxis, around, ratio, largest, steps, key, rounds):
    """One shift by loops: every step assigns, accepts and carries the fleet on."""
    size = int(round(len(taxis) * ratio / largest, 6))
    state = [dict(t) for t in sorted(taxis, key=lambda t: t["taxi_id"])[:size]]
    out = []
    for step in range(steps):
        cs = [c for c in calls if c["step"] == step]
        if not cs:
            continue
        pairs = brute.scores(cs, state, around)
        assigned = brute.best_calls(cs, state, pairs) if rounds == 0 else brute.to_the_end(cs, state, pairs)
        won = {}
        for taxi, call in assigned.items():
            if call not in won or key(taxi, call) < key(won[call], call):
                won[call] = taxi
        out.append((step, len(cs), 1 - len(won) / len(cs),
                    sum(pairs[c, t]["eta"] for c, t in won.items()) / len(cs) / 60))
        now = max(c["calltime"] for c in cs)
        facts = {c["call_id"]: c for c in cs}
        takes = {t: facts[c] for c, t in won.items()}
        for t in state:
            if t["taxi_id"] in takes:
                c = takes[t["taxi_id"]]
                t.update(available=0, vacatime=0.0, endtime=c["calltime"] + c["duration"], desid=c["dropoffid"])
            if t["available"] == 0 and t["endtime"] < now:
                t.update(vacatime=now - t["endtime"], available=1, locid=t["desid"], desid=None)
    return out


@pytest.mark.parametrize("rounds", [0, None])
def test_shifts_equal_loops(spark, world, rounds):
    rng = random.Random(11)
    steps, ratios, calls, taxis = 3, (0.5, 1.0, 1.5), [], []
    for shift in range(3):
        for step in range(steps):
            for i in range(0 if (shift, step) == (2, 2) else 6):
                calls.append(dict(
                    shift=shift, step=step, call_id=shift * 1000 + step * 100 + i, pickupid=rng.randrange(ZONES),
                    dropoffid=rng.randrange(ZONES), calltime=step * 600.0 + i * 60, duration=rng.choice([200.0, 900.0]),
                    dist=rng.choice([1.0, 2.8, 3.1]), draw=rng.randrange(3),
                ))
        for i in range(9):
            taxis.append(dict(
                shift=shift, taxi_id=shift * 100 + i, locid=rng.randrange(ZONES), vacatime=float(rng.choice([60, 300])),
                available=1, desid=None, endtime=0.0, draw=rng.randrange(3),
            ))
    calls_schema = "shift bigint, step int, " + CALLS.removeprefix("batch bigint, ")
    calls_df = spark.createDataFrame(
        [tuple(c[f.split()[0]] for f in calls_schema.split(", ")) for c in calls], calls_schema
    )
    fleet_schema = "shift bigint, " + FLEET.removeprefix("batch bigint, ")
    fleet_df = spark.createDataFrame(
        [tuple(t[f.split()[0]] for f in fleet_schema.split(", ")) for t in taxis], fleet_schema
    )

    def key(taxi, call):
        return (taxi * 7919 + call * 104729) % 1000003

    got = D.run_shifts(
        calls_df, fleet_df, world["near"], steps, ratios, rounds=rounds,
        key=(F.col("taxi_id") * 7919 + F.col("call_id") * 104729) % 1000003,
    )
    got = {(r.ratio, r.step): (r.n_calls, r.failure_rate, r.mean_wait) for r in got.collect()}
    want = {}
    for ratio in ratios:
        runs = [
            _loop_shift([c for c in calls if c["shift"] == s], [t for t in taxis if t["shift"] == s],
                        world["around"], ratio, max(ratios), steps, key, rounds)
            for s in range(3)
        ]
        for step in range(steps):
            rows = [r for run in runs for r in run if r[0] == step]
            want[ratio, step] = (
                sum(r[1] for r in rows), sum(r[2] for r in rows) / len(rows), sum(r[3] for r in rows) / len(rows)
            )
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k]), k


def test_shift_query_reassigns_to_the_end(spark, world, monkeypatch):
    """The registered query itself, on a small fixture, against the loops."""
    rng = random.Random(12)
    steps, calls, taxis = 3, [], []
    for shift in range(3):
        for step in range(steps):
            for i in range(6):
                calls.append(dict(
                    shift=shift, step=step, call_id=shift * 1000 + step * 100 + i, pickupid=rng.randrange(ZONES),
                    dropoffid=rng.randrange(ZONES), calltime=step * 600.0 + i * 60, duration=rng.choice([200.0, 900.0]),
                    dist=rng.choice([1.0, 2.8, 3.1]), draw=rng.randrange(3),
                ))
        for i in range(12):
            taxis.append(dict(
                shift=shift, taxi_id=shift * 100 + i, locid=rng.randrange(ZONES), vacatime=float(rng.choice([60, 300])),
                available=1, desid=None, endtime=0.0, draw=rng.randrange(3),
            ))
    table = lambda rows, schema: spark.createDataFrame(
        [tuple(r[f.split()[0]] for f in schema.split(", ")) for r in rows], schema
    )
    calls_df = table(calls, "shift bigint, step int, " + CALLS.removeprefix("batch bigint, "))
    fleet_df = table(taxis, "shift bigint, " + FLEET.removeprefix("batch bigint, "))
    monkeypatch.setattr(V, "BATCHES_PER_SHIFT", steps)
    monkeypatch.setattr(V, "shift_calls", lambda *_: calls_df)
    monkeypatch.setattr(V, "fleet", lambda *_: fleet_df)
    monkeypatch.setattr(V, "near", lambda *_: world["near"])
    got = {(r.ratio, r.step): (r.n_calls, r.failure_rate, r.mean_wait) for r in dispatching.shift_simulation(spark, "").collect()}

    def loops(rounds):
        out = {}
        for ratio in D.FLEET_RATIOS:
            rows = [
                r for s in range(3) for r in _loop_shift(
                    [c for c in calls if c["shift"] == s], [t for t in taxis if t["shift"] == s], world["around"], ratio,
                    max(D.FLEET_RATIOS), steps, lambda taxi, call: (taxi * 7919 + call * 104729) % 1000003, rounds)
            ]
            for step in range(steps):
                own = [r for r in rows if r[0] == step]
                out[ratio, step] = (sum(r[1] for r in own), sum(r[2] for r in own) / 3, sum(r[3] for r in own) / 3)
        return out

    want, first = loops(None), loops(0)
    assert got.keys() == want.keys() and any(want[k] != pytest.approx(first[k], abs=1e-5) for k in want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-6), k


def test_rounds_need_no_list_of_taxis_per_zone(world):
    """Ranked taxis go to their calls inside a task: no plan holds a list per batch and zone, and no round is unrolled."""
    final = D.optimise(*inputs(world))
    assert "aggregate(" not in final._jdf.queryExecution().toString()
    load = D.call_load(world["calls"], final)
    plan = D.candidates(load, D.stored(final, "test-final"), world["near"])._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "_lists" not in plan


def test_functions_of_tasks_name_no_module_of_this_package(world, assigned, monkeypatch):
    """Executors have no copy of the package: what a task runs is shipped whole."""
    code = "import pickle, sys; sys.modules['faremeter'] = None; pickle.load(sys.stdin.buffer); print('loaded')"
    kept = []
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", lambda self, run, schema: kept.append(run))
    D.candidates(D.call_load(world["calls"], assigned), assigned, world["near"])
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(kept[0]), capture_output=True, check=False)
    assert done.stdout.strip() == b"loaded", done.stderr.decode()[-500:]


def test_pair_draw_scores_are_worked_out_once_per_call(world, monkeypatch):
    """A taxi reads the scores of a call from its block; it raises no power of its own."""
    plans, stored = {}, pairdraws.stored

    def watch(df, label, by=None):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, label, by)

    monkeypatch.setattr(pairdraws, "stored", watch)
    pairdraws.best_calls(world["calls"], world["fleet"], world["near"])
    assert "POWER" in plans["blocks"] and "POWER" not in plans["probed"]


_pick_any = dispatching._picked()


def _odd_shifts(spark, seed=21, steps=2):
    """Shifts of which some repeat ids, lack values or have no taxis, and calls without a shift."""
    rng = random.Random(seed)
    calls, taxis = [], []
    for shift in range(1, 9):
        for step in range(steps):
            for i in range(0 if (shift, step) == (2, 1) else 7):
                calls.append((shift, step, shift * 1000 + step * 100 + i, rng.choice([None, *range(ZONES + 2)]), rng.choice([None, *range(ZONES)]),
                              step * 600.0 + i * 60, rng.choice([200.0, 900.0]), rng.choice([1.0, 2.8, 3.1]), rng.randrange(3)))
        for i in range(0 if shift == 3 else 90 if shift == 4 else 25):
            busy = rng.random() < 0.3
            taxis.append((shift, shift * 100 + i, rng.choice([None, *range(ZONES + 2)]), float(rng.choice([0, 60, 250, 600])), 0 if busy else 1,
                          rng.choice([None, *range(ZONES)]) if busy else None, float(rng.choice([100, 500, 900])) if busy else 0.0, rng.randrange(3)))
    taxis += [t for t in taxis if t[0] == 5][:9]  # rows that come twice
    calls += [c for c in calls if c[0] == 6][2:5]
    calls += [(7, 0, None, 1, 1, 5.0, 200.0, 1.0, 0), (None, 0, 9000, 1, 1, 5.0, 200.0, 1.0, 0), (None, 1, 9001, 1, 1, 5.0, 200.0, 1.0, 0)]
    taxis += [(8, 899, 1, None, 1, None, 0.0, 0)]
    return (
        spark.createDataFrame(calls, "shift bigint, step int, " + CALLS.removeprefix("batch bigint, ")),
        spark.createDataFrame(taxis, "shift bigint, " + FLEET.removeprefix("batch bigint, ")),
    )


@pytest.mark.parametrize("rounds", [None, 0, 1])
def test_shifts_of_a_task_equal_those_over_tables(spark, world, rounds, monkeypatch):
    monkeypatch.setattr(D, "_FLEET_TOGETHER", 60)
    monkeypatch.setattr(D, "_CALLS_CARRIED", 40)
    calls, fleet = _odd_shifts(spark)
    asked, by_steps = [], D._run_by_steps
    monkeypatch.setattr(D, "_run_by_steps", lambda own, *a: asked.append(own) or by_steps(own, *a))
    ratios = (0.5, 0.9, 1.5)
    run = lambda key: sorted(D.run_shifts(calls, fleet, world["near"], 2, ratios, rounds=rounds, key=key).collect())
    got = run(_pick_any)
    assert {r.shift for r in asked.pop().select("shift").distinct().collect()} == {4, 5, 6, 7, 8, None}
    want = run(_pick_any(F.col("taxi_id"), F.col("call_id")))
    assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) == 6
    for a, b in zip(got, want, strict=True):
        assert a[3:] == pytest.approx(b[3:], abs=1e-9)


def test_shifts_store_no_table_per_step(spark, world, monkeypatch):
    """A task carries its shifts through all steps: what is stored does not grow with steps and fleet sizes."""
    calls, fleet = _odd_shifts(spark)
    labels, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, label, by=None: labels.append(label) or stored(df, label, by))
    whole = [df.filter("shift < 3") for df in (calls, fleet)]
    assert D.run_shifts(*whole, world["near"], 2, (0.5, 1.5), key=_pick_any).count() == 4
    assert labels == ["runs"]


def test_sweep_of_a_task_equals_that_over_tables(spark, world, monkeypatch):
    """With a function as key no table holds every batch and ratio, and the rows are the same."""
    monkeypatch.setattr(D, "_FLEET_TOGETHER", 60)
    labels, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, label, by=None: labels.append(label) or stored(df, label, by))
    odd = [df.withColumnRenamed("shift", "batch") for df in _odd_shifts(spark)]
    few = [df.filter("batch < 4") for df in odd]
    assert {r.n_batches for r in D.ratio_sweep(few[0].drop("step"), few[1], world["near"], key=_pick_any).collect()} == {3}
    assert labels == ["runs"]
    for calls, fleet in (odd, (world["calls"], world["fleet"])):
        run = lambda key: sorted(D.ratio_sweep(calls.drop("step"), fleet, world["near"], (0.5, 0.9, 1.5), key=key).collect())  # noqa: B023, E731
        got, want = run(_pick_any), run(_pick_any(F.col("taxi_id"), F.col("call_id")))
        assert [r[:2] for r in got] == [r[:2] for r in want] and len(got) == 3
        for a, b in zip(got, want, strict=True):
            assert a[2:] == pytest.approx(b[2:], abs=1e-9)


def test_functions_that_carry_shifts_name_no_module_of_this_package(spark, world, monkeypatch):
    code = "import pickle, sys; sys.modules['faremeter'] = None; pickle.load(sys.stdin.buffer); print('loaded')"
    kept = []

    def keep(self, run, schema):
        kept.append(run)
        raise RuntimeError("kept")

    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", keep)
    calls, fleet = _odd_shifts(spark)
    with pytest.raises(RuntimeError, match="kept"):
        D.run_shifts(calls, fleet, world["near"], 2, key=dispatching._picked())
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(kept[0]), capture_output=True, check=False)
    assert done.stdout.strip() == b"loaded", done.stderr.decode()[-500:]
