"""Dispatch by plain loops over every call and taxi: an independent statement of the expected results."""
from __future__ import annotations

import math
from collections import defaultdict


def pull(call, near, taxi):
    weight = (8 + (taxi["draw"] + call["draw"]) % 3) / 10
    return (0.8 if near else 0.5) * weight ** math.exp(-(((call["dist"] - 3) / 0.5) ** 2))


def score(call, taxi, around):
    zones = around[call["pickupid"]]
    near = int(taxi["locid"] in zones or (taxi["desid"] is not None and taxi["desid"] in zones))
    idle = taxi["vacatime"] if taxi["available"] == 1 else 0.0
    part = pull(call, near, taxi)
    p = 0.2 * math.sqrt(idle) / math.sqrt(600) + part
    eta = (call["calltime"] if taxi["available"] == 1 else taxi["endtime"]) + call["duration"]
    return {"near": near, "pull": part, "p": p, "eta": eta}


def scores(calls, taxis, around):
    return {(c["call_id"], t["taxi_id"]): score(c, t, around) for c in calls for t in taxis}


def best_calls(calls, taxis, pairs):
    return {
        t["taxi_id"]: min(
            (c["call_id"] for c in calls), key=lambda c: (-round(pairs[c, t["taxi_id"]]["pull"], 9), c)
        )
        for t in taxis
    }


def objective(calls, assigned, pairs):
    total = 0.0
    for c in calls:
        missed, hours = 1.0, 0.0
        for taxi, call in assigned.items():
            if call == c["call_id"]:
                missed *= 1 - pairs[call, taxi]["p"]
                hours += pairs[call, taxi]["eta"] / 3600
        total += 1 - missed + 6 / math.exp(hours)
    return total / len(calls)


def counts(calls, assigned):
    n = {c["call_id"]: 0 for c in calls}
    for call in assigned.values():
        n[call] += 1
    return n


def candidates(calls, taxis, assigned, pairs, max_res=3):
    n = counts(calls, assigned)
    by_id = {t["taxi_id"]: t for t in taxis}

    def rank(call, taxi):
        t = by_id[taxi]
        s = pairs[call, taxi]
        return round(s["eta"] / 60 * s["p"], 9), t["vacatime"] if t["available"] == 1 else t["endtime"], taxi

    return {
        c["call_id"]: sorted(
            (t for t in by_id if assigned[t] != c["call_id"]), key=lambda t: rank(c["call_id"], t)
        )[:max_res]
        for c in calls
        if n[c["call_id"]] < max_res
    }


def round_of_moves(calls, taxis, assigned, pairs, max_res=3):
    """The standing moves of one round as {(taxi, from, to): gain of the summed call values}."""
    n, base = counts(calls, assigned), objective(calls, assigned, pairs) * len(calls)
    gains = {}
    for call, offered in candidates(calls, taxis, assigned, pairs, max_res).items():
        for taxi in offered:
            if n[assigned[taxi]] > 1:
                gain = objective(calls, {**assigned, taxi: call}, pairs) * len(calls) - base
                if round(gain, 9) > 0:
                    gains[taxi, assigned[taxi], call] = gain
    firsts = defaultdict(list)
    for (taxi, source, target), gain in gains.items():
        for side in (source, target):
            firsts[side].append((-round(gain, 9), taxi, target, source))
    best = {side: min(moves) for side, moves in firsts.items()}
    return {
        m: g for m, g in gains.items()
        if best[m[1]][1:] == (m[0], m[2], m[1]) and best[m[2]][1:] == (m[0], m[2], m[1])
    }


def to_the_end(calls, taxis, pairs, max_res=3):
    """Assignment after rounds of moves until none stands."""
    assigned = best_calls(calls, taxis, pairs) if calls else {}
    while moves := round_of_moves(calls, taxis, assigned, pairs, max_res) if assigned else {}:
        for taxi, _, target in moves:
            assigned[taxi] = target
    return assigned


def service(calls, assigned, pairs, key):
    """(failure rate, mean wait in minutes): each call takes the taxi with the least key of those that chose it."""
    waits = []
    for c in calls:
        own = [t for t, call in assigned.items() if call == c["call_id"]]
        if own:
            waits.append(pairs[c["call_id"], min(own, key=lambda t: (key(t, c["call_id"]), t))]["eta"])
    return 1 - len(waits) / len(calls), sum(waits) / len(calls) / 60
