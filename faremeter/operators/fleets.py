"""Fleets of several sizes carried through successive batches, as arrays; `faremeter.operators.dispatch` deals the shifts out.

The rules are those of `dispatch`: `_with_best_offer`, `call_load`, `improve` (here `Problem`), `accept`, `roll_forward`.
"""
from __future__ import annotations

import sys
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from faremeter.operators.rounds import Problem, _numbers, _places_in, _refused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "shift long, at int, step int, n long, failure double, wait double"


class Settings(NamedTuple):
    """`shares`: each fleet's part of the largest one; `key`: what a call accepts its taxi by, of arrays of ids."""

    shares: list[float]
    steps: int
    key: Callable[[np.ndarray, np.ndarray], np.ndarray]
    max_res: int
    rounds: int | None
    every: int
    draws: int
    hour: float
    prompt: float
    idle_share: float
    idle_full: float


def simulate(calls: pa.Table, taxis: pa.Table, s: Settings) -> pa.Table:
    """(shift, at, step, n, failure, wait) of the shifts of a task; a row with `at` -1 names a shift that is left to others.

    Those are shifts with repeated ids or with values that arrays here cannot hold (null or not finite).
    """
    left = _unfit_calls(calls, s) | _unfit_taxis(taxis, s)
    out = {c: [] for c in ("shift", "at", "step", "n", "failure", "wait")}
    if left:
        gone = pa.array(sorted(left), pa.int64())
        calls, taxis = (t.filter(pc.invert(pc.is_in(t["shift"], gone))) for t in (calls, taxis))
        _add(out, list(left), -1, 0, 0, 0.0, 0.0)
    if len(calls):
        _carry(calls, taxis, s, out)
    columns = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
    kinds = {"shift": np.int64, "at": np.int32, "step": np.int32, "n": np.int64, "failure": float, "wait": float}
    return pa.table({c: pa.array(columns[c].astype(k)) for c, k in kinds.items()})


def _add(out: dict, shift, *values) -> None:
    shift = np.asarray(shift)
    for column, value in zip(out.values(), (shift, *values), strict=True):
        column.append(np.broadcast_to(value, shift.shape))


def _bad(table: pa.Table, whole: list[str], real: list[str], name: str) -> np.ndarray:
    """Rows with a null or a value that is not finite, or with the shift and id of another row."""
    bad = np.zeros(len(table), bool)
    for c in [*whole, *real]:
        bad |= table[c].combine_chunks().is_null().to_numpy(zero_copy_only=False)
    for c in real:
        bad |= ~np.isfinite(_numbers(table, c))
    shift, own = _numbers(table, "shift", 0), _numbers(table, name, 0)
    order = np.lexsort((own, shift))
    same = (np.diff(shift[order]) == 0) & (np.diff(own[order]) == 0)
    bad[order[1:][same]] = True
    return bad


def _unfit_calls(calls: pa.Table, s: Settings) -> set[int]:
    pulls = [f"pull_{f}_{d}" for f in (0, 1) for d in range(s.draws)]
    bad = _bad(calls, ["step", "call_id"], ["calltime", "duration", *pulls], "call_id")
    step = _numbers(calls, "step", 0)
    bad |= (step < 0) | (step >= s.steps)
    return set(_numbers(calls, "shift", 0)[bad].tolist())


def _unfit_taxis(taxis: pa.Table, s: Settings) -> set[int]:
    bad = _bad(taxis, ["taxi_id", "available", "draw"], ["vacatime", "endtime"], "taxi_id")
    draw = _numbers(taxis, "draw", -1)
    bad |= (draw < 0) | (draw >= s.draws) | (_numbers(taxis, "vacatime") < 0)
    return set(_numbers(taxis, "shift", 0)[bad].tolist())


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


class _State:
    """The taxis of every run, in order of run and taxi_id. A run is a shift with a fleet of one size; zones are places
    among those that some call is near, the last place is any other."""

    def __init__(self, taxis: pa.Table, shifts: np.ndarray, zones: np.ndarray, shares: list[float]):
        taxis = taxis.filter(pc.is_in(taxis["shift"], pa.array(shifts))).sort_by([("shift", "ascending"), ("taxi_id", "ascending")])
        of = np.searchsorted(shifts, _numbers(taxis, "shift", 0))
        n = np.bincount(of, minlength=len(shifts))
        rank = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        size = np.floor(np.round(n[:, None] * np.array(shares), 6))
        rows, at = np.nonzero(rank[:, None] < size[of])
        order = np.lexsort((rows, at, of[rows]))
        rows, at = rows[order], at[order]
        self.shift, self.run = of[rows], of[rows] * len(shares) + at
        self.taxi_id, self.draw, self.available = (_numbers(taxis, c, 0)[rows] for c in ("taxi_id", "draw", "available"))
        self.vacatime, self.endtime = (_numbers(taxis, c)[rows] for c in ("vacatime", "endtime"))
        self.at, self.to = (_places_in(zones, taxis[c])[rows] for c in ("locid", "desid"))
        self.has_to = taxis["desid"].is_valid().to_numpy()[rows]


def _carry(calls: pa.Table, taxis: pa.Table, s: Settings, out: dict) -> None:
    shifts, n_at = np.unique(_numbers(calls, "shift", 0)), len(s.shares)
    zones = np.unique(pc.list_flatten(calls["around"].combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64))
    state = _State(taxis, shifts, zones, s.shares)
    for step in np.unique(_numbers(calls, "step", 0)).tolist():
        part = calls.filter(pc.equal(calls["step"], step)).sort_by([("shift", "ascending"), ("call_id", "ascending")])
        own = _Calls(part, shifts, zones, s)
        # every call once for each run of its shift
        run = (np.arange(len(shifts))[:, None] * n_at + np.arange(n_at)).ravel()
        n_calls = np.bincount(own.shift, minlength=len(shifts))
        sizes = np.repeat(n_calls, n_at)
        first = np.cumsum(sizes) - sizes
        call = np.arange(sizes.sum()) - np.repeat(first, sizes) + np.repeat(np.repeat(np.cumsum(n_calls) - n_calls, n_at), sizes)
        of_run = np.repeat(run, sizes)
        on = np.flatnonzero(n_calls[state.shift] > 0)
        chosen, near, p = own.best(state, on)
        idle = np.where(state.available[on] == 1, state.vacatime[on], 0.0)
        idle = s.idle_share * np.sqrt(idle) / np.sqrt(s.idle_full)
        p = idle + p
        eta = np.where(state.available[on] == 1, own.calltime[chosen], state.endtime[on]) + own.duration[chosen]
        held = first[state.run[on]] + chosen - (np.cumsum(n_calls) - n_calls)[state.shift[on]]
        if s.rounds != 0 and len(on):
            held, p, eta = _improved(state, on, own, call, of_run, held, idle, p, eta, s)
        order = np.lexsort((state.taxi_id[on], s.key(state.taxi_id[on], own.call_id[call[held]]), held))
        won = order[_starts(held[order])]
        wait = np.zeros(len(call))
        answered = np.zeros(len(call), bool)
        wait[held[won]], answered[held[won]] = eta[won], True
        some = sizes > 0
        count = lambda w: np.bincount(of_run, w, len(run))[some] / sizes[some]
        _add(out, shifts[run[some] // n_at], run[some] % n_at, step, sizes[some], 1 - count(answered), count(wait) / 60)
        _rolled(state, on[won], own, call[held[won]])


class _Calls:
    """The calls of a step, in order of shift and call_id."""

    def __init__(self, part: pa.Table, shifts: np.ndarray, zones: np.ndarray, s: Settings):
        self.table, self.zones = part, zones
        self.shift = np.searchsorted(shifts, _numbers(part, "shift", 0))
        self.call_id, self.calltime, self.duration = _numbers(part, "call_id", 0), _numbers(part, "calltime"), _numbers(part, "duration")
        self.pull = np.stack([[_numbers(part, f"pull_{f}_{d}") for d in range(s.draws)] for f in (0, 1)])
        score = np.rint(self.pull * 1e9)
        around = part["around"].combine_chunks()
        listed = np.searchsorted(zones, pc.list_flatten(around).to_numpy(zero_copy_only=False))
        parent = pc.list_parent_indices(around).to_numpy()
        self.near = np.zeros((len(part), len(zones) + 1), bool)
        self.near[parent, listed] = True
        self.dropoff = _places_in(zones, part["dropoffid"])
        self.has_dropoff = part["dropoffid"].is_valid().to_numpy()
        self.known = part["pickupid"].is_valid().to_numpy()
        self.score = score
        # the best call of a far taxi by draw and shift, and of a near one by draw, shift and zone; -1: none
        self.far = np.full((s.draws, len(shifts)), -1)
        self.close = np.full((s.draws, len(shifts), len(zones) + 1), -1)
        for d in range(s.draws):
            order = np.lexsort((self.call_id, -score[0, d], self.shift))
            first = order[_starts(self.shift[order])]
            self.far[d, self.shift[first]] = first
            place = self.shift[parent] * (len(zones) + 1) + listed
            order = np.lexsort((self.call_id[parent], -score[1, d, parent], place))
            first = order[_starts(place[order])]
            self.close[d, self.shift[parent[first]], listed[first]] = parent[first]

    def best(self, state: _State, on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best call of these taxis, whether it is near, and its part of the score."""
        draw, shift = state.draw[on], state.shift[on]
        chosen, near = self.far[draw, shift], np.zeros(len(on), np.int32)
        score = self.score[0, draw, chosen]
        for end in (state.at[on], state.to[on]):
            other = self.close[draw, shift, end]
            theirs = np.where(other >= 0, self.score[1, draw, other], -np.inf)
            better = (theirs > score) | ((theirs == score) & (self.call_id[other] <= self.call_id[chosen]))
            better &= other >= 0
            chosen, score = np.where(better, other, chosen), np.where(better, theirs, score)
            near = np.where(better, 1, near).astype(np.int32)
        return chosen, near, self.pull[near, draw, chosen]


def _first_taxis(state: _State, on: np.ndarray, own: _Calls, rank: np.ndarray, depth: int) -> np.ndarray:
    """Places in `on` of the taxis among which every call of their run finds its first `depth` (see `dispatch.first_taxis`).

    Of the taxis of a run, state and draw, the first by `rank` that are near each zone asked for, and the first that are not.
    """
    kind = (state.run[on] * 2 + (state.available[on] == 1)) * (state.draw.max(initial=0) + 1) + state.draw[on]
    order = np.lexsort((state.taxi_id[on], rank, kind))
    kept = np.zeros(len(on), bool)
    runs, shifts = state.run[on][order], state.shift[on][order]
    starts = _starts(runs)
    calls_from = np.searchsorted(own.shift, np.arange(own.shift.max(initial=0) + 2))
    asked: dict[int, np.ndarray] = {}
    for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
        shift = shifts[a]
        if shift not in asked:
            asked[shift] = np.unique(own.near[calls_from[shift] : calls_from[shift + 1]], axis=0)
        rows = on[order[a:b]]
        near = asked[shift][:, state.at[rows]] | asked[shift][:, state.to[rows]]
        begins = _starts(kind[order[a:b]])
        lengths = np.diff(np.append(begins, b - a))
        n_near = np.cumsum(near, axis=1, dtype=np.int32)
        before = np.concatenate((np.zeros((len(near), 1), np.int32), n_near), axis=1)[:, begins]
        n_near -= np.repeat(before, lengths, axis=1)
        place = np.arange(1, b - a + 1) - np.repeat(begins, lengths)
        kept[order[a:b]] = (np.where(near, n_near, place - n_near) <= depth).any(axis=0)
    return np.flatnonzero(kept)


def _improved(state, on, own, call, of_run, held, idle, p, eta, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The calls held, p and eta of the taxis after rounds of moves."""
    depth, n = 2 * s.max_res - 1, len(call)
    rank = np.where(state.available[on] == 1, state.vacatime[on], state.endtime[on])
    some = _first_taxis(state, on, own, rank, depth)
    some = some[np.lexsort((state.taxi_id[on[some]], rank[some], state.run[on[some]]))]
    rows, own_call = on[some], own.call_id[call[held[some]]]
    known = np.flatnonzero(own.known[call])
    load = own.table.select([c for c in own.table.column_names if c not in ("shift", "step")]).take(pa.array(call[known]))
    extra = {
        "batch": of_run, "n_drivers": np.bincount(held, minlength=n), "log_miss": np.bincount(held, _refused(p), n),
        "hours": np.bincount(held, eta, n) / s.hour,
    }
    for name, values in extra.items():
        load = load.append_column(name, pa.array(values[known]))
    place = lambda at: pa.array(np.append(own.zones, 0)[at], pa.int64(), mask=at == len(own.zones))
    taxis = pa.table({
        "batch": state.run[rows], "taxi_id": state.taxi_id[rows], "step": rank[some], "idle": idle[some], "available": state.available[rows],
        "endtime": state.endtime[rows], "draw": state.draw[rows], "locid": place(state.at[rows]), "desid": place(state.to[rows]),
        "held_call": own_call, "held_p": p[some], "held_eta": eta[some],
    })
    x = Problem(load, taxis, depth, s.draws, s.hour, s.prompt)
    x.improve(s.max_res, s.rounds, s.every)
    moved = np.flatnonzero(x.moved)
    held[some[moved]], p[some[moved]], eta[some[moved]] = known[x.holder[moved]], x.held_p[moved], x.held_eta[moved]
    return held, p, eta


def _rolled(state: _State, winners: np.ndarray, own: _Calls, calls: np.ndarray) -> None:
    """The state after a step: winners drive to where their call ends; whose trip has ended by the last call is free there."""
    state.available[winners], state.vacatime[winners] = 0, 0.0
    state.endtime[winners] = own.calltime[calls] + own.duration[calls]
    state.to[winners], state.has_to[winners] = own.dropoff[calls], own.has_dropoff[calls]
    now = np.full(max(state.shift.max(initial=0), own.shift.max(initial=0)) + 1, -np.inf)
    np.maximum.at(now, own.shift, own.calltime)
    now = now[state.shift]
    done = (state.endtime < now) & (state.available == 0)
    state.vacatime[done], state.available[done] = (now - state.endtime)[done], 1
    moved = done & state.has_to
    state.at[moved] = state.to[moved]
    state.to[done], state.has_to[done] = len(own.zones), False
