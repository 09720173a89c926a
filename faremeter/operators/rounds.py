"""Rounds of reassignment of some batches at once, as arrays; `faremeter.operators.dispatch` deals the batches out."""
from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Up to so many least values of a row are found one by one.
_FEW = 16


class Problem:
    """Batches with their loaded calls and first taxis, as arrays. `offers` holds each call's first `depth` taxis by
    (eta/60*p, step, taxi_id) as places in `taxi`, -1 where there are no more; `holder` the place of a taxi's call, or
    -1."""

    def __init__(self, calls: pa.Table, taxis: pa.Table, depth: int, draws: int, hour: float, prompt: float):
        self.hour, self.prompt = hour, prompt
        calls, taxis = calls.sort_by([("batch", "ascending"), ("call_id", "ascending")]), taxis.sort_by(
            [("batch", "ascending"), ("step", "ascending"), ("taxi_id", "ascending")]
        )
        self.batch, self.call_id = _numbers(calls, "batch", 0), _numbers(calls, "call_id", 0)
        self.n_drivers, self.log_miss, self.hours = (_numbers(calls, c) for c in ("n_drivers", "log_miss", "hours"))
        taxi = {c: _numbers(taxis, c) for c in ("idle", "endtime", "held_p", "held_eta")}
        taxi |= {c: _numbers(taxis, c, -1) for c in ("available", "draw")}
        self.taxi_batch, self.taxi_id = _numbers(taxis, "batch", 0), _numbers(taxis, "taxi_id", 0)
        self.held_p, self.held_eta, self.from_call = taxi["held_p"], taxi["held_eta"], _numbers(taxis, "held_call", 0)
        around = calls["around"].combine_chunks()
        places, listed = np.unique(around.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        is_near = np.zeros((len(calls), len(places) + 1), bool)
        is_near[pc.list_parent_indices(around).to_numpy(), listed] = True
        ends = [_places_in(places, taxis[c]) for c in ("locid", "desid")]
        pulls = np.full((len(calls), 2, draws + 1), np.nan)
        for flag in (0, 1):
            for d in range(draws):
                pulls[:, flag, d] = _numbers(calls, f"pull_{flag}_{d}")
        calltime, duration = _numbers(calls, "calltime"), _numbers(calls, "duration")
        self.offers = np.full((len(calls), depth), -1)
        self.near, self.p, self.eta = (np.zeros((len(calls), depth), t) for t in (np.int32, float, float))
        self.holder = np.full(len(taxis), -1)
        starts = np.flatnonzero(np.diff(self.batch, prepend=self.batch[:1] - 1)) if len(calls) else []
        for a, b in zip(starts, [*starts[1:], len(calls)], strict=True):
            t0, t1 = np.searchsorted(self.taxi_batch, [self.batch[a], self.batch[a] + 1])
            if t0 == t1:
                continue
            of, rows = slice(t0, t1), np.arange(a, b)[:, None]
            flags = (is_near[a:b, ends[0][of]] | is_near[a:b, ends[1][of]]).astype(np.int32)
            p = taxi["idle"][of] + pulls[rows, flags, taxi["draw"][of]]
            eta = np.where(taxi["available"][of] == 1, calltime[a:b, None], taxi["endtime"][of]) + duration[a:b, None]
            value = np.rint(eta / 60 * p * 1e9)
            value[np.isnan(value)] = -np.inf
            # taxis are in order of step and taxi_id, so the first of equal values comes first
            first = _least(value, depth)
            found, at = slice(0, first.shape[1]), np.arange(b - a)[:, None]
            self.offers[a:b, found] = first + t0
            self.near[a:b, found], self.p[a:b, found], self.eta[a:b, found] = flags[at, first], p[at, first], eta[at, first]
            place = np.searchsorted(self.call_id[a:b], self.from_call[of])
            known = self.call_id[a:b][np.minimum(place, b - a - 1)] == self.from_call[of]
            self.holder[of] = np.where(known, place + a, -1)
        # rows of one taxi stand for each other
        order = np.lexsort((self.taxi_id, self.taxi_batch))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.taxi_batch[order]) != 0) | (np.diff(self.taxi_id[order]) != 0)
        self.taxi = np.full(len(taxis) + 1, -1)
        self.taxi[order] = order[new][np.cumsum(new) - 1]
        self.moved = np.zeros(len(taxis), bool)
        self.moved_near = np.zeros(len(taxis), np.int32)

    def others(self, calls: np.ndarray, max_res: int) -> tuple[np.ndarray, np.ndarray]:
        """(call, place of its offer): the first `max_res` taxis of other calls, for calls below so many taxis."""
        asked = calls[self.n_drivers[calls] < max_res]
        offered = self.taxi[self.offers[asked]]
        other = (offered >= 0) & (np.append(self.holder, -1)[offered] != asked[:, None])
        row, at = np.nonzero(other & (np.cumsum(other, axis=1) <= max_res))
        return asked[row], at

    def improve(self, max_res: int, rounds: int | None, every: int) -> None:
        """Rounds of moves until none stands; the rule is that of `dispatch.improving_moves`.
        Every so many rounds the batches that have come to rest are left out."""
        active, done = np.arange(len(self.call_id)), 0
        touched = np.zeros(len(self.call_id), bool)
        while done != rounds:
            target, at = self.others(active, max_res)
            taxi = self.taxi[self.offers[target, at]]
            source = self.holder[taxi]
            p, eta = self.p[target, at], self.eta[target, at]
            open_ = (source >= 0) & (self.n_drivers[source] > 1)
            target, at, taxi, source, p, eta = (x[open_] for x in (target, at, taxi, source, p, eta))
            delta = self._gained(self.log_miss[target], self.hours[target], _refused(p), eta / self.hour) + self._gained(
                self.log_miss[source], self.hours[source], -_refused(self.held_p[taxi]), -self.held_eta[taxi] / self.hour
            )
            key = np.rint(delta * 1e9)
            # the greatest gain first, then the lowest taxi, then the lowest call
            order = np.lexsort((target, self.taxi_id[taxi], -key))
            order = order[key[order] > 0]
            first = np.full(len(self.call_id), len(order))
            rank = np.arange(len(order))
            for side in (target, source):
                np.minimum.at(first, side[order], rank)
            m = order[(first[target[order]] == rank) & (first[source[order]] == rank)]
            if not len(m):
                break
            target, at, taxi, source, p, eta = (x[m] for x in (target, at, taxi, source, p, eta))
            self.n_drivers[target] += 1
            self.n_drivers[source] -= 1
            self.log_miss[target] += _refused(p)
            self.log_miss[source] -= _refused(self.held_p[taxi])
            self.hours[target] += eta / self.hour
            self.hours[source] -= self.held_eta[taxi] / self.hour
            self.holder[taxi], self.held_p[taxi], self.held_eta[taxi] = target, p, eta
            self.moved[taxi], self.moved_near[taxi] = True, self.near[target, at]
            touched[target] = True
            done += 1
            if done % every == 0:
                active = active[np.isin(self.batch[active], self.batch[touched])]
                touched[:] = False

    def _gained(self, log_miss, hours, miss, more_hours) -> np.ndarray:
        """What a call's value changes by when its sums do."""

        def value(log_miss, hours):
            return 1 - np.exp(log_miss) + self.prompt * np.exp(-hours)

        return value(log_miss + miss, hours + more_hours) - value(log_miss, hours)

    def candidates(self, max_res: int) -> pa.Table:
        call, at = self.others(np.arange(len(self.call_id)), max_res)
        taxi = self.offers[call, at]
        starts = np.flatnonzero(np.diff(call, prepend=-1))
        rnk = np.arange(len(call)) - np.repeat(starts, np.diff(np.append(starts, len(call)))) + 1
        p, eta = self.p[call, at], self.eta[call, at]
        return pa.table({
            "batch": self.batch[call], "call_id": self.call_id[call], "n_drivers": self.n_drivers[call].astype(np.int64),
            "log_miss": self.log_miss[call], "hours": self.hours[call], "rnk": rnk.astype(np.int32),
            "value": np.rint(eta / 60 * p * 1e9) / 1e9, "taxi_id": self.taxi_id[taxi], "near": self.near[call, at], "p": p, "eta": eta,
            "from_call": self.from_call[taxi], "from_p": self.held_p[taxi], "from_eta": self.held_eta[taxi],
        })

    def states(self) -> pa.Table:
        """A row per batch with the last move of each taxi that moved."""
        m = np.flatnonzero(self.moved)
        batches = np.unique(self.batch)
        columns = {
            "taxi_id": self.taxi_id[m], "to_call": self.call_id[self.holder[m]], "near": self.moved_near[m], "p": self.held_p[m],
            "eta": self.held_eta[m],
        }
        moves = pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))
        ends = np.searchsorted(self.taxi_batch[m], batches, side="right")
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), moves)
        return pa.table({"batch": pa.array(batches, pa.int64()), "moves": lists})


def _numbers(table: pa.Table, column: str, missing: int | None = None) -> np.ndarray:
    """A column as doubles with null as NaN, or as integers with null as `missing`."""
    values = table[column].combine_chunks()
    if missing is None:
        return pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False).copy()
    return pc.fill_null(pc.cast(values, pa.int64()), missing).to_numpy(zero_copy_only=False).copy()


def _places_in(places: np.ndarray, column: pa.ChunkedArray) -> np.ndarray:
    """Where the values stand among ascending places; the end for others and null."""
    if not len(places):
        return np.zeros(len(column), np.int64)
    values = pc.fill_null(column.combine_chunks(), 0).to_numpy(zero_copy_only=False)
    at = np.searchsorted(places, values)
    known = (places[np.minimum(at, len(places) - 1)] == values) & column.is_valid().to_numpy()
    return np.where(known, at, len(places))


def _least(value: np.ndarray, depth: int) -> np.ndarray:
    """Places of the `depth` least values of each row, none NaN, in their order; the first of equals comes first."""
    if not _FEW >= depth < value.shape[1]:
        return np.argsort(value, axis=1, kind="stable")[:, :depth]
    left, rows = np.minimum(value, np.finfo(float).max), np.arange(len(value))
    out = np.empty((len(value), depth), np.int64)
    for i in range(depth):
        out[:, i] = at = left.argmin(axis=1)
        left[rows, at] = np.inf
    return out


def _refused(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(1 - p, 1e-300))
