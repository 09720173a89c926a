"""Scalar formulas: text clean-up, trip time and the dispatch score."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the acceptance score.
IDLE_SHARE = 0.2
IDLE_FULL_SECONDS = 600
NEAR_SHARE = 0.8
FAR_SHARE = 0.5
FAVOURITE_DISTANCE = 3
DISTANCE_SPREAD = 0.5
LOWEST_DRAW_TENTHS = 8
DRAWS = 3

# Fixed values of the fleet objective.
PROMPTNESS_WEIGHT = 6
SECONDS_PER_HOUR = 3600


def minutes(seconds: Column) -> Column:
    return seconds / 60


def strip_quotes(text: Column) -> Column:
    """Remove single quotes from both ends of a text."""
    return F.btrim(text, F.lit("'"))


def draw(identifier: Column, seed: int = 0) -> Column:
    """A repeatable draw from 0, 1, 2 for one taxi or one call."""
    return F.pmod(F.xxhash64(identifier, F.lit(seed)), F.lit(DRAWS)).cast("int")


def draw_weight(taxi_draw: Column, call_draw: Column) -> Column:
    """The random factor 0.8, 0.9 or 1.0 of one taxi and call.

    It is the sum of one draw per taxi and one per call modulo 3, so it is uniform over pairs yet known from
    each side alone. That is what lets dispatch rank calls per zone instead of visiting every pair.
    """
    return (F.lit(LOWEST_DRAW_TENTHS) + F.pmod(taxi_draw + call_draw, F.lit(DRAWS))) / F.lit(10.0)


def idle_part(idle_seconds: Column) -> Column:
    """Share of the acceptance score that grows with a taxi's time without a passenger."""
    return F.lit(IDLE_SHARE) * F.sqrt(idle_seconds) / F.sqrt(F.lit(float(IDLE_FULL_SECONDS)))


def pull_part(dist: Column, near: Column | int, weight: Column) -> Column:
    """Share of the acceptance score that depends on the call and on whether the taxi is near it."""
    if isinstance(near, Column):
        share = F.when(near == 1, F.lit(NEAR_SHARE)).otherwise(F.lit(FAR_SHARE))
    else:
        share = F.lit(NEAR_SHARE if near else FAR_SHARE)
    offset = (dist - F.lit(FAVOURITE_DISTANCE)) / F.lit(DISTANCE_SPREAD)
    return share * F.pow(weight, F.exp(-(offset * offset)))


def acceptance(idle_seconds: Column, dist: Column, near: Column | int, weight: Column) -> Column:
    """Probability that a driver takes a call."""
    return idle_part(idle_seconds) + pull_part(dist, near, weight)


def idle_seconds(available: Column, vacatime: Column) -> Column:
    """Vacancy time; a taxi with a passenger has none."""
    return F.when(available == 1, vacatime).otherwise(F.lit(0.0))


def eta(available: Column, calltime: Column, endtime: Column, duration: Column) -> Column:
    """When the trip would end: from the call time for a free taxi, from the end of the current trip otherwise."""
    return F.when(available == 1, calltime).otherwise(endtime) + duration


def billionths(x: Column) -> Column:
    """x in whole billionths, to compare scores: smaller differences are float noise and count as equal."""
    return F.rint(x * F.lit(1e9))


def log_refusal(p: Column) -> Column:
    """ln(1 - p), held finite at p = 1 and NULL for a missing p (`greatest` alone would skip the NULL)."""
    return F.when(p.isNotNull(), F.log(F.greatest(1 - p, F.lit(1e-300))))


def call_value(log_miss: Column, hours: Column) -> Column:
    """One call's term of the objective: chance of an answer plus a reward for little total time."""
    return 1 - F.exp(log_miss) + PROMPTNESS_WEIGHT * F.exp(-hours)
