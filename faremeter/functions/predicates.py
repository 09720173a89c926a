"""Filter conditions as Column expressions; all of them reach the Parquet scan when Spark can push them."""
from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARISONS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def compare(col: Column | str, op: str, value, null_safe: bool = False) -> Column:
    """`col op value`.

    With ``null_safe`` the equality operators treat NULL as an ordinary value, so ``!=`` also keeps rows
    whose column is missing, as a document store does. Without it they follow SQL three-valued logic.
    """
    if op not in _COMPARISONS:
        raise ValueError(f"unknown comparison {op!r}, expected one of {sorted(_COMPARISONS)}")
    left = _column(col)
    right = value if isinstance(value, Column) else F.lit(value)
    if null_safe and op in ("=", "!="):
        same = left.eqNullSafe(right)
        return same if op == "=" else ~same
    return _COMPARISONS[op](left, right)


def all_of(*preds: Column) -> Column:
    """Conjunction of any number of conditions; true when there is none."""
    return reduce(operator.and_, preds) if preds else F.lit(True)


def any_of(*preds: Column) -> Column:
    """Disjunction of any number of conditions; false when there is none."""
    return reduce(operator.or_, preds) if preds else F.lit(False)


def is_number_ge(col: Column | str, lo: float) -> Column:
    """`col >= lo` for real numbers only: NULL drops out as usual, and so does NaN, which Spark sorts above all."""
    c = _column(col)
    return (c >= F.lit(lo)) & ~F.isnan(c)


def like(col: Column | str, pattern: str) -> Column:
    return _column(col).like(pattern)


def within(col: Column | str, lo, hi) -> Column:
    """Closed range check, for instance the dates a request may name."""
    return _column(col).between(F.lit(lo), F.lit(hi))
