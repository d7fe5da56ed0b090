"""Aggregate helpers for money columns.

Amounts carry two decimals, products of rates up to six. Summing them as decimals keeps the result exact and the same
for every partitioning, which repeated tasks on lost executors need.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F



def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def amount(value, scale: int = 2) -> Column:
    return _col(value).cast(f"decimal(18,{scale})")


def total(value, scale: int = 2) -> Column:
    """Exact sum of an amount column, as DOUBLE."""
    return F.sum(amount(value, scale)).cast("double")


def mean(value, scale: int = 2) -> Column:
    """Exact mean of an amount column, NULL for no rows."""
    return F.try_divide(total(value, scale), F.count(_col(value)))


def ratio(numerator, denominator) -> Column:
    """Division with at least 1 below, for per-user and per-order rates."""
    return _col(numerator) / F.greatest(_col(denominator), F.lit(1))


def spread(value, digits: int = 2) -> Column:
    return F.round(F.stddev(_col(value)), digits)


@dataclass(frozen=True)
class Measure:
    """An aggregate in mergeable form: partial aggregates of rows by name, how partials merge, and the value from the merged ones."""

    parts: dict[str, Column]
    merges: dict[str, Callable[[Column], Column]]
    finish: Callable[[Callable[[str], Column]], Column]


def counted(condition: Column | None = None) -> Measure:
    """Number of rows, or of those that meet a condition."""
    part = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return Measure({"n": part}, {"n": F.sum}, lambda of: of("n"))


def summed(value, scale: int = 2) -> Measure:
    """Exact sum of an amount, as DOUBLE."""
    return Measure({"s": F.sum(amount(value, scale))}, {"s": F.sum}, lambda of: of("s").cast("double"))


def averaged(value, scale: int = 2) -> Measure:
    """Exact mean of an amount, NULL for no rows."""
    parts = {"s": F.sum(amount(value, scale)), "n": F.count(_col(value))}
    return Measure(parts, {"s": F.sum, "n": F.sum}, lambda of: F.try_divide(of("s").cast("double"), of("n")))


def extreme(value, which: Callable[[Column], Column]) -> Measure:
    """``F.min`` or ``F.max`` of a column."""
    return Measure({"x": which(_col(value))}, {"x": which}, lambda of: of("x"))
