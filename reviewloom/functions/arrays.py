"""Array expressions in time proportional to the array: values by name, prefix fills.

Spark has no running totals over arrays, and an accumulator that is an array is copied at every step.
These helpers state such work with elements at known places, so that long arrays stay cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once (a column's name may be replaced by its expression,
    and that be worked out for every item of a lambda).

    The value is the start of an aggregate over no items: a transform of an array that holds it would
    copy the result, with all that is nested in it, at every ``let``.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def either(condition: Column, value: Column, otherwise: Column | None = None) -> Column:
    """``value`` where the condition is true, else ``otherwise`` (NULL by default), for use within lambdas:
    ``when`` gives the same, but walks a list of cases whenever it is evaluated there."""
    return F.call_function("if", condition, value, F.lit(None) if otherwise is None else otherwise)


def choose(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first case that is true, as a chain of two-way choices; see :func:`either`."""
    for condition, value in reversed(cases):
        otherwise = either(condition, value, otherwise)
    return otherwise


def places(items: Column, wanted: Callable[[Column, Column], Column]) -> Column:
    """Places, from 0, of the items wanted."""
    return F.filter(F.transform(items, lambda x, i: either(wanted(x, i), i)), lambda i: i.isNotNull())


def spread(starts: Column, value: Callable[[Column, Column], Column], size: Column) -> Column:
    """Array of ``size`` items: from each of the ascending ``starts`` (the first is 0) up to the next,
    ``value`` of the start and its number from 0."""
    return let(starts, lambda at: F.flatten(F.transform(
        at, lambda start, i: F.array_repeat(value(start, i), F.coalesce(F.get(at, i + 1), size) - start))))
