"""Array expressions that the DataFrame functions lack, each linear or n log n in the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Powers of two that reach every array index, for searches and doublings. Written as SQL, which the
#: session parses at once, where each function of a column is a call to the JVM.
POWERS = ", ".join(str(1 << k) for k in range(31))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: inside a lambda an expression would be once an element."""
    return F.get(F.transform(F.array(value), body), 0)


def upto(n: Column, body: Callable[[Column], Column]) -> Column:
    """An array of body(0) ... body(n - 1)."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), body)).otherwise(F.array())


def steps(array: Column) -> Column:
    """The powers of two up to an array's size, greatest first: what ``count_while`` searches it by."""
    return F.filter(F.reverse(F.expr(f"array({POWERS})")), lambda p: p <= F.size(array))


def count_while(array: Column, by: Column, holds: Callable[[Column], Column]) -> Column:
    """How many elements a condition holds for that holds for the first ones alone: a binary search."""
    return F.aggregate(by, F.lit(0), lambda n, p: F.when((n + p <= F.size(array)) & holds(F.get(array, n + p - 1)), n + p).otherwise(n))


def _running(array: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What combining the elements up to each one gives, by doubling: n log n, where an aggregate over the
    elements would copy its result for each of them."""

    def doubled(a: Column, width: Column) -> Column:
        more = F.transform(a, lambda x, i: F.when(i >= width, combine(x, F.get(a, i - width))).otherwise(x))
        return F.when(F.size(a) > width, more).otherwise(a)

    return F.aggregate(F.expr(f"array({POWERS})"), array, doubled)


def running_sums(array: Column) -> Column:
    return _running(array, lambda x, y: x + y)


def running_max(array: Column) -> Column:
    return _running(array, F.greatest)
