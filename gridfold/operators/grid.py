"""As-of sampling on a regular grid, without lookahead: each state covers a run of grid points.

A state is visible from its own time until the next state's. Its run of grid points is arithmetic, so the
as-of join is a ``lead`` and an ``explode`` of a sequence: one shuffle, no range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ceil(at: Column, start: Column, step: int) -> Column:
    """The first grid point at or after ``at``."""
    return at + F.pmod(start - at, F.lit(step))


def asof_grid(states: DataFrame, keys: list[str], time: str, tie: list[str], step: int, start: str = "start", end: str = "end", grid: str = "grid") -> DataFrame:
    """One row for each grid point of [start, end) that a state is visible at: the last state at or before
    it, ties by ``tie``. All times are BIGINT in one unit; ``start`` and ``end`` are columns."""
    order = Window.partitionBy(*keys).orderBy(time, *tie)
    begin, stop = F.col(start), F.col(end)
    until = F.least(F.coalesce(F.lead(time).over(order), stop), stop)
    first = F.greatest(begin, _ceil(F.col(time), begin, step))
    last = _ceil(until, begin, step) - step
    runs = states.withColumn("gf_first", first).withColumn("gf_last", last).where("gf_first <= gf_last")
    return runs.withColumn(grid, F.explode(F.sequence("gf_first", "gf_last", F.lit(step).cast("long")))).drop("gf_first", "gf_last")


def staleness(grid: str, time: str, unit: int) -> Column:
    """Whole units between a state and the grid point it is shown at; a state from the future is an error."""
    age = F.col(grid) - F.col(time)
    return F.when(age < 0, F.raise_error(F.lit("lookahead: a state is later than its grid point"))).otherwise(F.expr(f"(`{grid}` - `{time}`) div {unit}"))


def leading_gaps(expected: DataFrame, samples: DataFrame, keys: list[str], start: str = "start", end: str = "end", grid: str = "grid") -> DataFrame:
    """keys, gap_start, gap_end: from the start to the first visible grid point, or to the end without one."""
    seen = samples.groupBy(*keys).agg(F.min(grid).alias("gf_seen"))
    joined = expected.select(*keys, start, end).join(seen, keys, "left")
    gap_end = F.coalesce("gf_seen", F.col(end))
    return joined.select(*keys, F.col(start).alias("gap_start"), gap_end.alias("gap_end")).where("gap_start < gap_end")
