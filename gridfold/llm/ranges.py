"""Cutting a table into cells of bounded row counts along a long column, however its values lie.

Cells of equal width are counted (one map-side combined count whose result has a bounded size); those with
too many rows are cut again, and so on. One value that too many rows share is cut by a hash of the row. The
driver holds the cells' bounds, a row finds its cell by arithmetic and a small join for each round.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that one round cuts a cell into, at most; cells of a table, about.
CHILDREN, CELLS = 4_096, 1 << 16
WIDE = "decimal(20,0)"
LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Split:
    """A cell that is cut: children ``first`` ... of width ``step`` from ``low`` on, by value or by hash."""

    cell: int
    by_value: bool
    low: int
    step: int
    first: int
    children: int


@dataclass
class Cells:
    """Cells of (value, hash); nulls come before all values. ``order``: the cells that aren't cut, ascending."""

    value: str
    hash: str
    rounds: list[list[Split]] = field(default_factory=list)
    order: list[int] = field(default_factory=list)
    least: int = 0

    def of(self, rows: DataFrame, name: str = "cell") -> DataFrame:
        """``rows`` with the number of each one's cell."""
        value = F.coalesce(F.col(self.value).cast(WIDE), F.lit(str(self.least)).cast(WIDE))
        if not self.rounds:
            return rows.withColumn(name, F.lit(0))
        root, *later = self.rounds
        begin, step = (F.lit(str(x)).cast(WIDE) for x in (root[0].low, root[0].step))
        rows = rows.withColumn(name, F.least(F.floor((value - begin) / step).cast("int"), F.lit(root[0].children - 1)) + root[0].first)
        for splits in later:
            table = rows.sparkSession.createDataFrame(
                [(s.cell, s.by_value, str(s.low), str(s.step), s.first, s.children) for s in splits], "gf_cell int, gf_by boolean, gf_low string, gf_step string, gf_first int, gf_n int"
            ).withColumns({c: F.col(c).cast(WIDE) for c in ("gf_low", "gf_step")})
            at: Column = F.when(F.col("gf_by"), value).otherwise(F.col(self.hash).cast(WIDE))
            child = F.least(F.floor((at - F.col("gf_low")) / F.col("gf_step")).cast("int"), F.col("gf_n") - 1)
            rows = rows.join(F.broadcast(table), F.col(name) == F.col("gf_cell"), "left").withColumn(name, F.when(F.col("gf_cell").isNull(), F.col(name)).otherwise(F.col("gf_first") + child))
            rows = rows.drop("gf_cell", "gf_by", "gf_low", "gf_step", "gf_first", "gf_n")  # at most a few times CELLS rows
        return rows


def cells(rows: DataFrame, value: str, hash_: str, most: int) -> Cells:
    """Cells with at most ``most`` rows, or with a share of 2 / CELLS of all if that is more."""
    known = rows.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n"), F.count(value).alias("valued")).first()
    out = Cells(value, hash_)
    if not known["n"]:
        return out
    low, high = (known["low"], known["high"]) if known["valued"] else (0, 0)
    out.least = low - 1
    most = max(most, 2 * known["n"] // CELLS)
    bounds = {0: (True, low - 1, high - low + 2)}  # by value?, low, width
    children: dict[int, range] = {}
    todo, total = {0: known["n"]}, 1
    while todo:
        splits = []
        for cell, n in sorted(todo.items()):
            by_value, begin, width = bounds[cell]
            if width == 1 and by_value:
                by_value, begin, width = False, LOW, HIGH - LOW + 1
            step = -(-width // min(width, CHILDREN, max(2, 4 * n // most)))
            count = -(-width // step)
            splits.append(Split(cell, by_value, begin, step, total, count))
            children[cell] = range(total, total + count)
            bounds |= {total + i: (by_value, begin + i * step, min(step, width - i * step)) for i in range(count)}
            total += count
        out.rounds.append(splits)
        first = splits[0].first
        counts = out.of(rows.select(value, hash_)).where(F.col("cell") >= first).groupBy("cell").count().collect()
        todo = {r["cell"]: r["count"] for r in counts if r["count"] > most and (bounds[r["cell"]][2] > 1 or bounds[r["cell"]][0])}
    stack = [0]
    while stack:
        cell = stack.pop()
        stack.extend(reversed(children[cell])) if cell in children else out.order.append(cell)
    return out
