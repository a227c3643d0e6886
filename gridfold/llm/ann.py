"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample on the driver: ``sample_size`` (n) vectors, 50,000 or 16 times the root
of the number of rows; each node's vectors are split by k-means into ``branch`` children until ``leaf_rows``
are left, so leaves grow with the rows. Every row is then indexed: it goes down the tree to one leaf. A query
walks the tree with one priority queue over all open nodes, nearest centre first, and visits leaves in that
order. The calibration finds, for vectors of the sample with exactly known neighbours in it, how many
leaves reach ``recall``; with more rows than the sample has, neighbours only come nearer. A query whose leaves hold too
few rows goes on until they hold k besides its own, so it has k answers wherever there are k candidates.

Neighbouring leaves share a cell of about ``cell_rows`` rows; a larger leaf is dealt over several cells, so
one that holds a third of all rows is many tasks. A query goes to each cell once, with the leaves that it
visits there; a cell that many queries visit is dealt out in as many copies as keep ``cell_asks`` queries
together, and one that none visits stays where it is. A query gets the ``k`` nearest of these leaves' rows;
only those meet in the final choice, which is exact over all visited rows, in double precision.

Vectors of different lengths have no distance: each length has a tree of its own, all in one index, and
its vectors are each other's candidates.

Defined cases: rows without an id, and vectors that are null, empty, all zero, or hold a null, NaN or
infinite component take no part, as query or candidate; ties go to the smaller id; repeated vectors are
candidates each; a query never finds its own row, but finds others with its id; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridfold.llm import scratch
from gridfold.llm.tables import ROW, share, with_row

VECTORS = f"{ROW} string, vec_id long, is_query boolean, leaf int, vector binary"


@dataclass
class Node:
    centres: np.ndarray
    children: list[Node | int] = field(default_factory=list)


@dataclass
class Tree:
    root: Node | None
    leaves: int
    dim: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), np.int32)
        stack: list[tuple[Node | int, np.ndarray]] = [(self.root if self.root is not None else 0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if isinstance(node, int):
                out[rows] = node
                continue
            near = distances(x[rows], node.centres).argmin(1)
            stack += [(child, rows[near == i]) for i, child in enumerate(node.children) if (near == i).any()]
        return out

    def visit(self, q: np.ndarray, leaves: int, held: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first leaves in best-bin-first order: at least so many, and on until they hold enough rows."""
        if self.root is None:
            return [0]
        heap: list[tuple[float, int, Node | int]] = [(0.0, 0, self.root)]
        turn, out, rows = 0, [], 0
        while heap and (len(out) < max(1, leaves) or held is not None and rows < enough):
            _, _, node = heapq.heappop(heap)
            if isinstance(node, int):
                out.append(node)
                rows += 0 if held is None else int(held[node])
                continue
            for d, child in zip(((node.centres - q) ** 2).sum(1).tolist(), node.children, strict=True):
                turn += 1
                heapq.heappush(heap, (d, turn, child))
        return out


@dataclass
class Forest:
    """A tree for each length of vectors; leaves are numbered through. visits: how many a query visits."""

    trees: dict[int, Tree]
    visits: dict[int, int]

    def __post_init__(self) -> None:
        sizes = [t.leaves for t in self.trees.values()]
        self.first = dict(zip(self.trees, np.concatenate([[0], np.cumsum(sizes)]).tolist(), strict=False))
        self.leaves = sum(sizes)
        #: The length whose leaf each is.
        self.dims = np.repeat(np.array(list(self.trees), np.int64), sizes)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less the vectors' own squares: enough to choose by."""
    return (centres**2).sum(1) - 2 * (x @ centres.T)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = distances(x, centres).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = n > 0
        centres[full] = sums[full] / n[full, None]
    return centres, distances(x, centres).argmin(1)


def fit(x: np.ndarray, branch: int = 16, leaf_rows: int = 64, seed: int = 5) -> Tree:
    rng = np.random.default_rng(seed)
    leaves = 0

    def grow(rows: np.ndarray) -> Node | int:
        nonlocal leaves
        part = x[rows]
        if len(rows) > leaf_rows and len(rows) > branch:
            centres, near = kmeans(part, branch, rng)
            used = np.flatnonzero(np.bincount(near, minlength=branch))
            if len(used) > 1:  # all rows alike can't be split
                return Node(centres[used], [grow(rows[near == i]) for i in used])
        leaves += 1
        return leaves - 1

    root = grow(np.arange(len(x))) if len(x) else 0
    return Tree(root if isinstance(root, Node) else None, max(1, leaves), x.shape[1] if x.ndim == 2 else 0)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances by differences, so that equal vectors are at exactly 0; in blocks."""
    out = np.empty((len(q), len(x)))
    step = max(1, 4_000_000 // max(1, x.size))
    for at in range(0, len(q), step):
        out[at : at + step] = np.sqrt(((q[at : at + step, None, :] - x[None]) ** 2).sum(2))
    return out


def calibrate(tree: Tree, x: np.ndarray, k: int, recall: float, tests: int = 200, seed: int = 6) -> int:
    """How many leaves best-bin-first has to visit for ``recall``, on the sample itself."""
    if tree.root is None or len(x) <= k + 1:
        return tree.leaves
    at = np.random.default_rng(seed).choice(len(x), min(tests, len(x)), replace=False)
    leaf = tree.assign(x)
    needed: list[np.ndarray] = []
    for i in at:
        d = distances(x[i : i + 1], x)[0]
        d[i] = np.inf
        turn = np.empty(tree.leaves)
        turn[tree.visit(x[i], tree.leaves)] = np.arange(tree.leaves)
        needed.append(turn[leaf[np.argpartition(d, k)[:k]]])
    return int(np.ceil(np.quantile(np.concatenate(needed), recall))) + 1


def sample_size(rows: int) -> int:
    return max(50_000, 16 * math.isqrt(rows))


def usable(vector: Column) -> Column:
    fine = ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(vector, lambda v: v != 0)
    return F.coalesce(fine, F.lit(False))


def matrices(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors, their positions and the vectors as one matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.cumsum(size) - size
    out = {}
    for dim in np.unique(size).tolist():
        at = np.flatnonzero(size == dim)
        out[dim] = (at, flat[first[at][:, None] + np.arange(dim)])
    return out


def index(vectors: DataFrame, forest: Forest) -> DataFrame:
    """All rows with their leaf, vectors as little-endian doubles."""
    shared = vectors.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for dim, (at, x) in matrices(batch.column("embedding")).items():
                leaf = (forest.trees[dim].assign(x) + forest.first[dim]).astype(np.int32)
                bounds = np.arange(len(x) + 1, dtype=np.int32) * (8 * dim)
                binary = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(x, "<f8"))])
                mine = batch.select([ROW, "vec_id", "is_query"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(leaf), binary], names=[ROW, "vec_id", "is_query", "leaf", "vector"])

    return vectors.mapInArrow(run, VECTORS)


@dataclass
class Deal:
    """Where rows and queries meet: of each leaf its first cell and how many it has; of each cell its copies."""

    first: np.ndarray
    cells: np.ndarray
    copies: np.ndarray

    def cell(self, places: list[str], leaf: np.ndarray) -> np.ndarray:
        return self.first[leaf] + np.array([crc32(p.encode()) for p in places], np.int64) % self.cells[leaf]


def dealt(per_leaf: np.ndarray, dims: np.ndarray, cell_rows: int) -> Deal:
    """Small leaves in a row, as they are numbered along a tree, share a cell; a large one has several."""
    cells = np.maximum(1, -(-per_leaf // cell_rows))
    before = np.concatenate([[0], np.cumsum(np.where(cells > 1, 0, per_leaf))])[:-1] // cell_rows
    group = np.cumsum(cells > 1) * 2 - (cells > 1)  # a large leaf, and what follows it, begins anew
    fresh = np.ones(len(cells), bool)
    fresh[1:] = (before[1:] != before[:-1]) | (group[1:] != group[:-1]) | (dims[1:] != dims[:-1])
    widths = np.where(fresh, cells, 0)
    first = (np.cumsum(widths) - widths)[np.maximum.accumulate(np.where(fresh, np.arange(len(cells)), 0))]
    return Deal(first, cells, np.ones(int(widths.sum()), np.int64))


def search(vectors: DataFrame, is_query: Column, k: int = 10, recall: float = 0.97, sample_rows: int | None = None, cell_rows: int = 4_096, cell_asks: int = 1_024) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row."""
    spark = vectors.sparkSession
    doubles = F.col("embedding").cast("array<double>")
    placed = with_row(vectors.select("vec_id", "embedding")).where(F.col("vec_id").isNotNull() & usable(doubles))
    lengths = {r["dim"]: r["n"] for r in placed.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).collect()}
    n = sum(lengths.values())
    fine = placed.select(ROW, F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), doubles.alias("embedding"))
    taken = fine.where(share((sample_rows or sample_size(n)) / max(1, n), "vec_id", "embedding")).select(F.xxhash64("vec_id", "embedding").alias("h"), "embedding")
    samples = matrices(taken.toArrow().sort_by("h")["embedding"]) if n else {}
    trees = {dim: fit(samples[dim][1]) if dim in samples else Tree(None, 1, dim) for dim in sorted(lengths)}
    forest = Forest(trees, {dim: calibrate(trees[dim], samples[dim][1], k, recall) if dim in samples else 1 for dim in trees})
    rows = scratch.cut(index(fine, forest), "ann-rows")
    held = {r["leaf"]: r["count"] for r in rows.groupBy("leaf").count().collect()}
    per_leaf = np.array([held.get(i, 0) for i in range(forest.leaves)], np.int64)
    deal = dealt(per_leaf, forest.dims, cell_rows)
    plan = spark.sparkContext.broadcast((forest, deal, per_leaf))  # bounded by the sample, and a number for each cell

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query to every cell that it visits."""
        forest, deal, per_leaf = plan.value
        for batch in batches:
            row, to, at_leaves = [], [], []
            for i, v in enumerate(batch.column("vector").to_pylist()):
                q = np.frombuffer(v, "<f8")
                by_cell: dict[int, list[int]] = {}
                for at in forest.trees[len(q)].visit(q, forest.visits[len(q)], per_leaf[forest.first[len(q)] :], k + 1):
                    at += forest.first[len(q)]
                    for c in range(int(deal.first[at]), int(deal.first[at] + deal.cells[at])):
                        by_cell.setdefault(c, []).append(at)
                row += [i] * len(by_cell)
                to += by_cell
                at_leaves += by_cell.values()
            out = batch.select([ROW, "vec_id", "vector"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(at_leaves, pa.list_(pa.int32())), *out.columns], names=["cell", "leaves", ROW, "vec_id", "vector"])

    asks = scratch.cut(rows.where("is_query").mapInArrow(ask, f"cell long, leaves array<int>, {ROW} string, vec_id long, vector binary"), "ann-asks")
    asked = {r["cell"]: r["count"] for r in asks.groupBy("cell").count().collect()}
    copies = np.array([-(-asked.get(i, 0) // cell_asks) for i in range(len(deal.copies))], np.int64)
    copied = spark.sparkContext.broadcast(Deal(deal.first, deal.cells, copies))

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row to each copy of its cell."""
        deal = copied.value
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            cell = deal.cell(batch.column(ROW).to_pylist(), leaf)
            n = deal.copies[cell]
            row = np.repeat(np.arange(len(leaf)), n)
            copy = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            leaves = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32)), pa.array(leaf[row]))
            out = batch.select([ROW, "vec_id", "vector"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(cell[row]), pa.array(copy), pa.array(np.zeros(len(row), bool)), leaves, *out.columns], names=["cell", "copy", "asks", "leaves", ROW, "vec_id", "vector"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query to one copy of its cell."""
        deal = copied.value
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            copy = np.array([crc32(p.encode()) for p in batch.column(ROW).to_pylist()], np.int64) % deal.copies[cell]
            yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(copy), pa.array(np.ones(len(cell), bool)), *batch.columns[1:]], names=["cell", "copy", "asks", "leaves", ROW, "vec_id", "vector"])

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        x = np.frombuffer(b"".join(pdf["vector"]), "<f8").reshape(len(pdf), -1)
        ids, places, leaves = pdf["vec_id"].to_numpy(), pdf[ROW].to_numpy(object), pdf["leaves"].to_numpy(object)
        q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        own = np.array([v[0] for v in leaves[c]], np.int64)
        asked, got, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for i in q:
            near = c[np.isin(own, np.asarray(leaves[i])) & (places[c] != places[i])]
            if not len(near):
                continue
            d = exact(x[i : i + 1], x[near])[0]
            if len(near) > k:  # all that are no farther than the k-th; ties are settled by id
                close = d <= np.partition(d, k - 1)[k - 1]
                near, d = near[close], d[close]
            best = np.lexsort((ids[near], d))[:k]
            asked.append(np.full(len(best), i))
            got.append(near[best])
            score.append(d[best])
        asker, found = np.concatenate(asked), np.concatenate(got)
        place = pd.Series(list(places[asker]), dtype=object)
        return pd.DataFrame({"place": place, "query_id": ids[asker], "vec_id": ids[found], "score": np.concatenate(score)})

    together = f"cell long, copy long, asks boolean, leaves array<int>, {ROW} string, vec_id long, vector binary"
    both = rows.mapInArrow(offer, together).unionByName(asks.mapInArrow(meet, together))
    local = both.groupBy("cell", "copy").applyInPandas(nearest, "place string, query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("place").orderBy("score", "vec_id"))
    return local.withColumn("rank", best.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


__all__ = ["Forest", "Tree", "calibrate", "exact", "fit", "index", "kmeans", "search", "usable"]
