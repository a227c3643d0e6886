"""Embedding whitening by a tiled covariance.

The vectors that fit the model are cut into row blocks, each row block into column blocks of ``WIDTH``
dimensions; each pair of column blocks is a tile key. A tile's pairs of column blocks are shuffled by (tile,
slice of row blocks), multiplied, summed within a task, summed by tile, and the tiles are assembled into the
covariance, whose eigenvectors whiten all rows.

Numbers. An entry c becomes the whole number x = floor(256 c). Sums of x are exact; x is centred before
anything is multiplied. x travels in the narrowest integers that hold a vector, so equal vectors are equal bytes.

Bounds. Through the driver go the sums, tiles and eigenvectors: d * d numbers for d dimensions, whatever the
rows. A multiplying task holds one row block and the tiles of its keys; a tile is summed from an iterator.
The vectors' copies meet in a ``distinct`` that is combined before its shuffle.

Defined cases: a null vector, or one with a null or non-finite entry, is dropped; an empty one has no component
and so no row. Vectors of different lengths are whitened apart, each length with its own n and components.
Beyond the range of a long, x is its nearest end. A component without spread (an eigenvalue of at most 1e-12 of the
greatest) has a null ``whitened``, and counts neither as explained nor in ``identity_error``, which is null if no
component is left. ``deviation`` is null where it exceeds a long. Repeated rows and null ids stay rows of their own;
an empty table gives an empty one; columns other than id and vector are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.llm import scratch

#: Dimensions of a column block, and rows of a row block.
WIDTH, ROWS = 64, 4096
#: Components that are returned.
COMPONENTS = 4
FLAT = 1e-12
_KINDS = (np.int8, np.int16, np.int32, np.int64)
_MOST = float(1 << 63)


def finite(vectors: pa.Array) -> np.ndarray:
    """Which vectors take part: not null, and without null or non-finite entries."""
    n = len(vectors)
    entries = vectors.flatten()
    bad = ~np.isfinite(entries.to_numpy(zero_copy_only=False).astype(np.float64)) if len(entries) else np.zeros(0, bool)
    sizes = lengths(vectors)
    faults = np.bincount(np.repeat(np.arange(n), sizes), weights=bad, minlength=n) if n else np.zeros(0)
    return np.asarray(vectors.is_valid()) & (faults == 0)


def lengths(vectors: pa.Array) -> np.ndarray:
    return vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def whole(entries: np.ndarray) -> np.ndarray:
    """floor(256 c) as longs; what no long holds becomes its nearest end."""
    x = np.floor(entries.astype(np.float64) * 256)
    out = np.clip(x, -_MOST, np.nextafter(_MOST, 0)).astype(np.int64)
    out[x >= _MOST] = np.iinfo(np.int64).max
    return out


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length: the places of the vectors that take part, and their x."""
    keep, sizes = finite(vectors), lengths(vectors)
    for d in np.unique(sizes[keep]):
        at = np.flatnonzero(keep & (sizes == d))
        if d:
            entries = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            yield at, whole(entries).reshape(len(at), d)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest integers that hold it: little-endian, so equal rows are equal bytes."""
    low, high = x.min(axis=1), x.max(axis=1)
    kind = np.select([(low >= np.iinfo(k).min) & (high <= np.iinfo(k).max) for k in _KINDS], range(len(_KINDS)))
    out: list[bytes] = [b""] * len(x)
    for k, t in enumerate(_KINDS):
        for i in np.flatnonzero(kind == k):
            out[i] = x[i].astype(np.dtype(t).newbyteorder("<")).tobytes()
    return out


def unpacked(rows: Iterable[bytes], d: int) -> np.ndarray:
    kinds = {np.dtype(k).itemsize: np.dtype(k).newbyteorder("<") for k in _KINDS}
    return np.stack([np.frombuffer(r, kinds[len(r) // d]).astype(np.int64) for r in rows])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, x in matrices(batch.column(0)):
            yield pa.RecordBatch.from_pydict({"dims": pa.array(np.full(len(x), x.shape[1], np.int32)), "x": pa.array(packed(x), pa.binary())})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Row blocks of one length each."""
    for batch in batches:
        dims = batch.column("dims").to_numpy()
        for d in np.unique(dims):
            rows = batch.column("x").take(pa.array(np.flatnonzero(dims == d))).to_pylist()
            for at in range(0, len(rows), ROWS):
                yield int(d), unpacked(rows[at : at + ROWS], int(d))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By dimension the sum of x, as two halves that no task's rows can overflow, and the number of vectors."""
    found: dict[int, list] = {}
    for d, x in _blocks(batches):
        new = [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), len(x)]
        found[d] = [a + b for a, b in zip(found[d], new, strict=True)] if d in found else new
    for d, (high, low, n) in found.items():
        yield pa.RecordBatch.from_pydict({"dims": pa.array(np.full(d, d, np.int32)), "dim": pa.array(np.arange(d, dtype=np.int32)), "high": pa.array(high), "low": pa.array(low), "n": pa.array(np.full(d, n, np.int64))})


@dataclass
class Centre:
    """The exact sums of one length's vectors, and their number."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray, dims: slice = slice(None)) -> np.ndarray:
        """x - S / n: whole parts are taken off as integers, so large offsets cost no digits."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums[dims]), strict=True)
        near = np.array(whole, np.int64)
        gap = x - near if max(abs(int(x.min())), abs(int(x.max())), *map(abs, whole)) < 1 << 62 else x.astype(np.float64) - near
        return gap.astype(np.float64) - np.array(rest, np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S) ** 2 of each row, exactly; None if it exceeds a long."""
        bound = (np.abs(x.astype(np.float64)) * self.n + np.abs(np.array(self.sums, np.float64))) ** 2
        small = bound.sum(axis=1) < 4e18
        out: list[int | None] = [None] * len(x)
        if small.any():
            away = x[small] * np.int64(self.n) - np.array([s if abs(s) < 1 << 62 else 0 for s in self.sums], np.int64)
            for i, v in zip(np.flatnonzero(small), (away * away).sum(axis=1).tolist(), strict=True):
                out[i] = v
        for i in np.flatnonzero(~small):
            v = sum((self.n * a - s) ** 2 for a, s in zip(x[i].tolist(), self.sums, strict=True))
            out[i] = v if v < 1 << 63 else None
        return out


@dataclass
class Whitener:
    """For one length: unit eigenvectors as columns over the roots of their eigenvalues, and the shares explained."""

    centre: Centre
    directions: np.ndarray
    explained: list[float]
    identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.directions


def _tiles(d: int) -> Iterator[tuple[int, int]]:
    blocks = -(-d // WIDTH)
    return ((i, j) for i in range(blocks) for j in range(i, blocks))


def _side(i: int) -> slice:
    return slice(i * WIDTH, (i + 1) * WIDTH)


def _narrow(x: np.ndarray) -> bytes:
    """A block in the narrowest integers that hold all of it."""
    low, high = x.min(), x.max()
    return x.astype(np.dtype(next(k for k in _KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)).newbyteorder("<")).tobytes()


def _wide(block: bytes, rows: int, columns: int) -> np.ndarray:
    """A block read again: its kind follows from its size."""
    kinds = {np.dtype(k).itemsize: np.dtype(k).newbyteorder("<") for k in _KINDS}
    return np.frombuffer(block, kinds[len(block) // (rows * columns)]).reshape(rows, columns).astype(np.int64)


def _column_blocks(slices: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row block's column blocks, dealt to the tiles that multiply them; a block's slice follows from its rows."""
        for d, x in _blocks(batches):
            parts = [_narrow(x[:, _side(i)]) for i in range(-(-d // WIDTH))]
            part = zlib.crc32(parts[0]) % slices
            rows = [(d, i, j, part, len(x), parts[i], parts[j] if i != j else None) for i, j in _tiles(d)]
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, t), v in zip(_BLOCK, zip(*rows, strict=True), strict=True)})

    return cut


_BLOCK = (("dims", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("slice", pa.int32()), ("rows", pa.int32()), ("one", pa.binary()), ("other", pa.binary()))
_BLOCK_DDL = "dims int, i int, j int, slice int, rows int, one binary, other binary"


def _multiply(centres: dict[int, Centre]):
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sum of the centred products of each tile's blocks in this task."""
        found: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                d, i, j, n = row["dims"], row["i"], row["j"], row["rows"]
                one = centres[d].centred(_wide(row["one"], n, min(WIDTH, d - i * WIDTH)), _side(i))
                other = one if row["other"] is None else centres[d].centred(_wide(row["other"], n, min(WIDTH, d - j * WIDTH)), _side(j))
                found[d, i, j] = found.get((d, i, j), 0) + one.T @ other
        for (d, i, j), tile in found.items():
            yield pa.RecordBatch.from_pydict({"dims": pa.array([d], pa.int32()), "i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), "tile": pa.array([tile.ravel()], pa.list_(pa.float64()))})

    return multiply


def _sum_tiles(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A tile's sum over all tasks, one after the other."""
    total = 0
    for batch in batches:
        for tile in batch.column("tile"):
            total = total + tile.values.to_numpy()
    yield pa.RecordBatch.from_pydict({**{k: pa.array([v.as_py()], pa.int32()) for k, v in zip(("dims", "i", "j"), key, strict=True)}, "tile": pa.array([total], pa.list_(pa.float64()))})


def _moments(models: dict[int, Whitener]):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums and products of the whitened fit vectors."""
        found: dict[int, np.ndarray] = {}
        for d, x in _blocks(batches):
            w = np.column_stack([np.ones(len(x)), models[d].whitened(x)])
            found[d] = found.get(d, 0) + w.T @ w
        for d, m in found.items():
            a, b = np.indices(m.shape)
            yield pa.RecordBatch.from_pydict({"dims": pa.array(np.full(m.size, d, np.int32)), "a": pa.array(a.ravel().astype(np.int32)), "b": pa.array(b.ravel().astype(np.int32)), "m": pa.array(m.ravel())})

    return measure


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each length, from each distinct x once."""
    spark = vectors.sparkSession
    once = scratch.cut(vectors.mapInArrow(_pack, "dims int, x binary").distinct(), "whitening-fit")
    halves = once.mapInArrow(_sums, "dims int, dim int, high long, low long, n long").groupBy("dims", "dim")
    sums = halves.agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")), F.sum("n").alias("n")).collect()
    centres = {d: Centre(0, [0] * d) for d in {r["dims"] for r in sums}}
    for r in sums:
        centres[r["dims"]].n = r["n"]
        centres[r["dims"]].sums[r["dim"]] = (int(r["high"]) << 32) + int(r["low"])
    if not centres:
        return {}
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = once.mapInArrow(_column_blocks(slices), _BLOCK_DDL).repartition(slices, "dims", "i", "j", "slice")
    tiles = blocks.mapInArrow(_multiply(centres), "dims int, i int, j int, tile array<double>").groupBy("dims", "i", "j").applyInArrow(_sum_tiles, "dims int, i int, j int, tile array<double>")
    covariances = {d: np.zeros((d, d)) for d in centres}
    for r in tiles.toLocalIterator():
        v, (a, b) = covariances[r["dims"]], (_side(r["i"]), _side(r["j"]))
        v[a, b] = np.reshape(r["tile"], v[a, b].shape) / centres[r["dims"]].n
        v[b, a] = v[a, b].T
    models = {d: _model(centres[d], v, components) for d, v in covariances.items()}
    products: dict[int, np.ndarray] = {d: np.zeros((m.directions.shape[1] + 1,) * 2) for d, m in models.items()}
    for r in once.mapInArrow(_moments(models), "dims int, a int, b int, m double").groupBy("dims", "a", "b").agg(F.sum("m").alias("m")).collect():
        products[r["dims"]][r["a"], r["b"]] = r["m"]
    for d, m in models.items():
        mean = products[d][0, 1:] / m.centre.n
        away = products[d][1:, 1:] / m.centre.n - np.outer(mean, mean)
        live = np.flatnonzero(np.any(m.directions, axis=0))
        m.identity_error = float(np.abs(away[np.ix_(live, live)] - np.eye(len(live))).max()) if len(live) else None
    return models


def _model(centre: Centre, v: np.ndarray, components: int) -> Whitener:
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1, 1)
    live = values > FLAT * max(values[0], 0)
    trace = float(np.trace(v))
    roots = np.sqrt(np.where(live, values, 1))
    return Whitener(centre, np.where(live, vectors / roots, 0), [float(e / trace) if ok else 0.0 for e, ok in zip(values, live, strict=True)])


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _apply(models: dict[int, Whitener]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, x in matrices(batch.column(1)):
                model = models[x.shape[1]]
                k, w = model.directions.shape[1], model.whitened(x)
                w = np.where(np.any(model.directions, axis=0), w, np.nan)
                spread = lambda values, t: pa.array(np.tile(values, len(x)), t)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.take(pa.array(np.repeat(at, k))), "component": spread(np.arange(1, k + 1), pa.int32()), "n": pa.array(np.full(len(x) * k, model.centre.n), pa.int64()),
                    "deviation": pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))), "whitened": pa.array(w.ravel(), pa.float64(), from_pandas=True),
                    "explained": spread(np.array(model.explained), pa.float64()), "identity_error": pa.array([model.identity_error] * (len(x) * k), pa.float64()),
                })

    return apply


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row that takes part and each component: the row's whitened coordinate, and figures of the fit."""
    wanted = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"))
    models = fit(wanted.select("embedding"), components)
    return wanted.mapInArrow(_apply(models), OUT)
