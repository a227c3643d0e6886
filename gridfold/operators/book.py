"""Rebuilding order books: an ordered fold over each token's events.

Snapshots replace both sides, increments set or remove one price, and at the end of each batch of equal
receive times the book is held against the best prices that the event claims. The state is a map that
each event changes, so this one operator runs grouped Python, on columns of prices and sizes scaled to integers.
A group is one token of one market and hour. It comes as Arrow batches in order, one after the other, and the
book is carried from one to the next: a task holds both sides and a batch, however many events a token has. The order, and
where batches of equal times end, come from a window by token, whose shuffle and sort the fold goes on with.

Errors come back as rows: one bad market excludes itself and doesn't end the job. States before a conflict have left
the task by then; ``reconstruct`` drops those of tokens that end in an error.

With ``grid`` only states that some grid point shows are emitted (the last one before each next grid
point); all batches are validated all the same.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICE_UNIT, SIZE_UNIT = 10_000, 1_000_000
_LEVELS = "array<struct<price:decimal(9,4),size:decimal(18,6)>>"
OUT = f"condition_id string, token_id string, source_ts_ns bigint, receive_ts_ns bigint, sequence bigint, bids {_LEVELS}, asks {_LEVELS}, error_kind string, error string"
#: The kinds of exclusions, and how the published table of exclusions words a conflict.
NO_SNAPSHOT, CONFLICT = "NO_INITIAL_SNAPSHOT", "EVENT_CONFLICT"
CROSSED = "crossed or locked book:"
BEST = "best {side} disagrees: reconstructed={ours}, claimed={claimed};"
TICKS = "tick-size chain is inconsistent:"
UNANCHORED = "token has no initial snapshot: {token}"
WHERE = ("receive_ts_ns", "source_ts_ns", "token_id", "source_object", "source_row")
#: Claims that a side is empty.
NO_BID, NO_ASK = 0, PRICE_UNIT
#: Kinds of events as numbers, increments by side.
BOOK, BUY, SELL, TICK, TRADE = range(5)
#: No value, in columns of prices and sizes that are at least 0.
NONE = -1
#: Levels that a batch of output holds at most, but for one state.
FLUSH = 1 << 18


class Conflict(Exception):
    """An event that contradicts the book."""


def _spelled(price: int | None) -> str:
    return "None" if price is None else f"{price // PRICE_UNIT}.{price % PRICE_UNIT:04d}".rstrip("0").ljust(4, "0")


class Side:
    """One side's sizes by key, and its keys best first. A bid's key is its negated price."""

    def __init__(self, keys: list[int], sizes: list[int]) -> None:
        self.sizes = dict(zip(keys, sizes, strict=True))
        self.keys = sorted(self.sizes)

    def set(self, key: int, size: int) -> None:
        if size:
            if key not in self.sizes:
                insort(self.keys, key)
            self.sizes[key] = size
        elif self.sizes.pop(key, None) is not None:
            del self.keys[bisect_left(self.keys, key)]

    def cut(self, claim: int, empty: int) -> None:
        """Drops the levels that are better than a claimed best key."""
        if claim == empty:
            self.keys, self.sizes = [], {}
        while self.keys and self.keys[0] < claim:
            del self.sizes[self.keys.pop(0)]


class Book:
    """A token's book while its events come in."""

    def __init__(self) -> None:
        self.bids, self.asks = Side([], []), Side([], [])
        self.anchored, self.tick = False, NONE

    def replace(self, bid_prices: list[int], bid_sizes: list[int], ask_prices: list[int], ask_sizes: list[int]) -> None:
        self.bids, self.asks = Side([-p for p in bid_prices], bid_sizes), Side(ask_prices, ask_sizes)
        self.anchored = True

    def change_tick(self, old: int, new: int) -> None:
        if self.tick not in (NONE, old):
            raise Conflict(TICKS)
        self.tick = new

    def judge(self, bid: int, ask: int, increment: bool) -> None:
        """At a batch's end: prunes by an increment's claims, and raises Conflict if the book contradicts itself or the claims."""
        if increment:
            if bid != NONE:
                self.bids.cut(-bid, NO_BID)
            if ask != NONE:
                self.asks.cut(ask, NO_ASK)
        top = -self.bids.keys[0] if self.bids.keys else None
        low = self.asks.keys[0] if self.asks.keys else None
        if top is not None and low is not None and top >= low:
            raise Conflict(CROSSED)
        for side, ours, claimed, none in (("bid", top, bid, NO_BID), ("ask", low, ask, NO_ASK)):
            if claimed != NONE and ours != (None if claimed == none else claimed):
                raise Conflict(BEST.format(side=side, ours=_spelled(ours), claimed=_spelled(claimed)))


class _States:
    """States that wait to be handed on."""

    def __init__(self, condition: str, token: str) -> None:
        self.names = (condition, token)
        self.clear()

    def clear(self) -> None:
        self.at: list[tuple[int, int, int]] = []
        self.sides: tuple[list[int], list[int], list[int], list[int], list[int], list[int]] = ([], [], [0], [], [], [0])

    def add(self, at: tuple[int, int, int], book: Book) -> None:
        self.at.append(at)
        keys, sizes, ends, ask_keys, ask_sizes, ask_ends = self.sides
        keys.extend(book.bids.keys)
        sizes.extend(map(book.bids.sizes.__getitem__, book.bids.keys))
        ends.append(len(keys))
        ask_keys.extend(book.asks.keys)
        ask_sizes.extend(map(book.asks.sizes.__getitem__, book.asks.keys))
        ask_ends.append(len(ask_keys))

    def full(self) -> bool:
        return len(self.sides[0]) + len(self.sides[3]) + len(self.at) > FLUSH

    def batch(self) -> pa.RecordBatch:
        n = len(self.at)
        keys, sizes, ends, ask_keys, ask_sizes, ask_ends = (np.array(x, np.int64) for x in self.sides)
        source, receive, sequence = np.array(self.at, np.int64).reshape(-1, 3).T
        nothing = pa.nulls(n, pa.string())
        out = [pa.array([x] * n, pa.string()) for x in self.names] + [pa.array(x) for x in (source, receive, sequence)] + [_levels(-keys, sizes, ends), _levels(ask_keys, ask_sizes, ask_ends), nothing, nothing]
        self.clear()
        return pa.RecordBatch.from_arrays(out, schema=_ARROW)


def _decimals(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Whole numbers of at least 0 as decimals of their last digit."""
    return pa.Array.from_buffers(kind, len(values), [None, pa.py_buffer(np.column_stack([values, np.zeros_like(values)]))])


def _levels(prices: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> pa.Array:
    pairs = pa.StructArray.from_arrays([_decimals(prices, _PRICE), _decimals(sizes, _SIZE)], names=["price", "size"])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pairs)


_PRICE, _SIZE = pa.decimal128(9, 4), pa.decimal128(18, 6)
_SIDE = pa.list_(pa.struct([("price", _PRICE), ("size", _SIZE)]))
_ARROW = pa.schema(
    [("condition_id", pa.string()), ("token_id", pa.string()), ("source_ts_ns", pa.int64()), ("receive_ts_ns", pa.int64()), ("sequence", pa.int64()),
     ("bids", _SIDE), ("asks", _SIDE), ("error_kind", pa.string()), ("error", pa.string())]
)


def kind_of() -> Column:
    """The number of an event's kind."""
    kind = F.col("event_type")
    return F.when(kind == "BOOK", BOOK).when(kind == "TICK_SIZE_CHANGE", TICK).when(kind == "LAST_TRADE_PRICE", TRADE).when(F.col("side") == "BUY", BUY).otherwise(SELL).cast("tinyint")


def scaled() -> dict[str, Column]:
    """Prices and sizes of events as whole numbers, levels as lists of each."""
    price = lambda c: F.coalesce((F.col(c) * PRICE_UNIT).cast("long"), F.lit(NONE).cast("long"))
    side = lambda c, part, unit: F.transform(f"{c}.{part}", lambda x: (x * unit).cast("long"))
    return {
        "bid_prices": side("bids", "price", PRICE_UNIT), "bid_sizes": side("bids", "size", SIZE_UNIT), "ask_prices": side("asks", "price", PRICE_UNIT), "ask_sizes": side("asks", "size", SIZE_UNIT),
        "price": price("price"), "size": F.coalesce((F.col("size") * SIZE_UNIT).cast("long"), F.lit(0)), "best_bid": price("best_bid"), "best_ask": price("best_ask"), "old_tick": price("old_tick_size"), "new_tick": price("new_tick_size"),
    }


_NUMBERS = ("kind", "last", "source_ts_ns", "receive_ts_ns", "sequence", "price", "size", "best_bid", "best_ask", "old_tick", "new_tick")
_SIDES = ("bid_prices", "bid_sizes", "ask_prices", "ask_sizes")


def _snapshots(rows: pa.RecordBatch, at: np.ndarray) -> dict[int, tuple[list[int], ...]]:
    """Both sides of the snapshots in a batch, by row."""
    if not len(at):
        return {}
    rows = rows.take(pa.array(at)) if len(at) < rows.num_rows else rows
    found = []
    for prices, sizes in (("bid_prices", "bid_sizes"), ("ask_prices", "ask_sizes")):
        ends = rows.column(prices).offsets.to_numpy().tolist()
        for c in (prices, sizes):
            flat = rows.column(c).values.to_numpy().tolist()
            found.append([flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
    return dict(zip(at.tolist(), zip(*found, strict=True), strict=True))


def fold(condition: str, token: str, batches: Iterator[pa.RecordBatch], grid: int | None = None) -> Iterator[pa.RecordBatch]:
    """A token's states from its events in order, and an error at the end if there is one."""
    book, out = Book(), _States(condition, token)
    pending: tuple[int, int, int] | None = None
    shown_until, before, i, rows = 0, -1, 0, None
    try:
        for rows in batches:
            kind, last, source, receive, sequence, price, size, best_bid, best_ask, old, new = (rows.column(c).to_numpy(zero_copy_only=False) for c in _NUMBERS)
            if (np.diff(sequence, prepend=before) <= 0).any():
                raise ValueError(f"events of {token} are out of order")
            before = sequence[-1]
            snapshots = _snapshots(rows.select(_SIDES), np.flatnonzero(kind == BOOK))
            cells = (-(-receive // grid) if grid else np.arange(len(receive))).tolist()
            columns = [x.tolist() for x in (kind, last, source, receive, sequence, price, size, best_bid, best_ask)]
            if not grid:
                shown_until = NONE
            for i, (k, end, src, rec, seq, p, s, bid, ask) in enumerate(zip(*columns, strict=True)):
                # Events before the first snapshot count for nothing, and trades never leave a state.
                if k == TRADE or not book.anchored and k != BOOK:
                    continue
                if pending is not None and cells[i] != shown_until:
                    out.add(pending, book)
                if k == BUY:
                    book.bids.set(-p, s)
                elif k == SELL:
                    book.asks.set(p, s)
                elif k == BOOK:
                    book.replace(*snapshots[i])
                else:
                    book.change_tick(int(old[i]), int(new[i]))
                if end:
                    book.judge(bid, ask, k in (BUY, SELL))
                pending, shown_until = (src, rec, seq), cells[i]
                if out.full():
                    yield out.batch()
    except Conflict as x:
        if out.at:
            yield out.batch()
        place = ", ".join(f"{c}={rows.column(c)[i].as_py()}" for c in WHERE)
        yield _error(condition, token, CONFLICT, f"{x} {place}")
        for _ in batches:  # what is left is read past
            pass
        return
    if pending is None:
        yield _error(condition, token, NO_SNAPSHOT, UNANCHORED.format(token=token))
    else:
        out.add(pending, book)
        yield out.batch()


def _error(condition: str, token: str, kind: str, error: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"condition_id": condition, "token_id": token, "error_kind": kind, "error": error}], schema=_ARROW)


def rebuilt(events: DataFrame, grid: int | None = None) -> DataFrame:
    """States, and a row for each token that ends in an error, told apart by ``error_kind``."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = key[0].as_py()
        return fold(token["condition_id"], token["token_id"], batches, grid)

    # One column is the key of window and groups, so the window's order within a token is what the fold gets.
    own = F.struct("condition_id", "token_id").alias("gf_token")
    following = F.lead("receive_ts_ns").over(Window.partitionBy("gf_token").orderBy("sequence"))
    last = F.coalesce(following != F.col("receive_ts_ns"), F.lit(True))
    numbers = scaled() | {"kind": kind_of()}
    rows = events.select(own, "token_id", "source_ts_ns", "receive_ts_ns", "source_object", "source_row", "sequence", *(c.alias(n) for n, c in numbers.items())).withColumn("last", last)
    return rows.groupBy("gf_token").applyInArrow(run, OUT)


def states_of(rows: DataFrame) -> DataFrame:
    """The states among what ``rebuilt`` gives; those of tokens with a later error too."""
    return rows.where("error_kind IS NULL").select("condition_id", "token_id", "source_ts_ns", "receive_ts_ns", "sequence", "bids", "asks")


def errors_of(rows: DataFrame) -> DataFrame:
    """condition_id, token_id, error_kind, error."""
    return rows.where("error_kind IS NOT NULL").select("condition_id", "token_id", "error_kind", "error")


def reconstruct(events: DataFrame, grid: int | None = None) -> tuple[DataFrame, DataFrame]:
    """States and errors of ordered events; a token has either. Each plan runs the fold: keep ``rebuilt`` where both are read."""
    rows = rebuilt(events, grid)
    errors = errors_of(rows)
    return states_of(rows).join(errors.select("condition_id", "token_id"), ["condition_id", "token_id"], "left_anti"), errors


__all__ = ["Book", "Conflict", "errors_of", "fold", "rebuilt", "reconstruct", "states_of"]
