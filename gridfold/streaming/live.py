"""The book as streaming state: samples on the grid come out as the watermark moves.

A market's state is its tokens' levels (a map, of which a step writes what it changed), what is known of each token's
last state, and the events that the watermark hasn't passed yet. When it moves, the events that it passed are put in
order, freed of duplicates and applied, and each grid point that it passed is emitted for each token with a snapshot. An
event goes once it is applied, so state doesn't grow with the hour. A market that ends drops all of its state.

What batches and the stream give is the same, row by row, but for the number of a sample's event: a batch counts
through a market's tokens one after the other, which a stream can't know, so here it counts within the token. A batch excludes a
market with a contradiction as a whole; here its samples end with a row that says what the contradiction is.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from gridfold.operators import book, order
from gridfold.operators.book import PRICE_UNIT, SIZE_UNIT

MS = 1_000_000
_SIDES = ("bid_prices", "bid_sizes", "ask_prices", "ask_sizes")
_EVENT = ("receive_ts_ns", "source_ts_ns", "source_object", "source_row", "token_id", "one", "two", "kind", "price", "size", "best_bid", "best_ask", "old_tick", "new_tick", *_SIDES)
OUT = "condition_id string, token_id string, grid_ts_ns long, source_ts_ns long, receive_ts_ns long, token_sequence long, bid_prices array<long>, bid_sizes array<long>, ask_prices array<long>, ask_sizes array<long>, error_kind string, error string"
_NAMES = [x.split()[0] for x in OUT.split(", ")]


class _Token:
    """A token's book, the times of its last state, and how many events it has had."""

    def __init__(self, saved: tuple | None = None) -> None:
        self.book, self.events, self.at = book.Book(), 0, None
        if saved:
            self.book.anchored, self.book.tick, self.events, *at = saved
            self.at = tuple(at) if at[0] is not None else None

    def saved(self) -> tuple:
        return (self.book.anchored, self.book.tick, self.events, *(self.at or (None, None, None)))

    def levels(self) -> dict[tuple[bool, int], int]:
        return {(bid, k): s for bid, side in ((True, self.book.bids), (False, self.book.asks)) for k, s in side.sizes.items()}

    def apply(self, e: dict, last: bool) -> None:
        kind, number = e["kind"], self.events
        self.events += 1
        if kind == book.TRADE or not self.book.anchored and kind != book.BOOK:
            return
        if kind == book.BUY:
            self.book.bids.set(-e["price"], e["size"])
        elif kind == book.SELL:
            self.book.asks.set(e["price"], e["size"])
        elif kind == book.BOOK:
            self.book.replace(*(e[c] for c in _SIDES))
        else:
            self.book.change_tick(e["old_tick"], e["new_tick"])
        if last:
            self.book.judge(e["best_bid"], e["best_ask"], kind in (book.BUY, book.SELL))
        self.at = (e["source_ts_ns"], e["receive_ts_ns"], number)


class LiveBook(StatefulProcessor):
    """A market's books."""

    def __init__(self, step_ns: int) -> None:
        self.step = step_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", "token string, bid boolean, key long", "size long")
        self.tokens = handle.getMapState("tokens", "token string", "anchored boolean, tick long, events long, source_ts_ns long, receive_ts_ns long, number long")
        self.waiting = handle.getListState("waiting", "event string")
        self.market = handle.getValueState("market", "next_grid long, end long, timer long, failed boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.market.get() if self.market.exists() else None
        for pdf in rows:
            if known is None:
                known = (int(pdf["market_start_ns"].iloc[0]), int(pdf["market_end_ns"].iloc[0]), None, False)
            if not known[3]:
                self.waiting.appendList([(json.dumps([_plain(v) for v in e]),) for e in pdf[list(_EVENT)].itertuples(index=False)])
        self._wake(known, timerValues.getCurrentWatermarkInMs() + 1)
        yield from ()

    def _wake(self, market: tuple, due: int) -> None:
        """One timer a market: when the watermark moves next."""
        if market[2] is not None and market[2] != due:
            self.handle.deleteTimer(market[2])
        if market[2] != due:
            self.handle.registerTimer(due)
        self.market.update((*market[:2], due, market[3]))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Applies what the watermark has passed: no event at or before it can come any more."""
        passed = timerValues.getCurrentWatermarkInMs()
        start, end, _, failed = self.market.get()
        due, rest = defaultdict(dict), []
        for (text,) in self.waiting.get():
            e = dict(zip(_EVENT, json.loads(text), strict=True))
            if e["receive_ts_ns"] // 1_000 <= passed * 1_000:
                same, place = (e["one"], e["two"]), (e["receive_ts_ns"], e["source_ts_ns"], e["source_object"], e["source_row"])
                if same not in due[e["token_id"]] or place < due[e["token_id"]][same][0]:
                    due[e["token_id"]][same] = (place, e)
            else:
                rest.append((text,))
        self.waiting.put(rest) if rest else self.waiting.clear()
        out: list[tuple] = []
        ended = passed * MS >= end
        until = min(passed * MS, end - 1)
        if not failed:
            tokens = self._load(due)
            before = {name: t.levels() for name, t in tokens.items()}
            for name in sorted(tokens):
                events = [e for _, e in sorted(due[name].values(), key=lambda x: x[0])]
                try:
                    self._token(key[0], name, tokens[name], events, start, until, out)
                except book.Conflict as x:
                    failed = True
                    out.append((key[0], name, *(None,) * 8, book.CONFLICT, str(x)))
            if ended:
                out.extend((key[0], n, *(None,) * 8, book.NO_SNAPSHOT, book.UNANCHORED.format(token=n)) for n, t in sorted(tokens.items()) if t.at is None and not failed)
            elif not failed:
                self._save(tokens, before)
        if ended or failed:
            for state in (self.levels, self.tokens, self.waiting):
                state.clear()
        if ended:
            self.market.clear()
        else:
            following = start if start > until else start + ((until - start) // self.step + 1) * self.step
            self._wake((following, end, None, failed), passed + 1 if rest else max(passed + 1, -(-following // MS)) if not failed else max(passed + 1, end // MS))
        if out:
            yield pd.DataFrame(out, columns=_NAMES).astype({c: "Int64" for c in ("grid_ts_ns", "source_ts_ns", "receive_ts_ns", "token_sequence")})

    def _load(self, due: dict) -> dict[str, _Token]:
        tokens = {name: _Token(saved) for (name,), saved in self.tokens.iterator()}
        sides: dict[tuple[str, bool], list[tuple[int, int]]] = defaultdict(list)
        for (name, bid, k), (size,) in self.levels.iterator():
            sides[name, bid].append((k, size))
        for (name, bid), levels in sides.items():
            side = book.Side(*map(list, zip(*levels, strict=True)))
            if bid:
                tokens[name].book.bids = side
            else:
                tokens[name].book.asks = side
        for name in list(due):
            tokens.setdefault(name, _Token())
        return tokens

    def _save(self, tokens: dict[str, _Token], before: dict[str, dict]) -> None:
        for name, t in tokens.items():
            self.tokens.updateValue((name,), t.saved())
            now = t.levels()
            for (bid, k), size in now.items():
                if before[name].get((bid, k)) != size:
                    self.levels.updateValue((name, bid, k), (size,))
            for bid, k in before[name].keys() - now.keys():
                self.levels.removeKey((name, bid, k))

    def _token(self, condition: str, name: str, t: _Token, events: list[dict], grid: int, until: int, out: list[tuple]) -> None:
        """Applies a token's events and samples it at the grid points between them."""
        following = [e["receive_ts_ns"] for e in events[1:]] + [None]
        for e, then in zip(events, following, strict=True):
            while grid <= until and grid < e["receive_ts_ns"]:
                self._sample(condition, name, t, grid, out)
                grid += self.step
            t.apply(e, then != e["receive_ts_ns"])
        while grid <= until:
            self._sample(condition, name, t, grid, out)
            grid += self.step

    def _sample(self, condition: str, name: str, t: _Token, grid: int, out: list[tuple]) -> None:
        if t.at is not None:
            bids, asks = t.book.bids, t.book.asks
            out.append((condition, name, grid, *t.at, [-k for k in bids.keys], [bids.sizes[k] for k in bids.keys], list(asks.keys), [asks.sizes[k] for k in asks.keys], None, None))

    def close(self) -> None:
        pass


def _plain(v: object) -> object:
    """A value of a pandas row as JSON has it."""
    if hasattr(v, "tolist"):
        return v.tolist()
    return None if v is pd.NA or isinstance(v, float) and v != v else v


def samples(events: DataFrame, step_ns: int, lateness: str = "1 minute") -> DataFrame:
    """A stream of samples, and a row for each token that ends in an error.

    events: a stream of decoded events with market_start_ns and market_end_ns, as ``replay.admitted`` gives it. Maps need the RocksDB
    state store, which is set here unless the session names another."""
    conf, name = events.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in conf.get(name):
        conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    one, two = order.fingerprint([c for c in order.PAYLOAD if c in events.columns])
    numbers = book.scaled() | {"kind": book.kind_of().cast("int"), "one": one, "two": two}
    rows = events.select(
        "condition_id", "token_id", "source_ts_ns", "receive_ts_ns", "source_object", "source_row", "market_start_ns", "market_end_ns", *(c.alias(n) for n, c in numbers.items()),
        F.timestamp_micros(F.expr("receive_ts_ns div 1000")).alias("at"),
    )
    return rows.withWatermark("at", lateness).groupBy("condition_id").transformWithStateInPandas(LiveBook(step_ns), OUT, "append", "EventTime")


def as_levels(rows: DataFrame) -> DataFrame:
    """The samples with sides in decimals, as the published table has them."""
    level = lambda p, s: F.struct((p.cast("decimal(19,0)") / PRICE_UNIT).cast("decimal(9,4)").alias("price"), (s.cast("decimal(19,0)") / SIZE_UNIT).cast("decimal(18,6)").alias("size"))
    side = lambda s: F.zip_with(f"{s}_prices", f"{s}_sizes", level).alias(f"{s}s")
    return rows.where("error_kind IS NULL").select("condition_id", "token_id", "grid_ts_ns", "source_ts_ns", "receive_ts_ns", "token_sequence", side("bid"), side("ask"))


__all__ = ["LiveBook", "as_levels", "samples"]
