"""Event archives as a stream: a market's events are held until the watermark has passed its end.

State is kept by market alone and goes with the market; rows outside the window never enter it. What comes
out is each market's events at once, for the same fold and grid that batches use.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from gridfold.functions.timefn import HOUR_NS


def admitted(stream: DataFrame, markets: DataFrame, warm_up_ns: int = HOUR_NS) -> DataFrame:
    """A stream of decoded events joined to their (static) markets, within the windows."""
    w = markets.select("condition_id", "market_start_ns", "market_end_ns")
    joined = stream.join(w, "condition_id")
    inside = (F.col("receive_ts_ns") >= F.col("market_start_ns") - warm_up_ns) & (F.col("receive_ts_ns") < F.col("market_end_ns"))
    return joined.where(inside)


class Held(StatefulProcessor):
    """A market's events as a list that only grows, and when the market ends."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "payload string")
        self.end = handle.getValueState("end", "end_ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self.end.get()[0] if self.end.exists() else None
        end = before or 0
        for pdf in rows:
            self.events.appendList([(x,) for x in pdf["payload"]])
            end = max(end, int(pdf["market_end_ns"].max()) // 1_000_000)
        # Markets that the watermark has passed already are due at once.
        due = max(end, timerValues.getCurrentWatermarkInMs() + 1)
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.end.update((due,))
            self.handle.registerTimer(due)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield pd.DataFrame({"condition_id": key[0], "payload": [x[0] for x in self.events.get()]})
        self.events.clear()
        self.end.clear()

    def close(self) -> None:
        pass


def finalised(events: DataFrame, lateness: str = "1 minute") -> DataFrame:
    """condition_id, payload (JSON of the event): all of a market's events once its end has passed.

    events: a stream with condition_id, receive_ts_ns, market_end_ns and any further columns. A batch adds
    to a market's list and rewrites nothing of it; lists need the RocksDB state store, which is set here
    unless the session names another."""
    conf, name = events.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in conf.get(name):
        conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    payload = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    timed = events.select("condition_id", "market_end_ns", F.timestamp_micros(F.expr("receive_ts_ns div 1000")).alias("at"), payload.alias("payload")).withWatermark("at", lateness)
    return timed.groupBy("condition_id").transformWithStateInPandas(Held(), "condition_id string, payload string", "append", "EventTime")


def sink(finished: DataFrame, out: str, checkpoint: str, **trigger: Any):
    """Write finished markets; a batch that is run again overwrites its own folder."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return finished.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
