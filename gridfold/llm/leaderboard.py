"""A leaderboard's change feed from a stateful stream: the revenue-band ladder.

State. For each nation a map from items to running revenue, and beside it a map from revenue bands to the sets of items
in them (``MapState``; both packed by nation, or by nation and band). A band doubles revenue twice. A top ten is
read from the highest occupied bands down, until ten items are collected, and those are sorted. A day that touches no
item on a board, and lifts none to it, isn't scanned.

Spreading. A nation may have any share of the lines, so no task has a nation's lines or items. Items are dealt into
buckets of about ``ITEMS`` items; each keeps ladders for all nations and hands on only what changes within its own top
tens. Buckets feed nodes of ``FAN`` buckets each, those the next ones, and a last node a nation: each is the
same ladder over at most ten items a feeder. The number of levels follows from the number of items; a node's
input doesn't. Before the first shuffle, lines of one item, nation and day are summed within their task, so a hot item
is a row a task and day. The lines meet their vendors in a shuffled join, whose skew adaptive execution splits; prices are
a bucket's initial state.

Recovery. All state is in the checkpoint, the feed in a file sink that commits each batch once.

Defined cases: a null key writes an empty part in the line's hash; lines without a vendor, the vendor's nation or an
item's row change nothing, but their days count for lateness. Of several rows of one vendor or item the least nation or
price holds. A null flag isn't swapped. Days before the first batch belong to it. Sums are of whole cents. Repeated
lines count again; an empty table gives an empty feed; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridfold.llm import scratch

#: Items of a bucket; buckets or nodes that feed one node; places on a board.
ITEMS, FAN, PLACES = 4096, 256, 10
#: Days from 1970 to 2024 began; batches, and the days that they part.
FIRST_DAY, BATCHES, DAYS, PATIENCE = 19723, 8, 180, 15
#: Lines that a task sums at a time.
CHUNK = 1 << 18

FEED = "nation_id int, arrival_day long, item_id long, change string, old_rank int, new_rank int, revenue long"


def pack(rows: np.ndarray) -> bytes:
    """Columns of longs as differences from row to row, compressed."""
    flat = np.diff(rows, axis=0, prepend=np.zeros((1, rows.shape[1]), np.int64))
    data = np.ascontiguousarray(flat.T).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(rows).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True)


def unpack(blob: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    data = np.frombuffer(pa.decompress(blob[4:], n * columns * 8, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view(np.int64).reshape(columns, n), axis=1).T


def band(revenue: int) -> int:
    """The ladder's rung of a positive revenue."""
    return revenue.bit_length() // 2


class Ladder:
    """One nation's items: their revenues, and the sets of items by band."""

    def __init__(self) -> None:
        self.revenue: dict[int, int] = {}
        self.bands: dict[int, set[int]] = {}
        self.top: dict[int, int] = {}
        self.touched: set[int] = set()

    def put(self, item: int, revenue: int | None) -> None:
        old = self.revenue.get(item, 0)
        if revenue is None:
            self.revenue.pop(item, None)
        else:
            self.revenue[item] = revenue
        was, now = band(old) if old > 0 else -1, band(revenue) if revenue and revenue > 0 else -1
        if was != now:
            if was >= 0:
                self.bands[was].discard(item)
                self.touched.add(was)
            if now >= 0:
                self.bands.setdefault(now, set()).add(item)
                self.touched.add(now)

    def reaches(self, item: int) -> bool:
        """Whether the item stands on the board, or would now."""
        if item in self.top:
            return True
        revenue = self.revenue.get(item, 0)
        if revenue <= 0 or len(self.top) < PLACES:
            return revenue > 0
        last = next(reversed(self.top))
        return (-revenue, item) < (-self.top[last], last)

    def scan(self) -> dict[int, int]:
        """The board, from the highest occupied bands."""
        found: list[int] = []
        for b in sorted(self.bands, reverse=True):
            found.extend(self.bands[b])
            if len(found) >= PLACES:
                break
        return {i: self.revenue[i] for i in sorted(found, key=lambda i: (-self.revenue[i], i))[:PLACES]}


class _Node(StatefulProcessor):
    """A node of the tree: ladders in state, rows of (nation, day, item, value, mark) in and out as packed blobs."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.revenues = handle.getMapState("revenues", "nation int", "blob binary")
        self.ladders = handle.getMapState("ladders", "nation int, band int", "blob binary")

    def load(self) -> dict[int, Ladder]:
        out: dict[int, Ladder] = {}
        for (nation,), (blob,) in self.revenues.iterator():
            out[nation] = Ladder()
            out[nation].revenue = dict(unpack(blob, 2).tolist())
        for (nation, b), (blob,) in self.ladders.iterator():
            out[nation].bands[b] = set(unpack(blob, 1)[:, 0].tolist())
        for ladder in out.values():
            ladder.top = ladder.scan()
        return out

    def save(self, nation: int, ladder: Ladder) -> None:
        items = np.array(sorted(ladder.revenue.items()), np.int64).reshape(-1, 2)
        self.revenues.updateValue((nation,), (pack(items),))
        for b in ladder.touched:
            if ladder.bands[b]:
                self.ladders.updateValue((nation, b), (pack(np.array(sorted(ladder.bands[b]), np.int64)[:, None]),))
            elif self.ladders.containsKey((nation, b)):
                self.ladders.removeKey((nation, b))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        blobs = [unpack(b, 5) for part in rows for b in part["lines"]]
        if not blobs:
            return
        lines = self.meant(np.concatenate(blobs))
        if not len(lines):
            return
        lines = lines[np.lexsort((lines[:, 2], lines[:, 1], lines[:, 0]))]
        ladders = self.load()
        starts = np.flatnonzero(np.any(np.diff(lines[:, :2], axis=0, prepend=-(1 << 40)), axis=1))
        ends, found, seen = [*starts[1:], len(lines)], [], set()
        for start, end in zip(starts, ends, strict=True):
            nation, day = int(lines[start, 0]), int(lines[start, 1])
            ladder = ladders.setdefault(nation, Ladder())
            seen.add(nation)
            left = self.apply(ladder, lines[start:end, 2:].tolist())
            if any(map(ladder.reaches, lines[start:end, 2].tolist())):
                old, ladder.top = ladder.top, ladder.scan()
                found.extend(self.changes(nation, day, old, ladder, left))
        for nation in seen:
            self.save(nation, ladders[nation])
        yield from self.emit(found)

    def meant(self, lines: np.ndarray) -> np.ndarray:
        return lines

    def apply(self, ladder: Ladder, lines: list[list[int]]) -> dict[int, int]:
        """Takes what feeders hand on: an item's revenue, kept or, if it left the feeder's top ten, for the last time."""
        for item, revenue, kept in lines:
            ladder.put(item, revenue if kept else None)
        return {item: revenue for item, revenue, kept in lines if not kept}

    def changes(self, nation: int, day: int, old: dict[int, int], ladder: Ladder, left: dict[int, int]) -> list[tuple]:
        new = ladder.top
        out = [(nation, day, i, r, 1) for i, r in new.items() if old.get(i) != r]
        return out + [(nation, day, i, ladder.revenue.get(i, left.get(i, 0)), 0) for i in old if i not in new]

    def emit(self, found: list[tuple]) -> Iterator[pd.DataFrame]:
        """One blob a nation."""
        rows = np.array(found, np.int64).reshape(-1, 5)
        for nation in np.unique(rows[:, 0]).tolist():
            yield pd.DataFrame({"nation": [nation], "part": [self.part], "lines": [pack(rows[rows[:, 0] == nation])]})

    part = 0


class Bucket(_Node):
    """A bucket of items: sums of lines in, changes of each nation's top ten among its items out."""

    def __init__(self, width: int) -> None:
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.prices = handle.getListState("prices", "blob binary")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: object) -> None:
        for blob in initialState["lines"]:
            self.prices.appendValue((blob,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        self.part = int(key[0]) % self.width
        return super().handleInputRows(key, rows, timerValues)

    def meant(self, lines: np.ndarray) -> np.ndarray:
        """Drops lines without an item; units are worth the item's price; one line an item, nation and day."""
        known = [unpack(blob, 2) for (blob,) in self.prices.get()]
        known = np.concatenate(known) if known else np.zeros((0, 2), np.int64)
        known = known[np.argsort(known[:, 0])]
        at = np.searchsorted(known[:, 0], lines[:, 2])
        has = (at < len(known)) & (known[np.minimum(at, max(len(known) - 1, 0)), 0] == lines[:, 2]) if len(known) else np.zeros(len(lines), bool)
        lines, at = lines[has], at[has]
        return summed(np.column_stack([lines[:, :3], lines[:, 3] + lines[:, 4] * known[at, 1], np.zeros(len(lines), np.int64)]))

    def apply(self, ladder: Ladder, lines: list[list[int]]) -> dict[int, int]:
        for item, cents, _ in lines:
            ladder.put(item, ladder.revenue.get(item, 0) + cents)
        return {}


class Middle(_Node):
    def __init__(self, width: int) -> None:
        self.width = width

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        self.part = int(key[1]) % self.width
        return super().handleInputRows(key, rows, timerValues)


class Board(_Node):
    """A nation's board: changes of its feeders' top tens in, changes of ranks out."""

    def changes(self, nation: int, day: int, old: dict[int, int], ladder: Ladder, left: dict[int, int]) -> list[tuple]:
        was, now = ({i: k for k, i in enumerate(top, 1)} for top in (old, ladder.top))
        out = []
        for item in was | now:
            a, b = was.get(item), now.get(item)
            if a != b:
                revenue = ladder.revenue.get(item, left.get(item, 0))
                out.append((nation, day, item, "enter" if a is None else "exit" if b is None else "move", a, b, revenue))
        return out

    def emit(self, found: list[tuple]) -> Iterator[pd.DataFrame]:
        if found:
            names = [x.split()[0] for x in FEED.split(", ")]
            yield pd.DataFrame(found, columns=names).astype({"old_rank": "Int32", "new_rank": "Int32"})


def summed(lines: np.ndarray) -> np.ndarray:
    """One row for each nation, day and item, with its sums."""
    lines = lines[np.lexsort((lines[:, 2], lines[:, 1], lines[:, 0]))]
    starts = np.flatnonzero(np.any(np.diff(lines[:, :3], axis=0, prepend=-(1 << 40)), axis=1)) if len(lines) else np.zeros(0, int)
    sums = np.add.reduceat(lines[:, 3:], starts, axis=0) if len(starts) else lines[:0, 3:]
    return np.column_stack([lines[starts, :3], sums])


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's lines, a blob a bucket, for ``CHUNK`` lines at a time."""
    held: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        table = np.concatenate(held)
        held.clear()
        table = table[np.argsort(table[:, 0], kind="stable")]
        buckets, starts = np.unique(table[:, 0], return_index=True)
        blobs = [pack(summed(table[a:b, 1:])) for a, b in zip(starts, [*starts[1:], len(table)], strict=True)]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(buckets, pa.int32()), "lines": pa.array(blobs, pa.binary())})

    for batch in batches:
        if batch.num_rows:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
        if sum(map(len, held)) >= CHUNK:
            yield from flush()
    if held:
        yield from flush()


def _packed_prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bucket, item, cents = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        buckets = np.unique(bucket)
        blobs = [pack(np.column_stack([item, cents])[bucket == b]) for b in buckets]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(buckets, pa.int32()), "lines": pa.array(blobs, pa.binary())})


def hashed(*columns: str) -> Column:
    """crc32 of decimal values with commas between them; null writes nothing."""
    return F.crc32(F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)).cast("binary"))


def batch_of(day: Column) -> Column:
    return F.least(F.lit(BATCHES), F.greatest(F.lit(1), 1 + F.floor((day - FIRST_DAY) * BATCHES / F.lit(DAYS)))).cast("int")


def cents(amount: Column) -> Column:
    return F.floor(100 * amount + 0.5)


def cut_lines(lines: DataFrame, vendors: DataFrame) -> str:
    """All lines with their days, batch and nation, written by batch."""
    h = hashed("sale_id", "item_id", "vendor_id", "line_no")
    day = F.coalesce(F.unix_date(F.col("shipped_at").cast("date")).cast("long"), FIRST_DAY + h % 150)
    arrival = day + h % 7 + F.when(h % 5 == 0, 20).otherwise(0)
    sign = F.when(F.col("flag") == "swapped", -1).otherwise(1)
    dealt = lines.select(
        "vendor_id", "item_id", day.cast("int").alias("ship_day"), arrival.cast("int").alias("arrival_day"),
        F.coalesce(sign * cents(F.col("amount")), F.lit(0)).alias("cents"), F.when(F.col("amount").isNull(), F.coalesce(sign * F.col("quantity"), F.lit(0))).otherwise(0).alias("units"),
    )
    nations = scratch.cut(vendors.where("vendor_id IS NOT NULL").groupBy("vendor_id").agg(F.min("nation_id").alias("nation_id")), "vendors")
    out = scratch.path(lines.sparkSession, "lines")
    joined = dealt.join(nations.hint("shuffle_hash"), "vendor_id", "left").drop("vendor_id").withColumn("batch", batch_of(F.col("arrival_day")))
    joined.write.option("compression", "zstd").partitionBy("batch").parquet(out)
    return out


def widths(items: int) -> list[int]:
    """Buckets, then the nodes of each level up to one a nation; each divides the one before."""
    out = [1 << max(3, (items // ITEMS).bit_length())]
    while out[-1] > 1:
        out.append(max(1, out[-1] // FAN))
    return out


def feed_of(stream: DataFrame, prices: DataFrame, levels: list[int]) -> DataFrame:
    """The change feed of a stream of lines that are in time."""
    bucket = F.pmod(F.xxhash64("item_id"), F.lit(levels[0])).cast("int").alias("bucket")
    lines = stream.where("nation_id IS NOT NULL AND item_id IS NOT NULL").select(bucket, "nation_id", "arrival_day", "item_id", "cents", "units")
    known = prices.select(bucket, "item_id", "cents").mapInArrow(_packed_prices, "bucket int, lines binary")
    node, between = "nation int, part int, lines binary", {"outputMode": "Append", "timeMode": "None"}
    out = lines.mapInArrow(_combined, "bucket int, lines binary").groupBy("bucket").transformWithStateInPandas(Bucket(levels[1]), node, initialState=known.groupBy("bucket"), **between)
    for width in levels[2:]:
        out = out.groupBy("nation", "part").transformWithStateInPandas(Middle(width), node, **between)
    return out.groupBy("nation").transformWithStateInPandas(Board(), FEED, **between)


def change_feed(lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """The whole feed: lines are cut into batches, and the stream is started anew for each on one checkpoint."""
    spark = lines.sparkSession
    cut, landing, feed, checkpoint = cut_lines(lines, vendors), scratch.path(spark, "landing"), scratch.path(spark, "feed"), scratch.path(spark, "checkpoint")
    table = spark.read.option("basePath", cut).parquet(cut) if _has(spark, cut) else None
    latest = {r["batch"]: r["day"] for r in table.groupBy("batch").agg(F.max("ship_day").alias("day")).collect()} if table is not None else {}
    prices = scratch.cut(items.where("item_id IS NOT NULL").groupBy("item_id").agg(F.coalesce(F.min(cents(F.col("price"))), F.lit(0)).alias("cents")), "prices")
    levels = widths(prices.count())
    tasks = "spark.sql.shuffle.partitions"
    settings = _SETTINGS | (_ON_LOCAL_FILES if checkpoint.startswith(("file:", "/")) else {}) | {tasks: str(min(levels[0], int(spark.conf.get(tasks))))}  # a task has a bucket at least
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for batch in sorted(latest):
            _move(spark, f"{cut}/batch={batch}", f"{landing}/batch={batch}")
            earlier = max((d for b, d in latest.items() if b < batch), default=None)
            stream = spark.readStream.schema(table.schema).option("basePath", landing).parquet(landing)
            in_time = stream if earlier is None else stream.where(F.col("ship_day") + PATIENCE >= earlier)
            query = feed_of(in_time, prices, levels).writeStream.format("parquet").option("path", feed).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    found = spark.read.schema(FEED).parquet(feed) if _has(spark, feed) else spark.createDataFrame([], FEED)
    return found.withColumn("batch", batch_of(F.col("arrival_day"))).select("nation_id", "arrival_day", "item_id", "batch", "change", "old_rank", "new_rank", "revenue")


#: State in RocksDB, which map state needs; two versions of it are kept for a failed batch. Stores are many and small: they
#: take no room ahead, and a batch writes what it changed. A start opens every store once, so a task closes its store when it
#: is done; otherwise the stores of earlier starts stay open, up to a minute, beside those of the next.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: For a shared folder that is mounted as local files: Hadoop's other client starts a process for each look at a file, and keeps
#: checksums beside its files anyway.
_ON_LOCAL_FILES = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}


def _path(spark: SparkSession, name: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _has(spark: SparkSession, folder: str) -> bool:
    """Whether a writer has left more than its marker there."""
    fs, path = _path(spark, folder)
    return fs.exists(path) and any(not s.getPath().getName().startswith("_SUCCESS") for s in fs.listStatus(path))


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _path(spark, target)
    fs.mkdirs(path.getParent())
    if not fs.rename(_path(spark, source)[1], path):
        raise OSError(f"{source} can't be moved to {target}")
