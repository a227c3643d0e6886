"""Reference prices from zipped CSV files, one file an archive.

Archives are read by a data source of one input partition each: a task hashes the archive and then unpacks it, both in
slices, so it holds a slice however large the file is. Bounds on the time are pushed into it, and lines beyond them never
become rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from collections.abc import Iterator
from typing import IO, Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from gridfold import files as chunks
from gridfold import schemas

#: Symbols and instruments; by kind the columns of time and value; where microseconds begin.
SYMBOLS = {a: (f"{a}USDT", "usds_m_perpetual" if a == "HYPE" else "spot") for a in schemas.ASSETS}
COLUMNS = {"trades": (4, 1), "aggTrades": (5, 1), "klines": (0, 4), "markPriceKlines": (0, 4), "indexPriceKlines": (0, 4)}
MICROS_FROM = 1_735_689_600_000_000


#: Bytes of text that a task unpacks at a time.
SLICE = 1 << 20


def lines_of(archive: IO[bytes], most: int) -> Iterator[list[str]]:
    """The lines of an archive's one file, a slice at a time. It may not name a folder, and not hold more bytes
    than ``most``, whatever the archive says of its size."""
    found = zipfile.ZipFile(archive)
    names = [name for name in found.namelist() if not name.endswith("/")]
    if len(names) != 1 or set(names[0]) & set("/\\"):
        raise ValueError(f"a price archive holds one plain file, not {names[:3]}")
    total, rest = 0, b""
    with found.open(names[0]) as file:
        while part := file.read(SLICE):
            total += len(part)
            if total > most:
                raise ValueError(f"a price archive unpacks to more than {most} bytes")
            *whole, rest = (rest + part).split(b"\n")
            if whole:
                yield [x.decode() for x in whole]
    if rest:
        yield [rest.decode()]


def csv_of(content: bytes, most: int) -> bytes:
    """All lines of an archive that is in memory."""
    return "\n".join(line for some in lines_of(io.BytesIO(content), most) for line in some).encode()


def fields(lines: list[str], kind: str) -> list[tuple[str, str]]:
    """Time and value of each line; a line whose first field isn't a number is a header."""
    time, value = COLUMNS[kind]
    split = (x.strip("\r").split(",") for x in lines)
    return [(x[time], x[value]) for x in split if x[0].strip().replace(".", "", 1).isdigit()]


def nanoseconds(text: str, asset: str) -> int | None:
    try:
        t = int(text)
    except ValueError:
        return None
    return t * 1_000_000 if asset == "HYPE" or t < MICROS_FROM else t * 1_000


class Archive(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths, self.asset, self.kind = json.loads(options["paths"]), options["asset"], options["kind"]
        self.sha256, self.most = options.get("sha256"), int(options["most"])
        self.low, self.high = -(1 << 63), (1 << 63) - 1

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Bounds of the time; Spark applies all filters once more, so these may be rough."""
        for f in filters:
            if getattr(f, "attribute", None) == ("source_ts_ns",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value)
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    self.high = min(self.high, f.value)
            yield f

    def partitions(self) -> list[Archive]:
        return [Archive(p) for p in self.paths]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        fs, path = chunks.of(partition.value)
        digest, _ = chunks.digest(fs, path)
        if self.sha256 and digest != self.sha256.lower():
            raise ValueError(f"the checksum of {partition.value} is {digest}")
        with fs.open_input_file(path) as archive:
            for lines in lines_of(archive, self.most):
                rows = [(nanoseconds(t, self.asset), v) for t, v in fields(lines, self.kind)]
                rows = [x for x in rows if x[0] is None or self.low <= x[0] <= self.high]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.string()), pa.array([partition.value] * len(rows), pa.string()), pa.array([digest] * len(rows), pa.string())],
                    names=["source_ts_ns", "v", "path", "sha"],
                )


class PriceArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gridfold_prices"

    def schema(self) -> str:
        return "source_ts_ns long, v string, path string, sha string"

    def reader(self, schema: Any) -> _Reader:
        return _Reader(dict(self.options))


def read_zips(spark: SparkSession, path: str, asset: str, kind: str, sha256: str | None = None, most: int = 1 << 30) -> DataFrame:
    """The table ``underlying`` from zipped CSV files at a path or pattern. Lines whose first field isn't a number are headers."""
    if kind not in COLUMNS:
        raise ValueError(f"no such kind of prices: {kind}")
    paths = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # a name an archive
    spark.dataSource.register(PriceArchives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"paths": json.dumps(paths), "asset": asset, "kind": kind, "most": str(most)} | ({"sha256": sha256} if sha256 is not None else {})
    return _published(spark.read.format(PriceArchives.name()).options(**options).load(), asset, kind)


def from_archives(files: DataFrame, asset: str, kind: str, sha256: str | None = None, most: int = 1 << 30) -> DataFrame:
    """The same from path and content of the archives."""
    if kind not in COLUMNS:
        raise ValueError(f"no such kind of prices: {kind}")

    def run(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in files:
            for where, content in zip(pdf["path"], pdf["content"], strict=True):
                digest = hashlib.sha256(content).hexdigest()
                if sha256 is not None and digest != sha256.lower():
                    raise ValueError(f"the checksum of {where} is {digest}")
                for lines in lines_of(io.BytesIO(content), most):
                    rows = fields(lines, kind)
                    yield pd.DataFrame({"source_ts_ns": pd.array([nanoseconds(t, asset) for t, _ in rows], "Int64"), "v": [v for _, v in rows], "path": where, "sha": digest})

    return _published(files.mapInPandas(run, "source_ts_ns long, v string, path string, sha string"), asset, kind)


def _published(raw: DataFrame, asset: str, kind: str) -> DataFrame:
    symbol, instrument = SYMBOLS[asset]
    v = F.col("v").try_cast("decimal(24,8)")
    checked = F.when(v > 0, v).otherwise(F.raise_error(F.lit("a price is no positive number")))
    return raw.select(
        F.lit(asset).alias("asset"), F.lit("binance").alias("venue"), F.lit(instrument).alias("instrument_type"), F.lit(symbol).alias("symbol"),
        F.lit(kind).alias("observation_kind"), "source_ts_ns", F.lit(None).cast("long").alias("receive_ts_ns"), checked.alias("value"),
        F.col("path").alias("source_path"), F.col("sha").alias("source_sha256"), F.lit(False).alias("is_settlement"),
    )
