"""Order-book event archives: scan, selection, decoding, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold import schemas
from gridfold.functions.timefn import HOUR_NS, timestamp_ns
from gridfold.functions.values import apart, parsed_levels
from gridfold.operators.guards import require_cap
from gridfold.operators.joins import in_window, keep_ids


#: Markets that are pushed to the scan as a list.
FEW = 1_000


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """The archive's rows with file name and physical row index; columns that nobody asks for aren't read."""
    rows = spark.read.schema(schemas.source()).parquet(*paths)
    return rows.select("*", F.col("_metadata.file_name").alias("source_object"), F.col("_metadata.row_index").alias("source_row"))


def require_scannable(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` as they are; a file with more rows than ``most`` is an error, found from row numbers alone."""
    return require_cap(rows, ["source_object"], most)


def windows(markets: DataFrame, warm_up_ns: int = HOUR_NS) -> DataFrame:
    """condition_id, low_ns, high_ns: when a market's events are admitted."""
    return markets.select("condition_id", (F.col("market_start_ns") - warm_up_ns).alias("low_ns"), F.col("market_end_ns").alias("high_ns"))


def tokens_of(markets: DataFrame) -> DataFrame:
    return markets.select(F.explode(F.array("token_up", "token_down")).alias("token_id"))


def of_objects(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """Rows of some source objects. Up to ``FEW`` names go to the scan, which then opens no other file."""
    names = [r[0] for r in objects.select("source_object").limit(FEW + 1).collect()]
    if len(names) <= FEW:
        return rows.where(F.col("source_object").isin(names))
    return keep_ids(rows, objects, ["source_object"])


def select_rows(rows: DataFrame, markets: DataFrame, compat_float_ns: bool = False, tokens: DataFrame | None = None) -> DataFrame:
    """Rows of the markets' conditions and tokens that are received within their market's window.

    Conditions and tokens are filtered independently; ``tokens`` (token_id) stands for the markets' own. Everything is filtered before anything is decoded:
    malformed rows elsewhere do no harm. The outermost times and market ids, which the driver works out
    from the market table, are pushed to the scan, where they skip row groups by their statistics (ids as
    the bytes that files hold); up to ``FEW`` markets are pushed one by one. The exact window comes with
    the join."""
    bounds = windows(markets)
    ends = (F.min("low_ns").alias("low"), F.max("high_ns").alias("high"), F.min("condition_id").alias("first"), F.max("condition_id").alias("last"))
    outer = bounds.agg(*ends, F.count("*").alias("n")).first()
    if outer["low"] is None:
        return rows.where(F.lit(False)).withColumns({"condition_id": F.lit(None).cast("string"), "receive_ts_ns": F.lit(None).cast("long")})
    at = lambda ns: F.timestamp_micros(F.lit(ns // 1_000))
    received = F.when(F.col("timestamp_received").isNull(), F.raise_error(F.lit("an event has no receive time"))).otherwise(F.col("timestamp_received"))
    inside = rows.where(F.col("timestamp_received").isNull() | (F.col("timestamp_received") >= at(outer["low"])) & (F.col("timestamp_received") < at(outer["high"])))
    if outer["n"] <= FEW:
        inside = inside.where(F.col("market").isin([r[0].encode() for r in markets.select("condition_id").distinct().collect()]))
    else:
        inside = inside.where((F.col("market") >= F.lit(outer["first"].encode())) & (F.col("market") <= F.lit(outer["last"].encode())))
    tokens = tokens_of(markets) if tokens is None else tokens
    named = keep_ids(inside.withColumn("condition_id", F.decode("market", "UTF-8")), markets.select("condition_id"), ["condition_id"])
    named = keep_ids(named, tokens.select(F.col("token_id").alias("asset_id")), ["asset_id"]).withColumn("receive_ts_ns", timestamp_ns(received, compat_float_ns))
    return in_window(named, bounds, "condition_id", "receive_ts_ns", "low_ns", "high_ns")


def decode(rows: DataFrame, compat_float_ns: bool = False) -> DataFrame:
    """Events with typed depth, and ``error``: what is wrong with the row, or null."""
    kind = F.lit(None).cast("string")
    for raw, name in schemas.EVENT_TYPES.items():
        kind = F.when(F.col("gf_raw_type") == raw, F.lit(name)).otherwise(kind)
    typed = rows.withColumnRenamed("event_type", "gf_raw_type").withColumn("event_type", kind)
    is_book = F.col("event_type") == "BOOK"
    # Worked out as one column a side, so that depth is parsed once for both its levels and its error.
    parsed = typed.withColumns({f"gf_{side}": F.when(is_book, parsed_levels(F.col(side), side)) for side in ("bids", "asks")})
    events = parsed.withColumns(
        {
            "token_id": F.col("asset_id"),
            "source_ts_ns": timestamp_ns(F.col("timestamp"), compat_float_ns),
            "depth_error": F.coalesce("gf_bids.error", "gf_asks.error"),
            "bids": F.col("gf_bids.levels"),
            "asks": F.col("gf_asks.levels"),
            "transaction_hash": F.when(F.col("transaction_hash") != "", F.col("transaction_hash")),
            "source_id": F.lit("archive"),
        }
    )
    return apart(events.withColumn("error", shape_error()).drop("gf_raw_type", "gf_bids", "gf_asks", "depth_error", "market", "asset_id", "timestamp", "timestamp_received"))


def shape_error() -> Column:
    """Per event type, what a row lacks."""
    change, trade, tick = (F.col("event_type") == t for t in ("PRICE_CHANGE", "LAST_TRADE_PRICE", "TICK_SIZE_CHANGE"))
    null = lambda *names: F.greatest(*[F.col(c).isNull().cast("int") for c in (*names, names[0])]) == 1
    return (
        F.when(F.col("event_type").isNull() | F.col("source_ts_ns").isNull(), "no known event or no source time")
        .when(~F.col("condition_id").startswith("0x") | ~F.col("token_id").rlike("^[0-9]+$"), "no market or token id")
        .when((F.col("receive_ts_ns") < 0) | (F.col("source_ts_ns") < 0), "a time before 1970")
        .when(F.col("depth_error").isNotNull(), F.col("depth_error"))
        .when(change & (~F.coalesce(F.col("side").isin("BUY", "SELL"), F.lit(False)) | null("price", "size")), "a price change lacks its side, price or size")
        .when(change & (F.col("size") < 0), "a size is negative")
        .when(change & ~F.col("price").between(0, 1), "a price is beyond its bounds")
        .when(trade & null("price", "size"), "a trade lacks its price or size")
        .when(tick & null("old_tick_size", "new_tick_size"), "a tick change lacks a size")
        .when(tick & ((F.col("old_tick_size") <= 0) | (F.col("new_tick_size") <= 0)), "a tick is not positive")
    )


def strict(events: DataFrame) -> DataFrame:
    """The events without ``error``; any error ends the job."""
    text = F.concat_ws(" ", "error", F.lit("at"), "source_object", F.col("source_row").cast("string"))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(text)).otherwise(F.col("condition_id"))
    return events.withColumn("condition_id", checked).drop("error")


def split(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good events, and a quarantine of the others."""
    return events.where("error IS NULL").drop("error"), events.where("error IS NOT NULL")


