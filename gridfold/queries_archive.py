"""Queries over archives, markets and books that are made of the driver's tables, and their SQL.

The SQL says from the same rows what must come out; it parses no JSON and calls no operator."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold import schemas
from gridfold.functions import identity, timefn, values
from gridfold.operators import forensics, joins, order, quality
from gridfold.registry import query, read
from gridfold.sources import events as source
from gridfold.sources import markets as market_source
from gridfold.sources import prices, staging

#: 2024-01-01 in seconds since 1970.
DAY_S = 1_704_067_200


def pick(number: Column, *choices: Column | str | None) -> Column:
    """The choice of a number from 0 on."""
    out = F.lit(None)
    for i, x in reversed(list(enumerate(choices))):
        out = F.when(number == i, F.lit(x) if not isinstance(x, Column) else x).otherwise(out)
    return out


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive rows made of events: five markets, a user is a token, faults by the event's number."""
    e = read(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    kind = pick(F.col("event_id") % 8, "book", "book", "price_change", "price_change", "price_change", "last_trade_price", "tick_size_change", "noise")
    is_ = lambda *kinds: kind.isin(*kinds)
    good = F.when(F.col("event_id") % 16 < 8, F.format_string('[["0.35","2"],["0.40","%d"]]', F.col("event_id") % 9 + 1)).otherwise(F.format_string('[{"price":"0.40","size":"%d"},{"price":"0.35","size":"2"}]', F.col("event_id") % 9 + 1))
    bids = pick(F.col("event_id") % 7, None, '[["0.4","0"]]', '[["0.4","1"],["0.40","2"]]', "{}", '[["0.45678","1"]]', good, good)
    money = lambda text, type_: text.cast(type_)
    cents = F.when(F.col("event_id") % 17 == 0, 150).otherwise(F.col("event_id") % 90 + 5)
    columns = {
        "timestamp_received": F.col("at"),
        "timestamp": F.timestamp_micros(F.unix_micros("at") - F.col("event_id") % 50 * 1_000),
        "market": F.encode(F.concat(F.lit("0x"), F.lpad((F.col("user_id") % 5).cast("string"), 64, "0")), "UTF-8"),
        "event_type": kind,
        "asset_id": F.col("user_id").cast("string"),
        "bids": F.when(is_("book"), bids),
        "asks": F.when(is_("book"), F.lit('[["0.60","3"]]')),
        "price": F.when(is_("price_change", "last_trade_price"), money(cents / 100, schemas.PRICE)),
        "size": F.when(is_("price_change", "last_trade_price"), money(F.when(is_("last_trade_price") & (F.col("event_id") % 3 == 0), None).when(F.col("event_id") % 13 == 0, -1).otherwise(F.col("event_id") % 20), schemas.SIZE)),
        "side": F.when(is_("price_change"), F.when(F.col("event_id") % 11 == 0, "HOLD").when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL")),
        "best_bid": F.lit(None).cast(schemas.PRICE),
        "best_ask": F.lit(None).cast(schemas.PRICE),
        "fee_rate_bps": F.lit(None).cast("int"),
        "transaction_hash": F.when(is_("last_trade_price"), F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("0x"), F.col("event_id").cast("string"))).otherwise("")),
        "old_tick_size": F.when(is_("tick_size_change"), money(F.lit("0.01"), schemas.PRICE)),
        "new_tick_size": F.when(is_("tick_size_change"), money(F.when(F.col("event_id") % 5 == 0, 0).otherwise(0.001), schemas.PRICE)),
    }
    typed = [columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.source()]
    return e.select(*typed, F.lit("events").alias("source_object"), F.col("event_id").alias("source_row"))


def markets(spark: SparkSession) -> DataFrame:
    """Three markets of ten days; the tokens of the third belong to the second."""
    row = lambda i, up, down: ("0x" + str(i).rjust(64, "0"), str(up), str(down), (DAY_S + 86_400 * i) * 10**9, (DAY_S + 86_400 * (i + 10)) * 10**9)
    return spark.createDataFrame([row(0, 5, 10), row(1, 6, 11), row(2, 16, 21)], "condition_id string, token_up string, token_down string, market_start_ns long, market_end_ns long")


#: The archive's rows within the markets' windows: event_id, user_id, condition number, times and kind.
_SELECTED = f"""WITH w(c, low, high) AS (SELECT c, {DAY_S} + 86400 * c - 3600, {DAY_S} + 86400 * (c + 10) FROM range(3) t(c)),
s AS (SELECT event_id AS e, user_id AS u, user_id % 5 AS c, epoch_us(ts) AS us, event_id % 8 AS k, event_id % 7 AS b FROM events
  JOIN w ON user_id % 5 = w.c AND epoch_us(ts) >= low * 1000000 AND epoch_us(ts) < high * 1000000 WHERE user_id IN (5, 10, 6, 11, 16, 21))
"""
_ERROR = """CASE WHEN k = 7 THEN 'no known event or no source time' WHEN k <= 1 THEN CASE b WHEN 0 THEN 'no bids in a snapshot' WHEN 1 THEN 'a snapshot has a level of size 0'
  WHEN 2 THEN 'a snapshot has a price twice' WHEN 3 THEN 'bids are no JSON array' WHEN 4 THEN 'a level is no decimal of this type' END
WHEN k <= 4 THEN CASE WHEN e % 11 = 0 THEN 'a price change lacks its side, price or size' WHEN e % 13 = 0 THEN 'a size is negative' WHEN e % 17 = 0 THEN 'a price is beyond its bounds' END
WHEN k = 5 THEN CASE WHEN e % 3 = 0 THEN 'a trade lacks its price or size' END WHEN k = 6 THEN CASE WHEN e % 5 = 0 THEN 'a tick is not positive' END END"""
_KIND = "CASE WHEN k <= 1 THEN 'BOOK' WHEN k <= 4 THEN 'PRICE_CHANGE' WHEN k = 5 THEN 'LAST_TRADE_PRICE' WHEN k = 6 THEN 'TICK_SIZE_CHANGE' END"


@query(_SELECTED + "SELECT e AS source_row, '0x' || lpad(CAST(c AS VARCHAR), 64, '0') AS condition_id, us * 1000 AS receive_ts_ns FROM s")
def archive_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.select_rows(archive(spark, sf_dir), markets(spark)).select("source_row", "condition_id", "receive_ts_ns")


@query(
    _SELECTED
    + f"""SELECT e AS source_row, {_KIND} AS event_type, CAST(u AS VARCHAR) AS token_id, us * 1000 - e % 50 * 1000000 AS source_ts_ns, {_ERROR} AS error,
  CASE WHEN k <= 1 AND b >= 5 THEN 4000 END AS best_bid, CASE WHEN k <= 1 AND b >= 5 THEN e % 9 + 3 END AS bid_size, CASE WHEN k = 5 AND e % 2 = 1 THEN '0x' || e END AS transaction_hash FROM s"""
)
def archive_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = source.decode(source.select_rows(archive(spark, sf_dir), markets(spark)))
    total = F.aggregate("bids", F.lit(0).cast("decimal(38,6)"), lambda n, x: (n + x["size"]).cast("decimal(38,6)")).cast("long")
    best = (F.get("bids.price", F.lit(0)) * 10_000).cast("long")
    return events.select("source_row", "event_type", "token_id", "source_ts_ns", "error", best.alias("best_bid"), total.alias("bid_size"), "transaction_hash")


@query(_SELECTED + f"SELECT count(*) FILTER (fault IS NULL) AS good, count(fault) AS bad FROM (SELECT {_ERROR} AS fault FROM s)")
def archive_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = source.split(source.decode(source.select_rows(archive(spark, sf_dir), markets(spark))))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(good, "good").join(F.broadcast(count(bad, "bad")))  # one row each


@query(
    _SELECTED
    + f""", good AS (SELECT * FROM s WHERE {_ERROR} IS NULL), d AS (SELECT *, 'events' AS o FROM good UNION ALL SELECT *, 'again' FROM good WHERE e % 3 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY o) AS copy FROM d)
SELECT e AS source_row, o AS source_object, row_number() OVER (PARTITION BY c ORDER BY CAST(u AS VARCHAR), us, us - e % 50 * 1000, o, e) - 1 AS sequence FROM n WHERE copy = 1"""
)
def archive_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second object repeats every third event; the object first by name is kept."""
    events = source.decode(source.select_rows(archive(spark, sf_dir), markets(spark))).where("error IS NULL")
    again = events.where("source_row % 3 = 0").withColumn("source_object", F.lit("again"))
    return order.order_events(source.strict(events.unionByName(again))).select("source_row", "source_object", "sequence")


@query(_SELECTED + f"SELECT CAST(u AS VARCHAR) AS token_id, {_KIND} AS event_type, count(*) AS rows, min(us) * 1000 AS first_receive_ns FROM s WHERE {_ERROR} IS NULL GROUP BY ALL")
def event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = source.decode(source.select_rows(archive(spark, sf_dir), markets(spark))).where("error IS NULL")
    return forensics.profile(events).select("token_id", "event_type", "rows", "first_receive_ns")


@query(
    _SELECTED
    + f""", t AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY us, e) AS i, us = median(us) OVER (PARTITION BY u) AS hit FROM s WHERE {_ERROR} IS NULL),
m AS (SELECT u, i FROM t QUALIFY row_number() OVER (PARTITION BY u ORDER BY us DESC, e DESC) = 1)
SELECT t.e AS source_row, CASE WHEN k IN (2, 3, 4) THEN CAST(e % 20 AS DECIMAL(18,6)) :: VARCHAR WHEN k = 5 THEN CAST(CASE WHEN e % 13 = 0 THEN -1 ELSE e % 20 END AS DECIMAL(18,6)) :: VARCHAR END AS size
FROM t JOIN m ON m.u = t.u WHERE t.i >= m.i - 2"""
)
def conflict_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each token and the two before it, decimals as text."""
    events = order.order_events(source.decode(source.select_rows(archive(spark, sf_dir), markets(spark))).where("error IS NULL"))
    last = events.groupBy("token_id").agg(F.max("receive_ts_ns").alias("last"), F.max("sequence").alias("end"))
    near = forensics.neighbours(events.join(last, "token_id"), ["condition_id", "token_id"], ["sequence"], F.col("sequence") == F.col("end"), 2)
    return near.select("source_row", values.decimals_as_text(F.col("size"), near.schema["size"].dataType).alias("size"))


@query("SELECT e.event_id, CASE user_id % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' ELSE 'SOL' END AS asset FROM events e")
def owned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("condition_id", (F.col("user_id") % 3).cast("string"))
    owners = spark.createDataFrame([("0", "BTC"), ("1", "ETH"), ("2", "SOL")], "condition_id string, asset string")
    return joins.owned(e, owners, "condition_id", "asset").select("event_id", "asset")


@query("SELECT event_id, CASE WHEN user_id % 4 < 2 THEN 'BTC' ELSE 'ETH' END AS asset FROM events WHERE (user_id % 4 < 2 AND event_id % 6 IN (0, 1)) OR (user_id % 4 >= 2 AND event_id % 6 IN (2, 3))")
def asset_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens are tied to the asset that the condition belongs to."""
    e = read(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).cast("string").alias("condition_id"), (F.col("event_id") % 6).cast("string").alias("token_id"))
    owned = spark.createDataFrame([("BTC", "0", "0", "1"), ("BTC", "1", "1", "0"), ("ETH", "2", "2", "3"), ("ETH", "3", "3", "2")], "asset string, condition_id string, token_up string, token_down string")
    return joins.keep_owned_tokens(e, owned).select("event_id", "asset")


@query(
    """SELECT o_orderkey, o_orderkey * 1000000000 AS s, o_orderkey * 1000000 AS ms, o_orderkey * 1000 AS us, epoch_us(o_orderdate) * 1000 + o_orderkey % 1000000 * 1000 AS iso,
  CASE WHEN o_orderkey % 3 = 0 THEN epoch_us(o_orderdate) * 1000 END AS utc, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(o_orderkey % 1000000000 AS VARCHAR), 9, '0') || 'Z' AS text,
  epoch_us(date_trunc('day', o_orderdate)) * 1000 + o_orderkey % 24 * 3600000000000 AS hour FROM orders"""
)
def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of all units, ISO text to nanoseconds and back, text that must be UTC, hours in file names."""
    o = read(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    k, stamp = F.col("o_orderkey"), "yyyy-MM-dd'T'HH:mm:ss"
    iso = F.concat(F.date_format("at", stamp), F.lit("."), F.lpad((k % 1_000_000).cast("string"), 6, "0"), pick(k % 3, "Z", "+00:00", "+0000"))
    other = F.concat(F.date_format("at", stamp), pick(k % 3, "Z", "+01:00", ""))
    name = F.concat(F.lit("book_"), F.date_format("at", "yyyy-MM-dd'T'"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(".parquet"))
    units = [timefn.epoch_to_ns(k, u).alias(u) for u in ("s", "ms", "us")]
    ns = F.unix_seconds("at") * 10**9 + k % 10**9
    return o.select("o_orderkey", *units, timefn.iso_to_ns(iso).alias("iso"), timefn.utc_to_ns(other).alias("utc"), timefn.ns_to_iso(ns).alias("text"), timefn.file_hour_ns(name).alias("hour"))


@query("SELECT event_id, epoch_us(ts) * 1000 AS exact, CAST(CAST(epoch_us(ts) AS DOUBLE) / 1e6 * 1e9 AS DECIMAL(20, 0)) :: BIGINT AS by_float FROM events")
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select("event_id", timefn.timestamp_ns(at).alias("exact"), timefn.timestamp_ns(at, compat_float_ns=True).alias("by_float"))


@query(
    """WITH o AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) * 100 AS top, sum(l_quantity) AS size, count(*) <> count(DISTINCT l_linenumber) AS twice FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN NOT twice THEN n END AS n, CASE WHEN NOT twice THEN CAST(top AS BIGINT) END AS top, CASE WHEN NOT twice THEN CAST(size AS BIGINT) END AS size,
  CASE WHEN l_orderkey % 5 = 0 THEN 'a snapshot has a price twice' WHEN l_orderkey % 7 = 0 THEN 'a level of asks is no pair' WHEN twice THEN 'a snapshot has a price twice' END AS fault FROM o"""
)
def depth_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth as JSON made of an order's lines, in both spellings and with faults; parsed again."""
    li = read(spark, sf_dir, "lineitem")
    pair = F.format_string('["0.0%d","%d"]', F.col("l_linenumber").cast("int"), F.col("l_quantity").cast("int"))
    thing = F.format_string('{"size":"%d","price":"0.0%d"}', F.col("l_quantity").cast("int"), F.col("l_linenumber").cast("int"))
    of = lambda x: F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(x)), ","), F.lit("]"))
    text = li.groupBy("l_orderkey").agg(of(pair).alias("pairs"), of(thing).alias("things"), F.min(pair).alias("one"))
    k = F.col("l_orderkey")
    good = F.when(k % 2 == 0, F.col("pairs")).otherwise(F.col("things"))
    twice = F.concat(F.left("pairs", F.length("pairs") - 1), F.lit(","), F.col("one"), F.lit("]"))
    long = F.lit('[["0.1","1","1"]]')
    asks, fault = values.levels(F.when(k % 5 == 0, twice).when(k % 7 == 0, long).otherwise(good), "asks")
    bids, _ = values.levels(good, "bids")
    total = F.aggregate(bids, F.lit(0).cast("decimal(38,6)"), lambda n, x: (n + x["size"]).cast("decimal(38,6)")).cast("long")
    top = (F.get(bids["price"], F.lit(0)) * 10_000).cast("long")
    checked = F.when(asks.isNotNull() == fault.isNull(), fault).otherwise(F.lit("both levels and a fault"))
    return text.select("l_orderkey", F.when(bids.isNotNull(), F.size(bids)).cast("long").alias("n"), top.alias("top"), total.alias("size"), checked.alias("fault"))


@query(
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' WHEN 2 THEN 'SPLIT' END AS outcome, CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE 2 END AS n FROM customer"""
)
def official_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = pick(F.col("c_custkey") % 5, '["1","0"]', '["0","1.0"]', '["0.5", "0.50"]', '["0.7","0.3"]', None)
    listed = values.json_list(text.cast("string"))
    n = F.when(listed.isNotNull(), F.size(listed)).cast("long")
    return read(spark, sf_dir, "customer").select("c_custkey", identity.outcome(listed).alias("outcome"), n.alias("n"))


_ASSET = "CASE c_custkey % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'DOGE' ELSE 'HYPE' END"


def asset(number: Column) -> Column:
    return pick(number % 3, "BTC", "DOGE", "HYPE")


@query(
    f"""SELECT c_custkey, CASE WHEN c_custkey // 3 % 5 IN (0, 1) THEN CASE WHEN c_custkey % 3 = 2 THEN 'https://www.binance.com/en/futures/HYPEUSDT' ELSE 'https://www.binance.com/en/trade/' || {_ASSET} || '_USDT' END END AS page FROM customer"""
)
def bound_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that name the candle and its page; or the page of another asset, no candle, or a longer word."""
    c = read(spark, sf_dir, "customer").withColumn("asset", asset(F.col("c_custkey")))
    way = F.expr("c_custkey div 3") % 5
    page = F.when(F.col("asset") == "HYPE", "https://www.binance.com/en/futures/HYPEUSDT").otherwise(F.concat(F.lit("https://www.binance.com/en/trade/"), F.col("asset"), F.lit("_USDT")))
    name = pick(F.col("c_custkey") % 3, "Bitcoin", "DOGE", "Hyperliquid")
    whole = F.concat(F.lit("Price of "), name, F.lit(" by the Binance 1 hour candle of "), F.col("asset"), F.lit("/USDT."))
    none = F.concat(F.lit("Binance 1 hour candle of x"), F.col("asset"), F.lit("/USDT"))  # the asset is only part of a word
    rules = pick(way, whole, whole, whole, F.lit("Bitcoin, DOGE, Hyperliquid on Binance"), none)
    url = F.when(way == 1, F.concat(F.lit(" "), page, F.lit("/"))).when(way == 2, "https://www.binance.com/en/trade/ETH_USDT").otherwise(page)
    return c.select("c_custkey", identity.bound_source(F.col("asset"), rules, url).alias("page"))


def payloads(spark: SparkSession, sf_dir: str, ways: tuple[int, ...] = tuple(range(12))) -> DataFrame:
    """Market payloads made of orders, with one thing wrong in some (0 and 11: nothing), by the order's number.

    Every fourth hour of the day in UTC; an hour that a clock shows twice isn't among them."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start = F.timestamp_seconds(F.lit(DAY_S) + k * 14_400)
    end = F.date_format(start + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    way = F.get(F.array(*map(F.lit, ways)), (k % len(ways)).cast("int"))
    m = F.struct(
        F.when(way == 9, "").otherwise(F.concat(F.lit("m"), k.cast("string"))).alias("id"),
        F.when(way == 1, "bitcoin-up").otherwise(identity.hourly_slug(F.lit("BTC"), start)).alias("slug"),
        F.when(way == 2, "0x1").otherwise(F.concat(F.lit("0x"), F.lpad(k.cast("string"), 64, "0"))).alias("conditionId"),
        F.when(way == 3, '["Down","Up"]').otherwise('["Up","Down"]').alias("outcomes"),
        F.when(way == 4, None).otherwise(F.concat(F.lit('["'), (k * 2).cast("string"), F.lit('","'), (k * 2 + 1).cast("string"), F.lit('"]'))).alias("clobTokenIds"),
        (way != 5).alias("closed"),
        F.when(way == 6, '["0.6","0.4"]').when(k % 24 < 12, '["1","0"]').otherwise('["0","1"]').alias("outcomePrices"),
        F.when(way == 7, "2020-01-01T00:00:00Z").otherwise(end).alias("endDate"),
        F.lit("https://www.binance.com/en/trade/BTC_USDT").alias("resolutionSource"),
        F.when(way == 8, "").otherwise("Up if greater than or equal, otherwise Down: Binance 1 hour candle BTC/USDT").alias("description"),
    )
    event = F.struct(F.concat(F.lit("e"), k.cast("string")).alias("id"), F.array_repeat(m, F.when(way == 10, 2).otherwise(1)).alias("markets"))
    return o.select("o_orderkey", start.alias("start"), F.to_json(F.array(event)).alias("payload"))


_DISPOSITION = """CASE o_orderkey % 12 WHEN 10 THEN 'error: not so: an event has one market' WHEN 1 THEN 'error: not so: the slug is canonical' WHEN 7 THEN 'error: not so: the end is an hour after the slug''s start'
WHEN 3 THEN 'error: not so: the outcomes are Up and Down' WHEN 2 THEN 'error: not so: the condition id is 64 hexadecimal digits' WHEN 8 THEN 'error: not so: there are rules' WHEN 9 THEN 'error: not so: both ids are given'
WHEN 4 THEN 'gap' WHEN 5 THEN 'unresolved' WHEN 6 THEN 'unresolved' ELSE 'ok' END"""


@query(
    f"""SELECT 'e' || o_orderkey AS event_id, {_DISPOSITION} AS disposition, CASE WHEN o_orderkey % 12 NOT IN (1, 10) THEN ({DAY_S} + o_orderkey * 14400) * 1000000000 END AS start_ns,
  CASE WHEN o_orderkey % 12 NOT IN (4) THEN CAST(o_orderkey * 2 AS VARCHAR) END AS token_up, CASE WHEN o_orderkey % 12 <> 6 THEN CASE WHEN o_orderkey % 24 < 12 THEN 'UP' ELSE 'DOWN' END END AS outcome FROM orders WHERE o_orderkey % 12 <> 10
UNION ALL SELECT 'e' || o_orderkey, {_DISPOSITION}, ({DAY_S} + o_orderkey * 14400) * 1000000000, CAST(o_orderkey * 2 AS VARCHAR), CASE WHEN o_orderkey % 24 < 12 THEN 'UP' ELSE 'DOWN' END FROM orders WHERE o_orderkey % 12 = 10"""
)
def market_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = market_source.bind(payloads(spark, sf_dir).select("payload"))
    return bound.select("event_id", "disposition", F.col("market_start_ns").alias("start_ns"), "token_up", F.col("official_outcome").alias("outcome"))


@query("SELECT '0x' || lpad(CAST(o_orderkey AS VARCHAR), 64, '0') AS condition_id FROM orders WHERE o_orderkey % 3 = 0")
def payload_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each third payload comes a second time with other rules; all others come again with their keys turned round."""
    p = payloads(spark, sf_dir, (0,))
    other = F.regexp_replace("payload", '"description":"[^"]*"', '"description":"other rules"')
    turned = F.regexp_replace("payload", r'^\[\{"id":"(e[0-9]+)","markets":(.*)\}\]$', r'[{"markets":$2, "id":"$1"}]')
    again = p.select(F.when(F.col("o_orderkey") % 3 == 0, other).otherwise(turned).alias("payload"))
    return market_source.conflicts(p.select("payload").unionByName(again))


@query("SELECT '0x' || lpad(CAST(o_orderkey AS VARCHAR), 64, '0') AS condition_id, 'm' || o_orderkey AS market_id FROM orders WHERE o_orderkey % 3 < 2")
def merged_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that come twice are one market; every third is not settled."""
    p = payloads(spark, sf_dir, (0, 11, 5)).select("payload")
    return market_source.merged(p.unionByName(p)).select("condition_id", "market_id")


@query(
    f"""WITH s AS (SELECT o_orderkey AS k, 'bitcoin-up-or-down-' || lower(strftime(timezone('America/New_York', timezone('UTC', make_timestamp(({DAY_S} + o_orderkey * 14400) * 1000000))), '%B-%-d-%Y-%-I%p')) || '-et' AS slug FROM orders)
SELECT CASE WHEN k % 60 = 0 THEN slug ELSE 'm' || k END AS market_id, CASE WHEN k % 60 = 0 THEN 'SOURCE_GAP' WHEN k % 4 = 1 THEN 'SOURCE_GAP' WHEN k % 4 >= 2 THEN 'UNRESOLVED_MARKET' ELSE 'accepted' END AS reason FROM s"""
)
def expected_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every expected start is a market or has a reason for being none; some have no payload."""
    p = payloads(spark, sf_dir, (0, 4, 5, 6))
    slots = p.select(F.lit("BTC").alias("asset"), "start")
    cached = p.where("o_orderkey % 60 <> 0").select(identity.hourly_slug(F.lit("BTC"), F.col("start")).alias("slug"), "payload")
    accepted, excluded = market_source.dispose(slots, cached)
    return accepted.select("market_id", F.lit("accepted").alias("reason")).unionByName(excluded.select("market_id", F.col("reason_code").alias("reason")))


@query(
    """SELECT c_custkey, sha256('{"asset":"BTC","condition_id":"' || c_custkey || '","event_id":"e","market_end_ns":' || c_custkey * 2 || ',"market_id":"m","market_start_ns":' || c_custkey || ',"official_outcome":"UP","official_resolution_ts_ns":null,'
  || '"resolution_source_url":"u","rules_text_sha256":"r","timeframe":"1h","token_down":"2","token_up":"1","venue":"clob"}') AS digest FROM customer"""
)
def market_authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    fixed = {"asset": "BTC", "event_id": "e", "market_id": "m", "official_outcome": "UP", "resolution_source_url": "u", "rules_text_sha256": "r", "timeframe": "1h", "token_down": "2", "token_up": "1", "venue": "clob"}
    market = {n: F.lit(v) for n, v in fixed.items()} | {"condition_id": k.cast("string"), "market_start_ns": k, "market_end_ns": k * 2, "official_resolution_ts_ns": F.lit(None).cast("long")}
    return read(spark, sf_dir, "customer").select("c_custkey", values.sha256(identity.authority(market)).alias("digest"))


@query(
    """WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'EVENT_CONFLICT' WHEN c_custkey % 13 = 0 THEN 'NO_INITIAL_SNAPSHOT' WHEN c_custkey % 7 = 0 THEN 'UNSUPPORTED_TIMEFRAME' WHEN c_custkey % 5 = 0 THEN 'UNRESOLVED_MARKET'
    WHEN c_custkey % 17 = 0 OR c_custkey % 3 = 0 THEN 'SOURCE_GAP' END AS r, CASE WHEN c_custkey % 5 = 0 THEN 'UNRESOLVED' ELSE 'UP' END AS o FROM customer)
SELECT 'm' || k AS market_id, r AS reason_code, CASE r WHEN 'EVENT_CONFLICT' THEN 'invalid market evidence: token 1 is wrong' WHEN 'NO_INITIAL_SNAPSHOT' THEN 'token 1 is wrong' WHEN 'UNSUPPORTED_TIMEFRAME' THEN 'only 1h is frozen'
  WHEN 'UNRESOLVED_MARKET' THEN 'official outcome unresolved' ELSE 'source fidelity cannot satisfy the frozen 1h tier' END AS detail,
'{"condition_id":"' || k || CASE WHEN r IN ('EVENT_CONFLICT', 'NO_INITIAL_SNAPSHOT') THEN '","market_evidence_sha256":"x"}' WHEN k % 3 = 0 THEN '","gap_count":2,"gap_intervals_ns":[[0,' || k || '],[5,' || k + 10 || ']],"gap_total_ns":' || k + k + 5
  || ',"market_evidence_sha256":"x","official_outcome":"' || o || '","resolution_source_url":"u"}' ELSE '","market_evidence_sha256":"x","official_outcome":"' || o || '","resolution_source_url":"u"}' END AS evidence_json FROM c WHERE r IS NOT NULL
UNION ALL SELECT 'm' || k, 'TIER_A', NULL, NULL FROM c WHERE r IS NULL"""
)
def market_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch of the classification: errors before time frame, outcome and gaps, with its evidence."""
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").withColumn("condition_id", k.cast("string"))
    of = {"market_id": F.concat(F.lit("m"), k.cast("string")), "condition_id": F.col("condition_id"), "timeframe": F.when(k % 7 == 0, "4h").otherwise("1h"), "official_outcome": F.when(k % 5 == 0, "UNRESOLVED").otherwise("UP"), "evidence_sha256": F.lit("x"), "resolution_source_url": F.lit("u")}
    market = c.select(*[of.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.table("markets")])
    error = lambda token: c.where((k % 11 == 0) | (k % 13 == 0)).select("condition_id", F.lit(token).alias("token_id"), F.when(k % 11 == 0, "EVENT_CONFLICT").otherwise("NO_INITIAL_SNAPSHOT").alias("error_kind"), F.concat(F.lit(f"token {token} is wrong")).alias("error"))
    gap = lambda token, low, high: c.where(k % 3 == 0).select("condition_id", F.lit(token).alias("token_id"), F.lit(low).cast("long").alias("gap_start"), high.alias("gap_end"))
    accepted, excluded = quality.classify(market, error("2").unionByName(error("1")), gap("2", 5, k + 10).unionByName(gap("1", 0, k)), c.where(k % 17 != 0))
    none = F.lit(None).cast("string")
    return excluded.unionByName(accepted.select("market_id", F.col("quality_tier").alias("reason_code"), none.alias("detail"), none.alias("evidence_json")))


@query("SELECT count(*) FILTER (event_id % 2 = 0) AS market_count, count(*) FILTER (event_id % 3 = 0) AS exclusion_count, count(*) AS sample_count, min(epoch_us(ts)) AS sample_min_ts_ns, max(epoch_us(ts)) AS sample_max_ts_ns FROM events")
def partition_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("grid_ts_ns", F.unix_micros(F.col("ts").cast("timestamp")))
    return quality.statistics(e.where(F.col("event_id") % 2 == 0), e.where(F.col("event_id") % 3 == 0), e)


@query("SELECT 'all' AS part, 'TIER_B' AS quality_tier UNION ALL SELECT 'good', 'TIER_A' UNION ALL SELECT 'none', 'EXCLUDED'")
def partition_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, "TIER_B").otherwise("TIER_A").alias("quality_tier"))
    parts = {"all": c, "good": c.where("c_custkey % 10 <> 0"), "none": c.where("c_custkey < 0")}
    return reduce(DataFrame.unionByName, [quality.tier(df).select(F.lit(name).alias("part"), "quality_tier") for name, df in parts.items()])


#: Lines of a price archive at most.
ARCHIVE_LINES = 10_000


@query(
    """SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'spot' ELSE 'usds_m_perpetual' END AS instrument_type, (1735689600000 + l_orderkey * 1000 + l_linenumber) * 1000000 AS source_ts_ns, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
FROM lineitem"""
)
def price_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zipped CSV files made of lines: trades in microseconds, klines in milliseconds below a header. A task's Arrow batch
    of lines is a file, so that files are as many as the lines need and none grows with them."""

    def zipped(header: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import io
            import zipfile

            for lines in (pdf["line"][i : i + ARCHIVE_LINES] for pdf in parts for i in range(0, len(pdf), ARCHIVE_LINES)):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("x.csv", header + "\n".join(lines) + "\n")
                yield pd.DataFrame({"path": [f"{zlib.crc32(out.getvalue()):08x}.zip"], "content": [out.getvalue()]})

        return run

    li = read(spark, sf_dir, "lineitem").withColumn("ms", F.lit(1_735_689_600_000) + F.col("l_orderkey") * 1_000 + F.col("l_linenumber"))
    price = F.format_string("%.2f", "l_extendedprice")
    trade = F.concat_ws(",", F.lit("1"), price, F.lit("2"), F.lit("2"), (F.col("ms") * 1_000).cast("string"), F.lit("False"))
    kline = F.concat_ws(",", F.col("ms").cast("string"), F.lit("1"), F.lit("2"), F.lit("1"), price)
    files = lambda odd, line, header: li.where(F.col("l_orderkey") % 2 == odd).select(line.alias("line")).mapInPandas(zipped(header), "path string, content binary")
    trades = prices.from_archives(files(0, trade, ""), "BTC", "trades")
    both = files(1, kline, "open_time,open,high,low,close\n")
    every = trades.unionByName(prices.from_archives(both, "HYPE", "klines"))
    return every.select("instrument_type", "source_ts_ns", (F.col("value") * 100).cast("long").alias("cents"))


@query("SELECT 'c' || user_id AS condition, 's' || event_id % 4 AS source, event_id AS source_row FROM events WHERE event_id % 4 <> 3")
def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that name conditions and sources by number; of committed sources only, with their names again."""
    e = read(spark, sf_dir, "events").select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("condition"), F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string")).alias("source"), F.col("event_id").alias("source_row"))
    sources = staging.numbered(e.where(F.col("source") != "s3"), "source")
    rows = staging.committed(staging.encoded(e), sources.unionByName(sources))
    return staging.resolved(rows, staging.numbered(e, "condition"), sources).select("condition", "source", "source_row")


@query("SELECT l_orderkey AS source_row, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_suppkey % 3 HAVING count(*) > 1")
def staged_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(F.lit("c").alias("condition"), (F.col("l_suppkey") % 3).cast("string").alias("source"), F.col("l_orderkey").alias("source_row"))
    return staging.repeated(staging.encoded(li)).select("source_row", "rows")
