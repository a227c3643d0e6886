"""Queries over plans, inventories, caps and receipts that are made of the driver's tables, and their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold import lineage, schemas
from gridfold.functions import values
from gridfold.operators import audit, guards, joins, quality
from gridfold.plans import calendar, reconcile, segments
from gridfold.registry import query, read
from gridfold.sources import catalogue
from gridfold.sources import events as source

_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"
_ASSETS = "(VALUES ('BTC'), ('ETH'), ('SOL'), ('XRP'), ('DOGE'), ('BNB'), ('HYPE')) t(a)"


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))


@query(f"SELECT a || '/1h/' || strftime(d, '%Y-%m-%d') AS partition_id, 'g-' || strftime(d, '%Y-%m') || CASE WHEN day(d) <= 15 THEN '-a' ELSE '-b' END AS release_group FROM {_ASSETS}, ({_DAYS})")
def backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan of the days that have orders."""
    return calendar.plan_of(order_days(spark, sf_dir), "g-").select("partition_id", "release_group")


@query(f"SELECT strftime(d, '%Y-%m-%d') AS day, 'BNB,BTC,DOGE,ETH,HYPE,SOL,XRP' AS assets FROM ({_DAYS})")
def assets_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.assets_by_day(calendar.plan_of(order_days(spark, sf_dir), "g-")).select("day", F.array_join("assets", ",").alias("assets"))


#: Of each user's events the time from the first to the last.
_SPANS = "SELECT user_id, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events WHERE user_id % 10 = 3 GROUP BY user_id"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").where("user_id % 10 = 3").groupBy("user_id").agg((F.min(us) * 1_000).alias("start_ns"), (F.max(us) * 1_000 + 1).alias("end_ns"))


@query(f"SELECT DISTINCT 'x_' || strftime(make_timestamp(h * 3600000000), '%Y-%m-%dT%H') || '.parquet' AS name FROM ({_SPANS}), range(a // 3600000000, b // 3600000000 + 1) t(h)")
def source_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly objects that cover what some users did."""
    return calendar.hours_covering(spans(spark, sf_dir), "x_").select("name")


@query("SELECT user_id, (max(epoch_us(ts)) // 3600000000 - k) * 3600 AS start_s FROM events, range(6) t(k) GROUP BY user_id, k")
def candidate_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six hours down from each user's newest one."""
    hour = F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    newest = read(spark, sf_dir, "events").groupBy("user_id").agg(F.max(hour).alias("newest_s"))
    return calendar.candidates(newest, 6).select("user_id", "start_s")


@query("SELECT DISTINCT 1704067200 + event_id % 24 * 3600 AS start_s FROM events")
def explicit_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select((F.lit(1_704_067_200) + F.col("event_id") % 24 * 3_600).alias("start_s"))
    return calendar.explicit_starts(e, date(2024, 1, 1))


@query(
    f"""WITH h AS (SELECT DISTINCT strftime(make_timestamp(h * 3600000000), '%Y-%m-%dT%H') || '.parquet' AS name, h FROM ({_SPANS}), range(a // 3600000000, b // 3600000000 + 1) t(h))
SELECT name, CASE WHEN h % 24 IN (4, 5, 6) AND h // 24 % 7 = 0 THEN 'absent' ELSE 'read' END AS state FROM h"""
)
def tolerated_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours whose absence is known, three of each seventh day, go to the provenance."""
    hours = calendar.hours_covering(spans(spark, sf_dir))
    absent = hours.where((F.col("hour_s") % 86_400 / 3_600).isin(4, 5, 6) & (F.floor(F.col("hour_s") / 86_400) % 7 == 0)).select("name")
    present, known = calendar.tolerated(hours, absent)
    return present.select("name", F.lit("read").alias("state")).unionByName(known.select("name", F.lit("absent").alias("state")))


@query(
    """SELECT DISTINCT a AS asset, strftime(o_orderdate, '%Y-%m-%d') AS day, k AS kind, 'https://data.binance.vision/data/' || CASE WHEN a = 'HYPE' THEN 'futures/um' ELSE 'spot' END || '/daily/' || k || '/' || a || 'USDT/'
  || CASE WHEN k = 'klines' THEN '1m/' || a || 'USDT-1m-' ELSE a || 'USDT-trades-' END || strftime(o_orderdate, '%Y-%m-%d') || '.zip' AS url FROM orders, (VALUES ('BTC'), ('HYPE')) t(a), (VALUES ('klines'), ('trades')) u(k)"""
)
def price_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    days = read(spark, sf_dir, "orders").select(day).distinct().select("day", F.explode(F.array(F.lit("BTC"), F.lit("HYPE"))).alias("asset"))
    return calendar.price_objects(days, ("klines", "trades"))


@query(
    """SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON c_custkey * 2 + 2 > s_suppkey * 3 AND c_custkey * 2 < s_suppkey * 3 + 4"""
)
def hours_and_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that overlap markets; more than three markets of an hour would be an error."""
    hours = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") * 3).alias("a"), (F.col("s_suppkey") * 3 + 4).alias("b"))
    markets = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 2).alias("c"), (F.col("c_custkey") * 2 + 2).alias("d"))
    return joins.require_few(joins.overlapping(hours, markets, ("a", "b"), ("c", "d"), 8), ["s_suppkey"], 3).select("s_suppkey", "c_custkey")


@query(
    """WITH n AS (SELECT user_id AS c, user_id % 3 AS a, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY ALL), b AS (SELECT user_id AS c, user_id % 3 AS a, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT median(n) :: BIGINT AS m FROM n), t AS (SELECT sum(n) :: BIGINT AS t FROM n)
SELECT 'market_object' AS scope, CAST(c AS VARCHAR) AS key, n AS rows FROM n WHERE n > 35 UNION ALL SELECT 'market_day', CAST(c AS VARCHAR), n FROM b WHERE n > 70
UNION ALL SELECT 'asset_object', 'a' || a, sum(n) :: BIGINT FROM n GROUP BY a HAVING sum(n) > 100 UNION ALL SELECT 'asset_day', 'a' || a, sum(n) :: BIGINT FROM b GROUP BY a HAVING sum(n) > 3350"""
)
def cumulative_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events are an object's, odd ones what the day has so far."""
    e = read(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("condition_id"), F.concat(F.lit("a"), (F.col("user_id") % 3).cast("string")).alias("asset"))
    owners, so_far = e.select("condition_id", "asset").distinct(), e.where("event_id % 2 = 1").groupBy("condition_id").agg(F.count("*").alias("rows"))
    caps = {"market_object": 35, "market_day": 70, "asset_object": 100, "asset_day": 3_350}
    return guards.over_caps(e.where("event_id % 2 = 0").select("condition_id"), owners, caps, so_far).select("scope", "key", "rows")


@query("SELECT 'a' || user_id % 3 AS asset, count(*) AS rows, count(DISTINCT user_id) AS markets FROM events GROUP BY ALL")
def restored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("condition_id"), F.concat(F.lit("a"), (F.col("user_id") % 3).cast("string")).alias("asset"))
    return guards.restored_counts(guards.over_cap(e, ["condition_id"], 0), e.distinct())


@query("SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def unique_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"))
    return guards.unique_records(c.unionByName(c), ["c_custkey"])


@query("SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.duplicates(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    """(SELECT 'missing' AS side, c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) ORDER BY k LIMIT 10)
UNION ALL (SELECT DISTINCT 'unexpected', o_custkey + 1000000 FROM orders WHERE o_orderkey % 2 = 0 ORDER BY 2 LIMIT 10)"""
)
def compared_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    found = o.select(F.col("o_custkey").alias("k")).unionByName(o.where("o_orderkey % 2 = 0").select((F.col("o_custkey") + 1_000_000).alias("k")))
    return joins.compare_sets(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), found, "k")


@query("SELECT 'c' || c_custkey AS market_id, 'balance' AS field FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 'c' || c_custkey, 'segment' FROM customer WHERE c_custkey % 6 = 0")
def changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows against what was expected of them, field by field; nulls are values."""
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("c"), k.cast("string")).alias("market_id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    now = c.withColumns({"balance": F.when(k % 4 == 0, None).otherwise(F.col("balance")), "segment": F.when(k % 6 == 0, F.concat("segment", F.lit("?"))).otherwise(F.col("segment"))})
    return joins.changed(c, now, "market_id", ["balance", "segment"])


@query("SELECT side, o_orderkey AS condition_id FROM orders, (VALUES ('missing'), ('unexpected')) t(side) WHERE o_orderkey % 3 = 0")
def identity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets by condition and set of tokens: turned round they are the same, a third have another token."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("condition_id"), F.col("o_orderkey").alias("token_up"), (F.col("o_orderkey") + 1).alias("token_down"))
    other = F.when(F.col("condition_id") % 3 == 0, -1).otherwise(F.col("token_up"))
    return joins.same_pairs(o, o.select("condition_id", F.col("token_down").alias("token_up"), other.alias("token_down")))


@query("SELECT page, 'https://' || split_part(url, '/', 3) AS name FROM (SELECT page_id AS page, url FROM pages) WHERE url LIKE 'https://%'")
def catalogue_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that stored pages list, here each page's own host, written twice."""
    p = read(spark, sf_dir, "pages").where(F.col("url").startswith("https://"))
    html = F.concat(F.lit("<a href='"), "url", F.lit("'>"), "url", F.lit("</a>"))
    return catalogue.names(p.select(F.col("page_id").alias("page"), html.alias("html")), "(https://[^/'<]+)/")


@query("SELECT split_part(url, '/', 3) AS name, count(*) AS pages FROM pages GROUP BY ALL HAVING count(*) > 1")
def catalogue_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.col("url").alias("html"))
    return catalogue.overlaps(catalogue.names(p, "//([^/]+)"))


@query("SELECT page_id AS page FROM pages WHERE page_id % 7 IN (2, 3, 4)")
def catalogue_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that say nothing, another page's number, or another number of pages."""
    p = read(spark, sf_dir, "pages").select(F.col("page_id").alias("page"))
    total = p.count()
    text = F.when(F.col("page") % 7 == 2, "none").when(F.col("page") % 7 == 3, F.format_string("Page %d of %d", F.col("page") + 1, F.lit(total)))
    text = text.when(F.col("page") % 7 == 4, F.format_string("Page %d of %d", "page", F.lit(total + 1))).otherwise(F.format_string("Page %d of %d", "page", F.lit(total)))
    return catalogue.incomplete(p.withColumn("html", text), r"Page (\d+) of (\d+)")


_LISTED = """SELECT CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '' END || 'BTC--1h--2026-05-' || printf('%02d', c_custkey % 28 + 1) || '--' || sha256(c_custkey :: VARCHAR) || '--' || CASE WHEN c_custkey % 2 = 0 THEN 'markets.parquet' ELSE 'manifest.json' END AS name,
  'data-2026-05-' || CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE 'b' END AS release, c_custkey FROM customer"""


@query(
    f"""WITH l AS ({_LISTED})
SELECT name, CASE WHEN c_custkey % 5 <> 0 THEN 'BTC/1h/2026-05-' || printf('%02d', c_custkey % 28 + 1) END AS partition_id,
  CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'markets.parquet' ELSE 'manifest.json' END END AS filename, CASE WHEN c_custkey % 5 <> 0 THEN sha256(c_custkey :: VARCHAR) END AS digest,
  CASE WHEN c_custkey % 5 = 0 THEN 'noncanonical' WHEN (c_custkey % 28 + 1 <= 15) <> (c_custkey % 3 = 0) THEN 'release' END AS fault FROM l"""
)
def published_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of published files read again: a fifth are no such names, and some stand in the wrong half month's release."""
    k = F.col("c_custkey")
    partition = F.concat(F.lit("BTC/1h/2026-05-"), F.format_string("%02d", k % 28 + 1))
    name = values.content_name(partition, F.when(k % 2 == 0, "markets.parquet").otherwise("manifest.json"), values.sha256(k.cast("string")))
    release = F.when(k % 3 == 0, "data-2026-05-a").otherwise("data-2026-05-b")
    listing = read(spark, sf_dir, "customer").select(F.when(k % 5 == 0, F.concat(F.lit("x"), name)).otherwise(name).alias("name"), release.alias("release"))
    return reconcile.parse_listing(listing, release="release", prefix="data").select("name", "partition_id", "filename", "digest", "fault")


@query(
    """SELECT c_custkey, 'BTC--1h--2026-05-01--' || sha256(c_custkey :: VARCHAR) || '--' || c_custkey || '.json' AS name,
  CASE WHEN c_custkey % 3 <> 0 THEN sha256(c_custkey :: VARCHAR) END AS digest FROM customer"""
)
def content_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published names, and the digests in them; of a third a digit is gone."""
    k = F.col("c_custkey")
    name = values.content_name(F.lit("BTC/1h/2026-05-01"), F.concat(k.cast("string"), F.lit(".json")), values.sha256(k.cast("string")))
    cut = F.when(k % 3 == 0, F.concat(F.substr(name, F.lit(1), F.lit(30)), F.substr(name, F.lit(32)))).otherwise(name)
    return read(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), values.digest_of(cut).alias("digest"))


@query(
    """WITH i AS (SELECT l_orderkey AS p, 'f' || l_linenumber AS f, l_linestatus <> 'F' OR l_linenumber <> 2 AS up FROM lineitem)
SELECT CAST(p AS VARCHAR) AS partition_id FROM i GROUP BY p HAVING count(*) = 3 AND count(DISTINCT f) = 3 AND bool_and(up) AND bool_and(f IN ('f1', 'f2', 'f3'))"""
)
def complete_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 2), "new").otherwise("uploaded")
    inventory = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("partition_id"), F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("filename"), state.alias("state"))
    return reconcile.complete(inventory, ("f1", "f2", "f3"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS partition_id FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)")
def uncovered_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lambda table, column, cond="true": read(spark, sf_dir, table).where(cond).select(F.col(column).cast("string").alias("partition_id"))
    return reconcile.uncovered(ids("customer", "c_custkey"), ids("orders", "o_custkey", "o_orderkey % 5 = 0"), ids("customer", "c_custkey", "c_custkey % 3 = 0"))


@query("SELECT count(*) FILTER (c_custkey % 3 = 0) AS \"TIER_A\", count(*) FILTER (c_custkey % 3 = 1) AS \"TIER_B\", count(*) FILTER (c_custkey % 3 = 2) AS \"EXCLUDED\", count(*) * 6 AS files FROM customer")
def certified_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certifies first: the tiers add up to the plan, and so do the files."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("partition_id"), F.get(F.array(*map(F.lit, reconcile.TIERS)), (F.col("c_custkey") % 3).cast("int")).alias("tier"), F.lit(6).cast("long").alias("files"))
    reconcile.certify(c.select("partition_id"), c)
    return reconcile.tier_counts(c)


@query("SELECT max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, min(l_discount) AS l_discount FROM lineitem")
def resource_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.peaks(read(spark, sf_dir, "lineitem"), ("l_quantity", "l_extendedprice"), ("l_discount",))


@query(
    """SELECT o_orderkey AS market_id, CASE o_orderkey % 6 WHEN 0 THEN 'asset' WHEN 1 THEN 'timeframe' WHEN 2 THEN 'length' WHEN 3 THEN 'outcome' WHEN 4 THEN 'page' END AS fault FROM orders WHERE o_orderkey % 6 <> 5"""
)
def market_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    way = F.col("o_orderkey") % 6
    pick = lambda i, bad, good: F.when(way == i, bad).otherwise(good)
    o = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("market_id"), pick(0, None, "BTC").alias("asset"), pick(1, "4h", "1h").alias("timeframe"), F.lit(0).cast("long").alias("market_start_ns"),
        (F.lit(3_600 * 10**9) + F.when(way == 2, 1).otherwise(0)).alias("market_end_ns"), pick(3, "?", "UP").alias("official_outcome"), pick(4, "other", "page").alias("resolution_source_url"),
    )
    return reconcile.market_faults(o, F.lit("BTC"), F.lit("page"))


#: Keys of orders that make a day: a receipt has at most so many, and days are as many as the orders need.
DAY_ORDERS = 1_000


def day_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of days of four segments, made of orders: each has its starts, markets (a tenth also in the next one) and files."""
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").withColumn("day", F.floor(k / DAY_ORDERS).cast("string"))
    both = o.select("*", F.explode(F.when(k % 10 == 0, F.array(k % 4, (k + 1) % 4)).otherwise(F.array(k % 4))).alias("segment"))
    # A day of few orders has its empty segments too: aggregates skip the nulls.
    none = o.select("day").distinct().select("day", F.explode(F.array(*(F.lit(i).cast("long") for i in range(4)))).alias("segment"))
    text = k.cast("string")
    market = F.struct(F.concat(F.lit("m"), text).alias("market_id"), text.alias("condition_id"), (k * 3_600).alias("market_start_ns"), F.col("o_orderstatus").alias("official_outcome"))
    file = F.struct(F.concat(F.lit("f"), text).alias("path"), k.alias("byte_length"), values.sha256(text).alias("sha256"))
    rows = both.select("day", "segment", k, market.alias("market"), file.alias("file")).unionByName(none, allowMissingColumns=True)
    per = rows.groupBy("day", "segment").agg(F.collect_list("market").alias("markets"), F.collect_list("file").alias("files"), F.collect_set(k * 3_600).alias("market_starts"), F.coalesce(F.sum(k), F.lit(0)).alias("source_bytes"))
    receipt = F.struct("day", F.col("segment").cast("int").alias("segment_index"), F.lit(4).alias("segment_count"), "market_starts", "source_bytes", "markets", "files")
    return per.select(F.to_json(receipt).alias("receipt"))


@query("SELECT 'm' || o_orderkey AS market_id, CAST(o_orderkey AS VARCHAR) AS condition_id, o_orderkey * 3600 AS market_start_ns, o_orderstatus AS official_outcome FROM orders")
def assembled_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days' markets from their segments' receipts, each once, after the checks of cover and agreement."""
    starts = read(spark, sf_dir, "orders").select((F.col("o_orderkey") * 3_600).alias("start_s"))
    return segments.assembled(segments.receipts(day_receipts(spark, sf_dir)), starts)


@query("SELECT 'f' || o_orderkey AS path, CASE o_orderkey % 5 WHEN 0 THEN 'absent' WHEN 1 THEN 'changed' END AS fault FROM orders WHERE o_orderkey % 5 <= 1 UNION ALL SELECT 'new', 'in no receipt'")
def segment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    now = read(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").select(F.concat(F.lit("f"), k.cast("string")).alias("path"), (k + F.when(k % 5 == 1, 1).otherwise(0)).alias("byte_length"), values.sha256(k.cast("string")).alias("sha256"))
    new = spark.createDataFrame([("new", 1, "x")], "path string, byte_length long, sha256 string")
    return segments.changed_files(segments.receipts(day_receipts(spark, sf_dir)), now.unionByName(new))


@query("SELECT side, s AS start_s FROM ((SELECT 'missing' AS side, -o_orderkey AS s FROM orders ORDER BY s LIMIT 10) UNION ALL (SELECT 'unexpected', o_orderkey * 3600 FROM orders WHERE o_orderkey % 2 = 1 ORDER BY 2 LIMIT 10))")
def segment_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    starts = o.where("o_orderkey % 2 = 0").select((F.col("o_orderkey") * 3_600).alias("start_s")).unionByName(o.select((-F.col("o_orderkey")).alias("start_s")))
    return segments.gaps(segments.receipts(day_receipts(spark, sf_dir)), starts)


@query("SELECT 'm' || o_orderkey AS market_id, 2 AS versions FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 4 <> (o_orderkey + 1) % 4")
def segment_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first segment and another one say something else of the markets that two segments have."""
    told = segments.receipts(day_receipts(spark, sf_dir))
    other = F.transform("markets", lambda m: m.withField("official_outcome", F.concat(m["official_outcome"], F.col("segment_index").cast("string"))))
    return segments.contradictions(told.withColumn("markets", other))


#: Covers of one, two and three starts, of the latest start for each set of assets.
_COVER_SQL = """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey AS s, o_custkey % 8 AS mask FROM orders),
m AS (SELECT day, mask, max(s) AS s FROM o WHERE mask > 0 GROUP BY ALL),
c AS (SELECT day, 1 AS n, [s] AS c, mask FROM m
  UNION ALL SELECT day, 2, list_reverse_sort([a.s, b.s]), a.mask | b.mask FROM m a JOIN m b USING (day) WHERE a.mask < b.mask
  UNION ALL SELECT day, 3, list_reverse_sort([a.s, b.s, d.s]), a.mask | b.mask | d.mask FROM m a JOIN m b USING (day) JOIN m d USING (day) WHERE a.mask < b.mask AND b.mask < d.mask)
SELECT day, array_to_string(c, ',') AS cover FROM (SELECT day, c FROM c WHERE mask = 7 QUALIFY row_number() OVER (PARTITION BY day ORDER BY n, c DESC) = 1)"""


@query(_COVER_SQL)
def minimum_covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fewest of a day's orders that need all three of its assets; a customer's number says which ones theirs needs."""
    bits = F.col("o_custkey") % 8
    assets = F.array_compact(F.array(*(F.when(F.shiftright(bits, i) % 2 == 1, a) for i, a in enumerate("abc"))))
    usable = read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderkey").alias("start_s"), F.explode(assets).alias("asset"))
    return calendar.minimum_covers(usable, ("a", "b", "c")).where("cover IS NOT NULL").select("day", F.array_join("cover", ",").alias("cover"))


@query("SELECT event_id AS source_row FROM events")
def capped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("event_id").alias("source_row"), F.lit("events").alias("source_object"))
    return source.require_scannable(e, 25_000_000).select("source_row")


@query("SELECT user_id, count(*) AS gap_count, CAST(sum(user_id) AS BIGINT) AS gap_total_ns, '[' || string_agg('[' || event_id || ',' || event_id + user_id || ']', ',' ORDER BY event_id) || ']' AS gap_intervals_ns FROM events GROUP BY user_id")
def gap_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    g = e.select(F.col("user_id").cast("string").alias("condition_id"), F.lpad(F.col("event_id").cast("string"), 20, "0").alias("token_id"), F.col("event_id").alias("gap_start"), (F.col("event_id") + F.col("user_id")).alias("gap_end"))
    return quality.gap_evidence(g).select(F.col("condition_id").cast("long").alias("user_id"), "gap_count", "gap_total_ns", F.to_json("gap_intervals_ns").alias("gap_intervals_ns"))


#: Another version of the orders: some dearer, some of another status and priority, some gone, some new.
_ORDERS_SQL = """SELECT CASE WHEN o_orderkey % 1009 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 991 = 0 THEN '?' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 991 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 1013 <> 0"""


@query(
    f"""WITH l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders), r AS ({_ORDERS_SQL})
SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey, CASE WHEN l.o_orderkey IS NULL THEN 'added' WHEN r.o_orderkey IS NULL THEN 'absent' ELSE 'changed' END AS change,
  CASE WHEN l.o_orderkey IS NULL OR r.o_orderkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN l.o_custkey IS DISTINCT FROM r.o_custkey THEN 'o_custkey' END, CASE WHEN l.o_orderpriority IS DISTINCT FROM r.o_orderpriority THEN 'o_orderpriority' END,
    CASE WHEN l.o_orderstatus IS DISTINCT FROM r.o_orderstatus THEN 'o_orderstatus' END, CASE WHEN l.o_totalprice IS DISTINCT FROM r.o_totalprice THEN 'o_totalprice' END) END AS columns
FROM l FULL JOIN r ON l.o_orderkey = r.o_orderkey
WHERE l.o_orderkey IS NULL OR r.o_orderkey IS NULL OR (l.o_custkey, l.o_orderstatus, l.o_totalprice, l.o_orderpriority) IS DISTINCT FROM (r.o_custkey, r.o_orderstatus, r.o_totalprice, r.o_orderpriority)"""
)
def audited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What another version of the orders has changed, added and dropped: only the buckets that differ are read again."""
    now = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    other = now.where(k % 1013 != 0).select(
        F.when(k % 1009 == 0, k + 1_000_000_000).otherwise(k).alias("o_orderkey"), "o_custkey", F.when(k % 991 == 0, "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 997 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"), F.when(k % 991 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return audit.changes(now, other, ["o_orderkey"]).select("o_orderkey", "change", F.array_join("columns", ",").alias("columns"))


def _orders_as_markets(orders: DataFrame, outcome: Column) -> DataFrame:
    given = {"condition_id": F.col("o_orderkey").cast("string"), "market_id": F.col("o_orderkey").cast("string"), "official_outcome": outcome}
    return orders.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.table("markets")))


@query(
    """WITH l AS (SELECT l_orderkey, bool_or(l_partkey % 40 IN (7, 11, 13)) AS sourced FROM lineitem GROUP BY l_orderkey)
SELECT * FROM (SELECT CAST(o_orderkey AS VARCHAR) AS condition_id, CASE WHEN o_orderkey % 103 = 0 THEN 'new' WHEN o_orderkey % 101 = 0 THEN 'market' WHEN sourced THEN 'source' END AS reason
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey WHERE o_orderkey % 107 <> 0) WHERE reason IS NOT NULL"""
)
def touched_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as markets, fed by lines out of forty objects: of those one is replaced, one gone and one new, and some orders are new, gone or of another status."""
    orders, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    number = F.col("l_partkey") % 40
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("condition_id"), number.alias("number"), F.concat(F.lit("f"), number.cast("string")).alias("source_object"))
    files = lines.select("source_object", "number").distinct()
    digest = F.sha2("source_object", 256)
    then, now = files.where("number <> 13").select("source_object", digest.alias("sha256")), files.where("number <> 11").select("source_object", F.when(F.col("number") == 7, "replaced").otherwise(digest).alias("sha256"))
    kept = lines.where("number <> 13").select("condition_id", F.lit(1).alias(lineage.COPIES), F.array("source_object").alias(lineage.OBJECTS))
    was = _orders_as_markets(orders.where(k % 103 != 0), F.col("o_orderstatus"))
    markets = _orders_as_markets(orders.where(k % 107 != 0), F.when(k % 101 == 0, "?").otherwise(F.col("o_orderstatus")))
    kept = kept.join(was.select("condition_id"), "condition_id", "left_semi")
    before = lineage.whole(lineage.of_markets(was, kept, then), then)
    changed = lineage.changed_objects(before, now)
    fed = lines.join(changed.where("change <> 'absent'"), "source_object", "left_semi")
    return lineage.touched(before, markets, changed, fed)
