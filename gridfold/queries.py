"""The engine's operators as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridfold.functions import identity, timefn, values
from gridfold.operators import book, forensics, grid, guards, joins, order, quality
from gridfold.plans import calendar, reconcile
from gridfold.registry import ORACLE_SQL, QUERIES, query, read

HOUR = 3_600_000_000
#: Where the grid begins, in microseconds since 1970 (2024-01-01), and its hours: the month of all events.
START = 1_704_067_200_000_000
HOURS = 30 * 24


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time in microseconds. ``ts`` has no zone; the session's is UTC."""
    return read(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = events(spark, sf_dir).select("user_id", "event_id", "us", "value")
    bounded = states.withColumns({"start": F.lit(START), "end": F.lit(START + HOURS * HOUR)})
    return grid.asof_grid(bounded, ["user_id"], "us", ["event_id"], HOUR)


_GRID_SQL = f"""
WITH s AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
g AS (SELECT user_id, {START} + h * {HOUR} AS grid FROM (SELECT DISTINCT user_id FROM s), range({HOURS}) t(h)),
a AS (SELECT g.user_id, g.grid, s.event_id, s.us, s.value FROM g ASOF JOIN s ON s.user_id = g.user_id AND s.us <= g.grid)
"""


@query(_GRID_SQL + "SELECT user_id, grid, event_id, value FROM a")
def asof_grid_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("user_id", "grid", "event_id", "value")


@query(_GRID_SQL + "SELECT user_id, grid, (grid - us) // 1000 AS stale_ms FROM a")
def asof_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("user_id", "grid", grid.staleness("grid", "us", 1_000).alias("stale_ms"))


@query(
    _GRID_SQL
    + f"""SELECT u.user_id, {START} AS gap_start, coalesce(min(a.grid), {START + HOURS * HOUR}) AS gap_end
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN a ON a.user_id = u.user_id GROUP BY u.user_id HAVING gap_end > {START}"""
)
def leading_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).select("user_id").distinct().withColumns({"start": F.lit(START), "end": F.lit(START + HOURS * HOUR)})
    return grid.leading_gaps(users, _grid(spark, sf_dir), ["user_id"])


@query(
    _GRID_SQL
    + f""", first AS (SELECT u.user_id, min(a.grid) AS seen FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN a ON a.user_id = u.user_id GROUP BY u.user_id)
SELECT user_id, CASE WHEN seen IS NULL THEN 'SOURCE_GAP' WHEN seen > {START} THEN 'SOURCE_GAP' END AS reason FROM first"""
)
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).select("user_id").distinct()
    gaps = leading_gap(spark, sf_dir).select("user_id", F.lit(1).alias("gap_count"))
    seen = _grid(spark, sf_dir).select("user_id").distinct().withColumn("has", F.lit(True))
    joined = users.join(gaps, "user_id", "left").join(seen, "user_id", "left")
    none = F.lit(None).cast("string")
    return joined.select("user_id", quality.verdict(F.lit("1h"), F.lit("UP"), none, F.coalesce("has", F.lit(False)), F.col("gap_count")).alias("reason"))


@query(
    """WITH d AS (SELECT 0 AS copy, * FROM events UNION ALL SELECT 1, * FROM events WHERE event_id % 3 = 0)
SELECT event_id, user_id, event_type, copy FROM d
QUALIFY row_number() OVER (PARTITION BY event_id, ts, user_id, event_type, value, props ORDER BY copy) = 1"""
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    twice = e.withColumn("copy", F.lit(0)).unionByName(e.where("event_id % 3 = 0").withColumn("copy", F.lit(1)))
    return order.dedup_keep_first(twice, ["event_id", "ts", "user_id", "event_type", "value", "props"], ["copy"]).select("event_id", "user_id", "event_type", "copy")


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sequence FROM events")
def event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.sequence(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "sequence")


@query(
    """SELECT event_id, coalesce(lead(h) OVER w <> h, true) AS batch_end
FROM (SELECT event_id, user_id, ts, date_trunc('hour', ts) AS h FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def batch_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("h", F.date_trunc("hour", "ts"))
    return order.batch_end(e, ["user_id"], ["ts", "event_id"], "h").select("event_id", "batch_end")


@query(
    """WITH e AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch FROM events)
SELECT event_id, epoch, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER w AS last_click,
  last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase
FROM e WINDOW w AS (PARTITION BY user_id, epoch ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) QUALIFY epoch > 0"""
)
def anchored_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sign-up resets what is known of a user; nothing is known before the first one."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, sf_dir, "events").withColumn("epoch", F.count(F.when(F.col("event_type") == "signup", 1)).over(by)).where("epoch > 0")
    w = Window.partitionBy("user_id", "epoch").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda t: F.last(F.when(F.col("event_type") == t, F.col("value")), ignorenulls=True).over(w)
    return e.select("event_id", "epoch", last("click").alias("last_click"), last("purchase").alias("last_purchase"))


def synthetic_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book events made of the events table: a user is a token; every 16th event is a snapshot, the others
    set or remove one bid or ask."""
    e = events(spark, sf_dir)
    numbered = order.sequence(e, ["user_id"], ["us", "event_id"])
    is_book = F.col("sequence") % 16 == 0
    price = lambda cents: (cents / 100).cast("decimal(9,4)")
    side = lambda cents: F.array(F.struct(price(cents).alias("price"), F.lit(1).cast("decimal(18,6)").alias("size")))
    buy = F.col("event_id") % 2 == 0
    cents = F.col("event_id") * 7919 % 40 + F.when(buy, 5).otherwise(55)
    none = F.lit(None).cast("decimal(9,4)")
    return numbered.select(
        F.lit("0xbook").alias("condition_id"), F.col("user_id").cast("string").alias("token_id"), (F.col("us") * 1_000).alias("source_ts_ns"), (F.col("us") * 1_000).alias("receive_ts_ns"),
        F.lit("events").alias("source_object"), F.col("event_id").alias("source_row"), "sequence", F.when(is_book, "BOOK").otherwise("PRICE_CHANGE").alias("event_type"),
        F.when(is_book, side(F.lit(40))).alias("bids"), F.when(is_book, side(F.lit(60))).alias("asks"), F.when(buy, "BUY").otherwise("SELL").alias("side"), price(cents).alias("price"),
        F.when(F.col("event_id") % 5 == 0, 0).otherwise(F.col("event_id") % 100 + 1).cast("decimal(18,6)").alias("size"),
        none.alias("best_bid"), none.alias("best_ask"), none.alias("old_tick_size"), none.alias("new_tick_size"),
    )


def depth(states: DataFrame) -> DataFrame:
    cents = lambda side: (F.get(f"{side}.price", F.lit(0)) * 100).cast("long")
    size = F.aggregate("bids", F.lit(0).cast("decimal(38,6)"), lambda total, x: (total + x["size"]).cast("decimal(38,6)")).cast("long")
    return states.select("token_id", "sequence", F.size("bids").cast("long").alias("n_bids"), F.size("asks").cast("long").alias("n_asks"), cents("bids").alias("best_bid"), cents("asks").alias("best_ask"), size.alias("bid_size"))


#: The book after each event: of each price the last size since the last snapshot.
_BOOK_SQL = """WITH n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events),
e AS (SELECT user_id, seq, seq // 16 AS epoch, event_id % 2 = 0 AS buy, event_id * 7919 % 40 + CASE WHEN event_id % 2 = 0 THEN 5 ELSE 55 END AS cents,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 100 + 1 END AS size FROM n),
u AS (SELECT * FROM e WHERE seq % 16 <> 0 UNION ALL SELECT user_id, seq, epoch, b, c, 1 FROM e, (VALUES (true, 40), (false, 60)) t(b, c) WHERE seq % 16 = 0),
l AS (SELECT e.user_id, e.seq, u.buy, u.cents, arg_max(u.size, u.seq) AS size FROM e JOIN u ON u.user_id = e.user_id AND u.epoch = e.epoch AND u.seq <= e.seq GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS token_id, seq AS sequence, count(*) FILTER (buy AND size > 0) AS n_bids, count(*) FILTER (NOT buy AND size > 0) AS n_asks,
  max(cents) FILTER (buy AND size > 0) AS best_bid, min(cents) FILTER (NOT buy AND size > 0) AS best_ask, CAST(coalesce(sum(size) FILTER (buy), 0) AS BIGINT) AS bid_size
FROM l GROUP BY user_id, seq"""


@query(_BOOK_SQL)
def book_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth(book.states_of(book.rebuilt(synthetic_book(spark, sf_dir))))


def contested_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``synthetic_book`` in batches of two events, with trades, changes of tick, claimed best prices and crossing bids among its increments."""
    x = synthetic_book(spark, sf_dir)
    event, increment = F.col("source_row"), F.col("event_type") != "BOOK"
    kind = F.when(~increment, "BOOK").when(event % 11 == 0, "LAST_TRADE_PRICE").when(event % 13 == 0, "TICK_SIZE_CHANGE").otherwise("PRICE_CHANGE")
    price = lambda v: F.lit(v).cast("decimal(9,4)")
    return x.withColumns(
        {
            "event_type": kind, "receive_ts_ns": F.floor(F.col("sequence") / 2) * 1_000, "source_row": F.col("sequence"),
            "price": F.when((event % 301 == 0) & (F.col("side") == "BUY"), price("0.7")).otherwise(F.col("price")),
            "best_bid": F.when(increment & (event % 97 == 0), price("0.4")), "best_ask": F.when(increment & (event % 89 == 0), price("0.6")),
            "old_tick_size": F.when(event % 51 == 0, price("0.001")).otherwise(price("0.01")), "new_tick_size": price("0.01"),
        }
    )


#: Levels as in ``book_fold``; a claim at a batch's end takes away what was set before it beyond it. Then the first
#: contradiction of each token: a broken chain of ticks, a crossed book, another best bid or ask than claimed.
_RULES_SQL = """WITH n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, count(*) OVER (PARTITION BY user_id) AS many FROM events),
e AS (SELECT user_id, seq, seq // 16 AS epoch, event_id, event_id % 2 = 0 AS buy, CASE WHEN event_id % 2 = 0 AND event_id % 301 = 0 THEN 70 ELSE event_id * 7919 % 40 + CASE WHEN event_id % 2 = 0 THEN 5 ELSE 55 END END AS cents,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 100 + 1 END AS size, seq % 2 = 1 OR seq = many - 1 AS last,
  CASE WHEN seq % 16 = 0 THEN 'book' WHEN event_id % 11 = 0 THEN 'trade' WHEN event_id % 13 = 0 THEN 'tick' ELSE 'set' END AS kind FROM n),
u AS (SELECT user_id, seq, epoch, buy, cents, size FROM e WHERE kind = 'set' UNION ALL SELECT user_id, seq, epoch, b, c, 1 FROM e, (VALUES (true, 40), (false, 60)) t(b, c) WHERE kind = 'book'),
l AS (SELECT e.user_id, e.epoch, e.seq, u.buy, u.cents, max(u.seq) AS since, arg_max(u.size, u.seq) AS size FROM e JOIN u ON u.user_id = e.user_id AND u.epoch = e.epoch AND u.seq <= e.seq WHERE e.kind <> 'trade' GROUP BY ALL),
c AS (SELECT user_id, epoch, seq, event_id % 97 = 0 AS bid, event_id % 89 = 0 AS ask FROM e WHERE kind = 'set' AND last AND (event_id % 97 = 0 OR event_id % 89 = 0)),
k AS (SELECT * FROM l WHERE size > 0 AND NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = l.user_id AND c.epoch = l.epoch AND c.seq >= l.since AND c.seq <= l.seq AND (l.buy AND c.bid AND l.cents > 40 OR NOT l.buy AND c.ask AND l.cents < 60))),
s AS (SELECT e.user_id, e.seq, any_value(e.last) AS last, any_value(e.kind) AS kind, any_value(event_id) AS event_id, max(k.cents) FILTER (k.buy) AS top, min(k.cents) FILTER (NOT k.buy) AS low, count(k.cents) FILTER (k.buy) AS n_bids, count(k.cents) FILTER (NOT k.buy) AS n_asks
  FROM e LEFT JOIN k ON k.user_id = e.user_id AND k.seq = e.seq WHERE e.kind <> 'trade' GROUP BY e.user_id, e.seq),
t AS (SELECT user_id, seq, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS nth FROM e WHERE kind = 'tick'),
w AS (SELECT s.*, CASE WHEN kind = 'tick' AND nth > 1 AND event_id % 51 = 0 THEN 'tick-size chain is inconsistent:' WHEN NOT last THEN NULL WHEN top >= low THEN 'crossed or locked book:'
  WHEN kind <> 'book' AND event_id % 97 = 0 AND top IS DISTINCT FROM 40 THEN printf('best bid disagrees: reconstructed=%s, claimed=0.40;', coalesce(printf('%.2f', top / 100), 'None'))
  WHEN kind <> 'book' AND event_id % 89 = 0 AND low IS DISTINCT FROM 60 THEN printf('best ask disagrees: reconstructed=%s, claimed=0.60;', coalesce(printf('%.2f', low / 100), 'None')) END AS error FROM s LEFT JOIN t USING (user_id, seq)),
f AS (SELECT user_id, min(seq) AS at, arg_min(error, seq) AS error FROM w WHERE error IS NOT NULL GROUP BY user_id)
SELECT CAST(w.user_id AS VARCHAR) AS token_id, any_value(f.error) AS error, any_value(f.at) AS error_row, CASE WHEN any_value(f.at) IS NULL THEN count(*) END AS n_states,
  CASE WHEN any_value(f.at) IS NULL THEN CAST(sum(n_bids) AS BIGINT) END AS n_bids, CASE WHEN any_value(f.at) IS NULL THEN CAST(sum(n_asks) AS BIGINT) END AS n_asks
FROM w LEFT JOIN f USING (user_id) GROUP BY w.user_id"""


@query(_RULES_SQL)
def book_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each token its states' levels or, in their place, its first contradiction and where that is."""
    good = lambda c: F.when(F.max("error").isNull(), c)
    rows = book.rebuilt(contested_book(spark, sf_dir)).groupBy("token_id")
    found = rows.agg(F.max("error").alias("text"), good(F.count("sequence")).alias("n_states"), good(F.sum(F.size("bids"))).alias("n_bids"), good(F.sum(F.size("asks"))).alias("n_asks"))
    where = F.regexp_extract("text", r"source_row=(\d+)", 1)
    return found.select("token_id", F.when(where != "", F.regexp_extract("text", "^(.*?[:;]) receive_ts_ns", 1)).alias("error"), F.when(where != "", where).cast("long").alias("error_row"), "n_states", "n_bids", "n_asks")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def semi_join_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = read(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").alias("l_partkey"))
    return joins.keep_ids(read(spark, sf_dir, "lineitem"), keys, ["l_partkey"]).select("l_orderkey", "l_linenumber")


@query(
    f"""WITH w AS (SELECT user_id, min(epoch_us(ts)) + {24 * HOUR} AS a, min(epoch_us(ts)) + {96 * HOUR} AS b FROM events GROUP BY user_id)
SELECT event_id FROM events e JOIN w ON e.user_id = w.user_id AND epoch_us(ts) >= a AND epoch_us(ts) < b"""
)
def window_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    w = e.groupBy("user_id").agg((F.min("us") + 24 * HOUR).alias("a"), (F.min("us") + 96 * HOUR).alias("b"))
    return joins.in_window(e, w, "user_id", "us", "a", "b").select("event_id")


@query(
    """WITH o AS (SELECT o_orderkey, epoch_us(o_orderdate) // 86400000000 AS a, epoch_us(o_orderdate) // 86400000000 + 1 + o_orderkey % 5 AS b FROM orders),
m AS (SELECT s_suppkey, 9131 + s_suppkey * 2 AS c, 9131 + s_suppkey * 2 + 2 AS d FROM supplier)
SELECT o_orderkey, s_suppkey FROM o JOIN m ON a < d AND c < b"""
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.expr("unix_micros(cast(o_orderdate AS timestamp)) div 86400000000")
    o = read(spark, sf_dir, "orders").select("o_orderkey", day.alias("a"), (day + 1 + F.col("o_orderkey") % 5).alias("b"))
    m = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") * 2 + 9131).alias("c"), (F.col("s_suppkey") * 2 + 9133).alias("d"))
    return joins.overlapping(o, m, ("a", "b"), ("c", "d"), 4).select("o_orderkey", "s_suppkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def plan_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing(read(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"])


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def out_of_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = read(spark, sf_dir, "customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("o_custkey"))
    return joins.missing(read(spark, sf_dir, "orders").select("o_custkey"), plan, ["o_custkey"]).distinct()


@query(
    """WITH i AS (SELECT l_orderkey AS p, 'f' || least(l_linenumber, 4) AS f, l_partkey % 3 AS d FROM lineitem), k AS (SELECT p, f, count(*) AS n, count(DISTINCT d) AS v FROM i GROUP BY p, f),
w AS (SELECT p, sum(n) AS n, count(*) FILTER (f <> 'f4') AS own FROM k GROUP BY p)
SELECT 'divergent' AS kind, p || '/' || f AS item FROM k WHERE v > 1 UNION ALL SELECT 'duplicate', p || '/' || f FROM k WHERE n > 1
UNION ALL SELECT 'unexpected_files', p || '/' || f FROM k WHERE f = 'f4' UNION ALL SELECT 'out_of_plan', CAST(p AS VARCHAR) FROM w WHERE p NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
UNION ALL SELECT 'partial', CAST(p AS VARCHAR) FROM w WHERE p IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') AND NOT (n = 3 AND own = 3)"""
)
def inventory_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as files of their order, the part as a file's content; orders that aren't finished are the plan."""
    li = read(spark, sf_dir, "lineitem")
    file = F.concat(F.lit("f"), F.least("l_linenumber", F.lit(4)).cast("string"))
    listed = li.select(F.col("l_orderkey").cast("string").alias("partition_id"), file.alias("filename"), (F.col("l_partkey") % 3).alias("digest"), F.lit("uploaded").alias("state"))
    plan = read(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").cast("string").alias("partition_id"))
    return reconcile.anomalies(listed, plan, ("f1", "f2", "f3"))


@query(
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'unplanned' WHEN a AND x THEN 'both' WHEN a THEN 'accepted' WHEN x THEN 'excluded' ELSE 'none' END AS disposition
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT doc_id, bool_or(quality = 1) AS a, bool_or(toxic = 1) AS x FROM labels GROUP BY doc_id HAVING bool_or(quality = 1) OR bool_or(toxic = 1)) l ON d.doc_id = l.doc_id"""
)
def full_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return joins.dispositions(read(spark, sf_dir, "documents"), labels.where("quality = 1"), labels.where("toxic = 1"), "doc_id")


@query("SELECT l_suppkey, count(*) AS rows FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600")
def caps_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.over_cap(read(spark, sf_dir, "lineitem"), ["l_suppkey"], 600)


@query(
    """SELECT o_orderpriority AS release_group, day, row_number() OVER (PARTITION BY o_orderpriority ORDER BY day) AS turn
FROM (SELECT DISTINCT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"""
)
def round_robin_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("release_group"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return calendar.round_robin(o, "release_group", "day")


@query(
    """WITH h AS (SELECT DISTINCT user_id, epoch_us(date_trunc('hour', ts)) AS hour FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hour) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM h)
SELECT user_id, hour, s AS segment FROM n, range(4) t(s) WHERE i >= n * s // 4 AND i < n * (s + 1) // 4"""
)
def segment_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = read(spark, sf_dir, "events").select("user_id", F.unix_micros(F.date_trunc("hour", "ts").cast("timestamp")).alias("hour")).distinct()
    return calendar.segments(hours, ["user_id"], ["hour"], 4)


@query(
    """WITH n AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
c AS (SELECT user_id, arg_max(i, (value, event_id)) AS top FROM n GROUP BY user_id)
SELECT event_id, n.user_id, i - top AS distance FROM n JOIN c ON n.user_id = c.user_id WHERE i BETWEEN top - 2 AND top + 2"""
)
def neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows to each side of each user's greatest value."""
    n = order.sequence(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "i")
    c = n.groupBy("user_id").agg(F.max_by("i", F.struct("value", "event_id")).alias("at"))
    near = forensics.neighbours(n.join(c, "user_id"), ["user_id"], ["i"], F.col("i") == F.col("at"), 2)
    return near.select("event_id", "user_id", (F.col("i") - F.col("at")).alias("distance"))


@query(
    """SELECT strftime(d, '%Y-%m-%d') AS day, epoch(d) :: BIGINT + h * 3600 AS start_s FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), range(24) t(h)
WHERE epoch(d) + h * 3600 >= epoch(TIMESTAMP '1994-05-01 20:00:00') AND epoch(d) + h * 3600 < epoch(TIMESTAMP '1996-08-10 01:00:00')"""
)
def hour_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours of the days that have orders, within a coverage that begins and ends within a day."""
    days = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    starts = calendar.starts_of(days, datetime(1994, 5, 1, 20, tzinfo=UTC), datetime(1996, 8, 10, 1, tzinfo=UTC))
    return starts.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "start_s")


@query("SELECT strftime(o_orderdate, '%Y-%m') || CASE WHEN day(o_orderdate) <= 15 THEN '-a' ELSE '-b' END AS bucket, count(*) AS orders FROM orders GROUP BY 1")
def half_month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy(timefn.half_month(F.col("o_orderdate")).alias("bucket")).agg(F.count("*").alias("orders"))


@query(
    """SELECT event_id, 'bitcoin-up-or-down-' || lower(strftime(timezone('America/New_York', timezone('UTC', date_trunc('hour', ts))), '%B-%-d-%Y-%-I%p')) || '-et' AS slug,
epoch_us(date_trunc('hour', ts)) AS start_us FROM events"""
)
def slug_tz(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    named = read(spark, sf_dir, "events").select("event_id", identity.hourly_slug(F.lit("BTC"), hour).alias("slug"))
    return named.select("event_id", "slug", F.unix_micros(identity.slug_start(F.col("slug"))).alias("start_us"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT o_orderkey, sha256('{\"c\":' || o_custkey || ',\"k\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}') AS digest FROM orders")
def fingerprint_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    text = values.canonical_json(k=F.col("o_orderkey"), c=F.col("o_custkey"), s=F.col("o_orderstatus"))
    return o.select("o_orderkey", values.sha256(text).alias("digest"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, '([^/]*)$', 1) AS leaf FROM pages")
def regex_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("host"), F.regexp_extract("url", "([^/]*)$", 1).alias("leaf"))


@query(
    """SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) % 10 = 0 AS lossless FROM lineitem"""
)
def decimal_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a thousandth of the price fits DECIMAL(9,4) as it is."""
    x = (F.round(F.col("l_extendedprice") * 100).cast("decimal(20,0)") / 100_000).cast("decimal(38,18)")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", values.lossless(x, "decimal(9,4)").alias("lossless"))


@query(
    """SELECT 'both' AS kind, k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'either', k FROM (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders)
UNION ALL SELECT 'first', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)"""
)
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    parts = {"both": c.intersect(o), "either": c.union(o).distinct(), "first": c.subtract(o)}
    out = [df.select(F.lit(kind).alias("kind"), "k") for kind, df in parts.items()]
    return out[0].union(out[1]).union(out[2])


@query("SELECT event_type, count(*) AS rows, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM events GROUP BY event_type")
def stats_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("rows"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query("SELECT o_orderkey, epoch_us(o_orderdate) AS at FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 6")
def topn_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("at")
    return read(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(6).select("o_orderkey", at)


@query("SELECT l_orderkey, count(DISTINCT (l_returnflag, l_linestatus)) AS versions FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT (l_returnflag, l_linestatus)) > 1")
def distinct_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.divergent(read(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])


@query("SELECT count(*) AS planned, count(o) AS completed, count(*) - count(o) AS unfinished, min(CASE WHEN o IS NULL THEN k END) AS first_unfinished FROM (SELECT CAST(c_custkey AS VARCHAR) AS k, o FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON o = c_custkey)")
def plan_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("partition_id"))
    done = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("partition_id"))
    return reconcile.ledger(plan, done)


@query("SELECT user_id, count(*) AS gap_count, CAST(sum(b - a) AS BIGINT) AS gap_total FROM (SELECT user_id, epoch_us(ts) AS a, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b - a > 36000000000 GROUP BY user_id")
def gap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    g = events(spark, sf_dir).select(F.col("user_id").cast("string").alias("condition_id"), F.lit("t").alias("token_id"), F.col("us").alias("gap_start"), F.lead("us").over(w).alias("gap_end"))
    e = quality.gap_evidence(g.where(F.col("gap_end") - F.col("gap_start") > 36_000_000_000))
    return e.select(F.col("condition_id").cast("long").alias("user_id"), "gap_count", F.col("gap_total_ns").alias("gap_total"))


# The queries over markets, archives and publication register themselves.
from gridfold import queries_archive, queries_plans  # noqa: E402

__all__ = ["ORACLE_SQL", "QUERIES", "queries_archive", "queries_plans"]
