"""The engine's operators on fixtures that are built here."""

import hashlib
import io
import itertools
import json
import os
import random
import re
import zipfile
from datetime import UTC, date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from gridfold import pipeline, schemas, sinks
from gridfold.functions import identity, timefn, values
from gridfold.operators import book, grid, guards, joins, order
from gridfold.plans import calendar, reconcile
from gridfold.release import Release
from gridfold.sources import events as source
from gridfold.sources import markets as market_source
from gridfold.sources import prices

START_S = 1_777_662_000  # 2026-05-01T19:00:00Z
T = START_S * 1_000
NS = 1_000_000
COND = "0x" + "a" * 64
SIDE = '[["0.40","10.000000"]]', '[["0.60","12.000000"]]'
FIELDS = [x.split()[0] for x in schemas.SOURCE_DDL.replace("\n", " ").split(", ")]


def row(recv, src, kind, token, **more):
    at = lambda ms: datetime.fromtimestamp(ms / 1_000, UTC)
    base = dict.fromkeys(FIELDS) | {"timestamp_received": at(recv), "timestamp": at(src), "market": COND.encode(), "event_type": kind, "asset_id": token}
    return base | {k: D(v) if k in ("price", "size", "best_bid", "best_ask", "old_tick_size", "new_tick_size") else v for k, v in more.items()}


def snapshot(token="1", ms=0, bids=SIDE[0], asks=SIDE[1]):
    return row(T + ms, T + ms, "book", token, bids=bids, asks=asks)


def change(ms, price, size, side="BUY", token="1", **more):
    return row(T + ms, T + ms - 10, "price_change", token, side=side, price=price, size=size, **more)


def full():
    return [
        snapshot("1"), snapshot("2"), change(200, "0.45", "5.000000", best_bid="0.45", best_ask="0.60"),
        row(T + 300, T + 290, "tick_size_change", "1", old_tick_size="0.01", new_tick_size="0.001"),
        row(T + 400, T + 390, "last_trade_price", "1", side="BUY", price="0.46", size="1.000000", fee_rate_bps=100, transaction_hash="0x123"),
    ]


def scanned(spark, rows):
    df = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], schemas.source())
    return df.withColumn("source_object", F.lit("o")).withColumn("source_row", F.monotonically_increasing_id()).coalesce(1)


def markets(spark, cond=COND, up="1", down="2", **more):
    base = dict.fromkeys(f.name for f in schemas.table("markets")) | {
        "schema_version": "1.0.0", "asset": "BTC", "timeframe": "1h", "market_id": "m", "condition_id": cond, "token_up": up, "token_down": down,
        "market_start_ns": T * NS, "market_end_ns": T * NS + timefn.HOUR_NS, "official_outcome": "UP", "quality_tier": "TIER_A", "evidence_sha256": "e", "resolution_source_url": "u",
    } | more
    return spark.createDataFrame([tuple(base[f.name] for f in schemas.table("markets"))], schemas.table("markets"))


def ordered(spark, rows):
    return order.order_events(source.strict(source.decode(source.select_rows(scanned(spark, rows), markets(spark)))))


def rebuilt(spark, rows, token="1"):
    states, errors = book.reconstruct(ordered(spark, rows))
    pick = lambda df: df.where(F.col("token_id") == token)
    got = [(r["sequence"], [(x.price, x.size) for x in r["bids"]], [(x.price, x.size) for x in r["asks"]]) for r in pick(states).orderBy("sequence").collect()]
    return got, [(r["error_kind"], r["error"]) for r in pick(errors).collect()]


def test_trades_emit_no_state_and_increments_do(spark):
    states, errors = rebuilt(spark, full())
    assert len(states) == 3 and not errors
    assert states[1][1] == [(D("0.4500"), D("5")), (D("0.4000"), D("10"))]


def test_order_is_restored_and_duplicates_go(spark):
    one = rebuilt(spark, full())
    assert rebuilt(spark, full()[::-1]) == one
    assert ordered(spark, [snapshot(), snapshot(), snapshot("2")]).count() == 2
    assert ordered(spark, [snapshot(), snapshot(bids='[["0.40","11"]]'), snapshot("2")]).count() == 3


def test_zero_size_removes(spark):
    states, _ = rebuilt(spark, [snapshot(), change(200, "0.40", "0", best_ask="0.60")])
    assert states[-1][1] == []


def test_a_batch_is_judged_at_its_end(spark):
    rows = [snapshot(), change(200, "0.60", "0", "SELL"), change(200, "0.70", "3", "SELL", best_ask="0.70")]
    rows[2]["timestamp"] = datetime.fromtimestamp((T + 195) / 1_000, UTC)
    states, errors = rebuilt(spark, rows)
    assert not errors and states[-1][2][0][0] == D("0.70")


def test_claimed_best_prices_prune(spark):
    states, errors = rebuilt(spark, [snapshot(), change(200, "0.30", "1", best_bid="0.30")])
    assert not errors and [p for p, _ in states[-1][1]] == [D("0.30")]
    states, errors = rebuilt(spark, [snapshot(), change(200, "0.40", "0", best_bid="0")])
    assert not errors and states[-1][1] == []


def test_conflicts_are_rows(spark):
    _, errors = rebuilt(spark, [snapshot(), change(200, "0.30", "1", best_ask="0.55")])
    assert errors[0][0] == "EVENT_CONFLICT" and "best ask disagrees: reconstructed=0.60, claimed=0.55" in errors[0][1]
    _, errors = rebuilt(spark, [snapshot(), change(200, "0.65", "1")])
    assert errors[0][1].startswith("crossed or locked book: receive_ts_ns=")
    tick = lambda ms, a, b: row(T + ms, T + ms, "tick_size_change", "1", old_tick_size=a, new_tick_size=b)
    _, errors = rebuilt(spark, [snapshot(), tick(1, "0.01", "0.001"), tick(2, "0.01", "0.001")])
    assert errors[0][1].startswith("tick-size chain is inconsistent")


def test_a_batch_that_ends_in_a_trade_is_not_judged(spark):
    rows = [snapshot(), change(200, "0.65", "1"), row(T + 200, T + 199, "last_trade_price", "1", price="0.5", size="1")]
    states, errors = rebuilt(spark, rows)
    assert not errors and len(states) == 2


def test_increments_before_a_snapshot_count_for_nothing(spark):
    states, errors = rebuilt(spark, [change(10, "0.41", "1"), snapshot(ms=100), change(200, "0.45", "5")])
    assert len(states) == 2 and not errors
    _, errors = rebuilt(spark, [change(10, "0.41", "1")])
    assert errors[0][0] == "NO_INITIAL_SNAPSHOT"


def test_fold_against_a_plain_one(spark):
    r = random.Random(4)
    rows, bids, asks, expected = [snapshot(), snapshot("2")], {4000: 10}, {6000: 12}, []
    for i in range(200):
        side = r.choice(["BUY", "SELL"])
        cents, size = (r.randrange(5, 45) if side == "BUY" else r.randrange(55, 95)), r.choice([0, 0, 1, 2, 3])
        rows.append(change(100 * (i + 1), f"0.{cents:02d}", str(size), side))
        book_ = bids if side == "BUY" else asks
        book_.pop(cents * 100, None)
        if size:
            book_[cents * 100] = size
        expected.append((sorted(bids, reverse=True), sorted(asks)))
    states, errors = rebuilt(spark, rows)
    assert not errors
    assert [([int(p * 10_000) for p, _ in b], [int(p * 10_000) for p, _ in a]) for _, b, a in states[1:]] == expected


def test_selection_comes_before_decoding(spark):
    bad = lambda ms: row(T + ms, T, "nonsense", "1")
    rows = [bad(-3_600_001), snapshot(ms=-3_600_000), snapshot(ms=0), bad(3_600_000)]
    got = source.select_rows(scanned(spark, rows), markets(spark))
    assert got.count() == 2 and source.decode(got).where("error IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="no known event"):
        source.strict(source.decode(source.select_rows(scanned(spark, [bad(1)]), markets(spark)))).collect()


def test_shape_errors(spark):
    rows = [
        change(1, "0.4", "1", "HOLD"), change(2, "0.4", "-1"), row(T + 3, T, "last_trade_price", "1", price="0.4"),
        row(T + 4, T, "tick_size_change", "1", old_tick_size="0.01", new_tick_size="0"), snapshot(ms=5, bids=None), snapshot(ms=6, bids='[["0.4","0"]]'),
        snapshot(ms=7, bids='[["0.4","1"],["0.40","2"]]'), snapshot(ms=8, asks="{}"), change(9, "1.5", "1"), snapshot(ms=10, asks='[["0.45678","1"]]'),
    ]
    got = source.decode(source.select_rows(scanned(spark, rows), markets(spark))).orderBy("receive_ts_ns")
    assert [r["error"] for r in got.collect()] == [
        "a price change lacks its side, price or size", "a size is negative", "a trade lacks its price or size", "a tick is not positive", "no bids in a snapshot",
        "a snapshot has a level of size 0", "a snapshot has a price twice", "asks are no JSON array", "a price is beyond its bounds", "a level is no decimal of this type",
    ]


def test_levels_have_two_spellings(spark):
    df = spark.createDataFrame([('[["0.4","1"],["0.5","2"]]',), ('[{"price":"0.4","size":"1"},{"price":"0.5","size":"2"}]',), ("[]",)], "t string")
    got = df.select(values.levels(F.col("t"), "bids")[0].alias("l")).collect()
    assert [[str(x.price) for x in r.l] for r in got] == [["0.5000", "0.4000"]] * 2 + [[]]


def test_grid_and_gaps(spark):
    tables = pipeline.transform(pipeline.Inputs("BTC/1h/2026-05-01", markets(spark), scanned(spark, full())))
    assert tables.book_200ms.count() == 36_000 and tables.exclusions.count() == 0
    at = lambda ms: tables.book_200ms.where((F.col("token_id") == "1") & (F.col("grid_ts_ns") == (T + ms) * NS)).first()
    assert at(0)["bids"][0].price == D("0.40") and at(200)["bids"][0].price == D("0.45")
    assert at(1_000)["stale_ms"] == 700 and at(1_000)["source_event_sequence"] == 2


def excluded(spark, rows, **more):
    t = pipeline.transform(pipeline.Inputs("BTC/1h/2026-05-01", markets(spark, **more), scanned(spark, rows)))
    assert t.markets.count() == t.book_events.count() == t.book_200ms.count() == 0
    x = t.exclusions.first()
    return x["reason_code"], x["detail"], json.loads(x["evidence_json"])


def test_late_snapshots_are_gaps(spark):
    code, _, evidence = excluded(spark, [snapshot("1", 1_000), snapshot("2", 1_000)])
    assert code == "SOURCE_GAP" and evidence["gap_count"] == 2 and evidence["gap_total_ns"] == 2 * 10**9
    assert evidence["gap_intervals_ns"][0] == [T * NS, (T + 1_000) * NS]


def test_exclusions(spark):
    assert excluded(spark, [])[0] == "SOURCE_GAP"
    assert excluded(spark, [change(10, "0.41", "1")])[0] == "NO_INITIAL_SNAPSHOT"
    code, detail, evidence = excluded(spark, [snapshot(), snapshot("2"), change(200, "0.30", "1", best_ask="0.55")])
    assert code == "EVENT_CONFLICT" and detail.startswith("invalid market evidence: best ask") and set(evidence) == {"condition_id", "market_evidence_sha256"}
    assert excluded(spark, full(), official_outcome="UNRESOLVED")[0] == "UNRESOLVED_MARKET"
    assert excluded(spark, full(), timeframe="4h")[0] == "UNSUPPORTED_TIMEFRAME"


def test_build_verifies_and_does_nothing_twice(spark, tmp_path):
    inputs = pipeline.Inputs("BTC/1h/2026-05-01", markets(spark), scanned(spark, full()))
    state = sinks.StateStore(spark, tmp_path / "state")
    base = str(tmp_path / "out/asset=BTC/timeframe=1h/date=2026-05-01")
    first = pipeline.build(inputs, str(tmp_path / "out"), state)
    assert first["phase"] == "VERIFIED" and first["manifest"] and not first["no_op"]
    document = sinks.verify_partition(spark, base)
    assert document["statistics"] == {"market_count": 1, "exclusion_count": 0, "sample_count": 36_000, "sample_min_ts_ns": T * NS, "sample_max_ts_ns": T * NS + timefn.HOUR_NS - 200 * NS}
    assert {k: v["rows"] for k, v in document["tables"].items()} == {"markets": 1, "book_events": 5, "book_200ms": 36_000, "underlying": 0, "exclusions": 0}
    assert pipeline.build(inputs, str(tmp_path / "out"), state)["no_op"]
    with pytest.raises(sinks.Conflict):
        state.advance("BTC/1h/2026-05-01", "ACQUIRED", first["identity"])
    other = scanned(spark, [snapshot(), snapshot("2")])
    tables = pipeline.transform(pipeline.Inputs("x", markets(spark), other))
    with pytest.raises(sinks.Conflict):
        sinks.write_table(tables.book_events, "book_events", f"{base}/book_events")
    tables.release()
    assert not [x for x in os.listdir(base) if x.endswith(".part")]


def test_the_fold_runs_once_a_build(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)
    rows = scanned(spark, full())
    counted = rows.rdd.map(lambda r: (runs.add(1), r)[1])
    inputs = pipeline.Inputs("BTC/1h/2026-05-01", markets(spark), spark.createDataFrame(counted, rows.schema))
    pipeline.build(inputs, str(tmp_path / "out"), sinks.StateStore(spark, tmp_path / "state"))
    assert runs.value <= 2 * len(full())


def test_limits_are_errors_before_anything_has_its_name(spark, tmp_path):
    """Caps on rows count repeats, in the pass that drops them; caps on tables are held against what tasks wrote."""
    rows = [*full(), full()[2]]
    inputs = lambda k, **limits: pipeline.Inputs("BTC/1h/2026-05-01", markets(spark), scanned(spark, rows), limits=pipeline.Limits(**limits))
    for k, limits in enumerate(({"rows_a_market": 5}, {"events": 5}, {"samples": 35_999})):
        with pytest.raises(guards.GuardError):
            pipeline.build(inputs(k, **limits), str(tmp_path / f"out{k}"), sinks.StateStore(spark, tmp_path / f"state{k}"))
        assert not list((tmp_path / f"out{k}").rglob("book_200ms/*.parquet")) and not list((tmp_path / f"out{k}").rglob("manifest.json"))
    plan = pipeline.transform(inputs(9, rows_a_market=6, events=6))
    assert plan.book_200ms.count() == 36_000
    plan.release()


def test_a_broken_write_leaves_nothing_and_is_repaired(spark, tmp_path):
    good = markets(spark)
    broken = good.withColumn("asset", F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("asset")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(broken, "markets", str(tmp_path / "p/markets"))
    assert not (tmp_path / "p/markets").exists()
    assert sinks.write_table(good, "markets", str(tmp_path / "p/markets")) == sinks.write_table(good, "markets", str(tmp_path / "p/markets"))
    assert [x for x in os.listdir(tmp_path / "p") if not x.startswith(".")] == ["markets"]


def test_a_changed_file_fails_verification(spark, tmp_path):
    state = sinks.StateStore(spark, tmp_path / "state")
    pipeline.build(pipeline.Inputs("BTC/1h/2026-05-01", markets(spark), scanned(spark, full())), str(tmp_path / "out"), state)
    base = tmp_path / "out/asset=BTC/timeframe=1h/date=2026-05-01"
    content = (base / "manifest.json").read_bytes()
    markets(spark, market_id="other").write.mode("overwrite").parquet(str(base / "markets"))
    with pytest.raises(ValueError, match="other rows"):
        sinks.verify_partition(spark, str(base))
    for crc in base.glob(".*.crc"):
        crc.unlink()
    (base / "manifest.json").write_bytes(content.replace(b'":', b'": '))
    with pytest.raises(ValueError, match="canonical"):
        sinks.verify_partition(spark, str(base))


def test_rows_may_come_in_any_order_and_split(spark):
    a = pipeline.transform(pipeline.Inputs("x", markets(spark), scanned(spark, full())))
    b = pipeline.transform(pipeline.Inputs("x", markets(spark), scanned(spark, full()).repartition(3)))
    assert sinks.logical_digest(a.book_200ms) == sinks.logical_digest(b.book_200ms)


def test_times(spark):
    df = spark.createDataFrame([("2026-05-01T19:00:00.123456Z", "2026-05-01T19:00:00")], "a string, b string")
    x = df.select(timefn.iso_to_ns(F.col("a")).alias("a"), timefn.iso_to_ns(F.col("b")).alias("b"), timefn.ns_to_iso(F.lit(T * NS + 7)).alias("c"), timefn.file_hour_ns(F.lit("book_2026-05-01T19.parquet")).alias("d")).first()
    assert x == (T * NS + 123_456_000, None, "2026-05-01T19:00:00.000000007Z", T * NS)


def test_slugs(spark):
    df = spark.createDataFrame([(a,) for a in schemas.ASSETS], "asset string").withColumn("start", F.timestamp_seconds(F.lit(START_S)))
    s = df.withColumn("slug", identity.hourly_slug(F.col("asset"), F.col("start")))
    got = s.select("asset", "slug", identity.slug_asset(F.col("slug")).alias("a"), (identity.slug_start(F.col("slug")) == F.col("start")).alias("same")).collect()
    assert got[0]["slug"] == "bitcoin-up-or-down-may-1-2026-3pm-et" and all(r["a"] == r["asset"] and r["same"] for r in got)
    assert spark.range(1).select(identity.slug_start(F.lit("bitcoin-up-or-down-may-01-2026-3pm-et"))).first()[0] is None


def payload(**more):
    m = {
        "id": "7", "slug": "bitcoin-up-or-down-may-1-2026-3pm-et", "conditionId": COND, "outcomes": '["Up","Down"]', "clobTokenIds": '["1","2"]', "closed": True, "outcomePrices": '["1","0"]',
        "endDate": "2026-05-01T20:00:00Z", "resolutionSource": "https://www.binance.com/en/trade/BTC_USDT",
        "description": "Up if greater than or equal, otherwise down: the Binance 1 hour candle of BTC/USDT.",
    } | more
    return json.dumps([{"id": "3", "markets": [m]}])


def test_market_payloads(spark):
    cases = [
        (payload(), "ok"), (payload(clobTokenIds=None), "gap"), (payload(closed=False), "unresolved"), (payload(outcomePrices='["0.7","0.3"]'), "unresolved"),
        (payload(outcomes='["Down","Up"]'), "error: not so: the outcomes are Up and Down"), (payload(description="x"), "error: not so: the rules name the hourly candle"),
        (payload(endDate="2026-05-01T21:00:00Z"), "error: not so: the end is an hour after the slug's start"), (payload(conditionId="0x1"), "error: not so: the condition id is 64 hexadecimal digits"),
    ]
    for text, expected in cases:
        got = market_source.bind(spark.createDataFrame([(text,)], "payload string")).first()
        assert got["disposition"] == expected
    got = market_source.bind(spark.createDataFrame([(payload(),)], "payload string")).first()
    assert (got["token_up"], got["official_outcome"], got["market_start_ns"]) == ("1", "UP", T * NS)
    assert got["evidence_sha256"] == hashlib.sha256(payload().encode()).hexdigest()


def a_zip(name, text):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, text)
    return out.getvalue()


def test_price_archives(spark, tmp_path):
    def pack(name, text):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("x.csv", text)
        (tmp_path / name).write_bytes(out.getvalue())
        return str(tmp_path / name)

    a = prices.read_zips(spark, pack("a.zip", "1,0.1,2,0.2,1735689600000000,False\n"), "BTC", "trades").first()
    assert (a["source_ts_ns"], a["value"]) == (1_735_689_600 * 10**9, D("0.1"))
    b = prices.read_zips(spark, pack("b.zip", "open_time,open,high,low,close\n1748601000000,33,34,32,33.5\n"), "HYPE", "klines").first()
    assert (b["source_ts_ns"], b["value"], b["instrument_type"]) == (1_748_601_000 * 10**9, D("33.5"), "usds_m_perpetual")
    two = io.BytesIO()
    with zipfile.ZipFile(two, "w") as z:
        z.writestr("x.csv", "1")
        z.writestr("y.csv", "1")
    for content, most in ((two.getvalue(), 9), (a_zip("../x.csv", "1"), 9), (a_zip("x.csv", "1234567890"), 9)):
        with pytest.raises(ValueError):
            prices.csv_of(content, most)
    with pytest.raises(Exception, match="checksum"):
        prices.read_zips(spark, pack("c.zip", "1,0.1,2,0.2,1,False\n"), "BTC", "trades", "00").collect()


def test_price_archives_are_read_in_slices(spark, tmp_path):
    """An archive of 60 MB unpacked: the reader holds a slice, and lines beyond a bound never become rows."""
    import resource

    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    lines = "".join(f"1,{k % 97 + 1}.5,2,0.2,{1_735_689_600_000_000 + k},False\n" for k in range(1_400_000))
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.csv", "id,price,qty,quote,time,maker\n" + lines)
    del lines
    reader = prices._Reader({"paths": "[]", "asset": "BTC", "kind": "trades", "most": str(1 << 30)})
    part = prices.Archive(str(tmp_path / "big.zip"))
    next(reader.read(part))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert sum(b.num_rows for b in reader.read(part)) == 1_400_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 40_000  # KiB
    some = prices.read_zips(spark, str(tmp_path / "big.zip"), "BTC", "trades").where(F.col("source_ts_ns") < 1_735_689_600_000_005_000)
    assert some.count() == 5
    again = list(reader.pushFilters([LessThan(("source_ts_ns",), 1_735_689_600_000_005_000), GreaterThanOrEqual(("source_ts_ns",), 1_735_689_600_000_002_000)]))
    assert len(again) == 2 and sum(b.num_rows for b in reader.read(part)) == 4  # a bound's own row may come: Spark filters again
    with pytest.raises(ValueError, match="more than"):
        list(prices._Reader({"paths": "[]", "asset": "BTC", "kind": "trades", "most": "1000000"}).read(part))


def test_calendar(spark):
    start, cutoff = datetime(2026, 4, 18, 20, tzinfo=UTC), datetime(2026, 8, 10, 1, tzinfo=UTC)
    assert calendar.market_starts(spark, date(2026, 4, 18), start, cutoff).count() == 4
    assert calendar.market_starts(spark, date(2026, 5, 18), start, cutoff).count() == 24
    plan = calendar.backfill_plan(spark, date(2026, 4, 18), date(2026, 8, 10), "g-")
    sizes = [r["count"] for r in plan.groupBy("release_group").count().collect()]
    assert plan.count() == 805 and len(sizes) == 8 and max(sizes) <= 112
    hours = calendar.market_starts(spark, date(2026, 5, 18), start, cutoff).withColumn("d", F.lit(1))
    assert [r["count"] for r in calendar.segments(hours, ["d"], ["start_s"], 4).groupBy("segment").count().orderBy("segment").collect()] == [6] * 4
    assert calendar.source_hours(spark, T * NS, T * NS + timefn.HOUR_NS + 1).count() == 2
    turns = calendar.round_robin(spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")], "g string, d string"), "g", "d")
    assert [(r["g"], r["d"]) for r in turns.collect()] == [("a", "1"), ("b", "1"), ("a", "2"), ("b", "2")]


def test_minimum_cover():
    usable = {1: frozenset("ab"), 2: frozenset("a"), 3: frozenset("b"), 4: frozenset("ab")}
    assert calendar.minimum_cover(usable, ("a", "b")) == (4,)
    assert calendar.minimum_cover({1: frozenset("a"), 2: frozenset("a"), 3: frozenset("b")}, ("a", "b")) == (3, 2)
    with pytest.raises(ValueError):
        calendar.minimum_cover({1: frozenset("a")}, ("a", "b"))
    r = random.Random(1)
    for _ in range(60):  # against all covers: the fewest starts, then the latest
        some = {i: frozenset(x for x in "abcd" if r.random() < 0.4) for i in range(7)}
        covers = [c[::-1] for n in range(1, 5) for c in itertools.combinations(sorted(some), n) if frozenset().union(*(some[i] for i in c)) >= set("abcd")]
        if covers:
            assert calendar.minimum_cover(some, tuple("abcd")) == max(covers, key=lambda c: (-len(c), c))


def test_reconciliation(spark):
    def name(part, file, digest="0" * 64):
        return (f"{part}--{digest}--{file}", "uploaded")

    rows = [name("BTC--1h--2026-05-01", f) for f in reconcile.FILES] + [name("ETH--1h--2026-05-01", "markets.parquet"), name("SOL--1h--2026-05-01", "odd.txt"), name("ETH--1h--2026-05-01", "markets.parquet", "1" * 64)]
    listing = reconcile.parse_listing(spark.createDataFrame(rows, "name string, state string"))
    plan = spark.createDataFrame([("BTC/1h/2026-05-01",), ("ETH/1h/2026-05-01",)], "partition_id string")
    assert [r[0] for r in reconcile.complete(listing).collect()] == ["BTC/1h/2026-05-01"]
    assert {tuple(r) for r in reconcile.anomalies(listing, plan).collect()} == {
        ("partial", "ETH/1h/2026-05-01"), ("divergent", "ETH/1h/2026-05-01/markets.parquet"), ("duplicate", "ETH/1h/2026-05-01/markets.parquet"),
        ("unexpected_files", "SOL/1h/2026-05-01/odd.txt"), ("out_of_plan", "SOL/1h/2026-05-01"),
    }
    assert tuple(reconcile.ledger(plan, reconcile.complete(listing)).first()) == (2, 1, 1, "ETH/1h/2026-05-01")


def test_guards_and_sets(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(guards.GuardError):
        guards.require_cap(df, ["k"], 1)
    with pytest.raises(Exception, match="rows differ for 2"):
        guards.unique_records(df, ["k"]).collect()
    assert guards.unique_records(df.where("k = 1"), ["k"]).count() == 1
    got = joins.compare_sets(spark.range(3), spark.range(1, 20), "id")
    assert got.where("side = 'missing'").count() == 1 and got.where("side = 'unexpected'").count() == 10
    with pytest.raises(Exception, match="no o for k"):
        joins.owned(df, spark.createDataFrame([(1, "x")], "k int, o string"), "k", "o").collect()


def test_lookahead_is_an_error(spark):
    with pytest.raises(Exception, match="lookahead"):
        spark.createDataFrame([(1, 2)], "g long, t long").select(grid.staleness("g", "t", 1)).collect()


@pytest.fixture
def folder(tmp_path):
    out = tmp_path / "partition"
    for name, content in (("manifest.json", b"{}"), ("markets/part-0.parquet", b"m" * 9), ("book_events/part-0.parquet", b"a"), ("book_events/part-1.parquet", b"b"), ("markets/_files.json", b"[]")):
        (out / name).parent.mkdir(parents=True, exist_ok=True)
        (out / name).write_bytes(content)
    return out


def test_publishing(spark, tmp_path, folder):
    release = Release(spark, tmp_path / "out", "data-2026-05-a")
    sha = hashlib.sha256(b"m" * 9).hexdigest()
    first = release.publish("BTC/1h/2026-05-01", str(folder))
    assert [(r["filename"], r["bytes"], r["state"]) for r in first] == [
        ("book_events-00001.parquet", 1, "uploaded"), ("book_events-00002.parquet", 1, "uploaded"), ("manifest.json", 2, "uploaded"), ("markets.parquet", 9, "uploaded"),
    ]
    assert (tmp_path / "out/data-2026-05-a" / f"BTC--1h--2026-05-01--{sha}--markets.parquet").read_bytes() == b"m" * 9
    assert {r["state"] for r in release.publish("BTC/1h/2026-05-01", str(folder))} == {"present"}
    (folder / "markets/part-0.parquet").write_bytes(b"other")
    with pytest.raises(Exception, match="another markets.parquet"):
        release.publish("BTC/1h/2026-05-01", str(folder))
    assert sinks.folder_bytes(spark, str(tmp_path / "out")) >= 13
    assert sinks.tree_digest({"a": b"x\r\n"}) == sinks.tree_digest({"a": b"x\n"}) != sinks.tree_digest({"b": b"x\n"})


def test_a_broken_publication_goes_on_where_it_stopped(spark, tmp_path, folder):
    release = Release(spark, tmp_path / "out", "data-2026-05-a")
    release.publish("BTC/1h/2026-05-01", str(folder))
    out = tmp_path / "out/data-2026-05-a"
    gone = next(out.glob("*markets.parquet"))
    (out / f".{gone.name}.1234.partial").write_bytes(gone.read_bytes()[:3])
    gone.unlink()
    again = release.publish("BTC/1h/2026-05-01", str(folder))
    assert {r["filename"]: r["state"] for r in again}["markets.parquet"] == "uploaded" and sum(r["state"] == "present" for r in again) == 3
    assert {r["state"] for r in release.verified("data").collect()} == {"uploaded"}
    next(out.glob("*manifest.json")).write_bytes(b"{ }")
    (out / "readme.txt").write_text("x")
    assert sorted(r["state"] for r in release.verified("other").collect()) == ["noncanonical"] + ["release"] * 4
    assert sorted(r["state"] for r in release.verified().collect()) == ["digest", "noncanonical", "uploaded", "uploaded", "uploaded"]
    release.finalise()
    with pytest.raises(sinks.Conflict):
        release.publish("BTC/1h/2026-05-01", str(folder))
    with pytest.raises(sinks.Conflict):
        release.finalise()


def test_publishing_takes_no_memory_of_the_driver(spark, tmp_path):
    """A file of 300 MB is hashed and copied in chunks; neither the driver's Python nor its JVM holds it."""
    import resource

    (tmp_path / "p").mkdir()
    with (tmp_path / "p/book_events.parquet").open("wb") as f:
        f.truncate(300 << 20)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert Release(spark, tmp_path / "out", "t").publish("BTC/1h/2026-05-01", str(tmp_path / "p"))[0]["bytes"] == 300 << 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 30_000  # KiB


def test_of_two_writers_one_advances(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    state = sinks.StateStore(spark, tmp_path / "state")
    state.advance("BTC/1h/2026-05-01", "INVENTORIED", "i")

    def attempt(k):
        try:
            return state.advance("BTC/1h/2026-05-01", "ACQUIRED", "i", str(k))
        except sinks.Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        found = [x for x in pool.map(attempt, range(8)) if x]
    assert found and state.read("BTC/1h/2026-05-01") == found[0] and len({json.dumps(x) for x in found}) == 1
    assert [x["phase"] for x in state.history("BTC/1h/2026-05-01")] == ["INVENTORIED", "ACQUIRED"]
    with pytest.raises(sinks.Conflict):
        state.advance("BTC/1h/2026-05-01", "INVENTORIED", "i")


def test_a_file_is_created_once(spark, tmp_path):
    from gridfold.storage import Store

    store = Store(spark, str(tmp_path))
    assert store.create("a", b"1") and not store.create("a", b"2") and store.read("a") == b"1"
    store.write("a", b"3")
    assert store.read("a") == b"3" and store.names() == ["a"]


def test_tasks_report_their_files(spark, tmp_path):
    import pyarrow.parquet as pq

    from gridfold import tablefiles

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7000")
    try:
        tablefiles.write(spark.range(0, 100_000, 1, 1).withColumn("d", F.col("id").cast("decimal(9,4)")), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    (file,) = json.loads((tmp_path / "t/_files.json").read_text())
    content = (tmp_path / "t" / file["name"]).read_bytes()
    assert (file["rows"], file["bytes"], file["sha256"]) == (100_000, len(content), hashlib.sha256(content).hexdigest())
    meta = pq.read_metadata(tmp_path / "t" / file["name"])
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [65_536, 34_464]
    assert meta.row_group(0).column(0).compression == "ZSTD" and meta.row_group(0).column(0).has_dictionary_page is False
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("id")).first()[0] == 4_999_950_000
    tablefiles.write(spark.range(0), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    from gridfold import tablefiles

    bad = spark.range(0, 1_000, 1, 2).withColumn("x", F.when(F.col("id") == 900, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="no"):
        tablefiles.write(bad, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_stream_holds_markets_until_their_end(spark, tmp_path):
    from gridfold.streaming import replay

    hour = timefn.HOUR_NS
    rows = [(COND, T * NS + i * 10**9, T * NS + hour, i) for i in range(5)] + [("0xb", T * NS + 3 * hour, T * NS + 4 * hour, 9)]
    schema = "condition_id string, receive_ts_ns long, market_end_ns long, n int"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = replay.sink(replay.finalised(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {r["condition_id"] for r in got.collect()} == {COND} and got.count() == 5


def test_live_samples_equal_the_batch(spark, tmp_path):
    """Late, repeated and unordered events, in files that each move the watermark: the same samples as from all at once."""
    from gridfold.streaming import live, replay

    r, step = random.Random(4), 30_000 * NS
    rows = [snapshot("1", -5_000), snapshot("2", 70_000)]
    for k in range(300):
        at, token = r.randrange(-4_000, 600_000), r.choice("12")
        side = r.choice(["BUY", "SELL"])
        price = D(r.randrange(5, 45) if side == "BUY" else r.randrange(55, 95)) / 100
        rows.append(change(at, str(price), f"{r.randrange(0, 4)}.000000", side, token) if k % 9 else snapshot("1", at))
        if k % 7 == 0:
            rows.append(rows[-1])
    ms = lambda x: int(x["timestamp_received"].timestamp() * 1_000) - T
    parts = [[], [], [], []]
    for x in rows:
        parts[min(3, max(0, (ms(x) + r.randrange(0, 25_000)) // 160_000))].append(x)
    other = "0x" + "b" * 64
    both = markets(spark).union(markets(spark, other, "3", "4", market_start_ns=(T + 7_200_000) * NS, market_end_ns=(T + 10_800_000) * NS))
    parts.append([row(T + 7_300_000, T + 7_300_000, "book", "3", bids=SIDE[0], asks=SIDE[1]) | {"market": other.encode()}])
    decode = lambda some: source.strict(source.decode(source.select_rows(scanned(spark, some), both)))
    for k, some in enumerate(parts):
        decode(some).withColumn("source_row", F.col("source_row") + 1_000 * k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = live.samples(replay.admitted(stream, both), step).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    got = spark.read.schema(live.OUT).parquet(str(tmp_path / "out")).where(F.col("condition_id") == COND)
    batch = order.order_events(spark.read.parquet(str(tmp_path / "in")).where(F.col("condition_id") == COND))
    states, errors = book.reconstruct(batch)
    bounds = states.withColumns({"start": F.lit(T * NS), "end": F.lit(T * NS + timefn.HOUR_NS)})
    wanted = grid.asof_grid(bounds, ["condition_id", "token_id"], "receive_ts_ns", ["sequence"], step, grid="grid_ts_ns")
    columns = ["token_id", "grid_ts_ns", "source_ts_ns", "receive_ts_ns", "bids", "asks"]
    want = sorted(map(tuple, wanted.select(columns).collect()))
    assert errors.count() == 0 and len(want) == 120 + 117
    assert sorted(map(tuple, live.as_levels(got).select(columns).collect())) == want


def test_forensics(spark):
    from gridfold.operators import forensics

    e = ordered(spark, full())
    assert {(r["token_id"], r["event_type"]): r["rows"] for r in forensics.profile(e).collect()}[("1", "BOOK")] == 1
    near = forensics.around(e, (T + 300) * NS, 1).orderBy("sequence").collect()
    assert [r["event_type"] for r in near] == ["PRICE_CHANGE", "TICK_SIZE_CHANGE", "LAST_TRADE_PRICE"] and near[1]["old_tick_size"] == "0.0100"


def test_release_documents(tmp_path, capsys, spark, folder):
    from gridfold import cli

    Release(spark, tmp_path / "out", "t").publish("BTC/1h/2026-05-01", str(folder))
    assert cli.main(["verify-release", str(tmp_path / "out/t")]) == 0 and capsys.readouterr().out.count("uploaded") == 4
    next((tmp_path / "out/t").glob("*markets.parquet")).write_text("y")
    assert cli.main(["verify-release", str(tmp_path / "out/t")]) == 1
    capsys.readouterr()
    assert cli.main(["plan-backfill", "2026-05-01", "2026-05-01"]) == 0 and capsys.readouterr().out.count("\n") == 7
    manifests = [sinks.manifest(p, "TIER_A", {}, []) for p in ("ETH/1h/2026-05-01", "BTC/1h/2026-05-01")]
    index = sinks.release_index(manifests, "v1", 5)
    assert [(r["partition"], r["manifest_path"], r["byte_length"]) for r in index["partitions"]] == [
        (f"{a}/1h/2026-05-01", f"asset={a}/timeframe=1h/date=2026-05-01/manifest.json", len(sinks.canonical(manifests[0]))) for a in ("BTC", "ETH")
    ]
    said = sinks.notice([{"source_id": "x", "license_class": "EXCLUDED", "license": "CC-BY-4.0"}, {"source_id": "z", "license_class": "OK", "license": "CC-BY-4.0"}, {"source_id": "y", "license_class": "OK", "license": "MIT"}])
    assert [(s["source_id"], s["attribution_required"]) for s in said["sources"]] == [("y", False), ("z", True)]


def test_fragments_of_a_broken_run_do_not_count(spark, tmp_path):
    from gridfold.sources import staging

    events = spark.createDataFrame([("c1", 1), ("c2", 2), ("c1", 3)], "condition string, source_row long")
    held = staging.Fragments(spark, str(tmp_path))
    held.append(events, "a")
    held.append(events, "a")
    staging.encoded(events.withColumn("source", F.lit("b"))).write.parquet(str(tmp_path / "rows/b"))  # never committed
    assert {tuple(r) for r in held.read(events).select("condition", "source", "source_row").collect()} == {("c1", "a", 1), ("c2", "a", 2), ("c1", "a", 3)}
    assert {r["condition"]: r["rows"] for r in held.counts(events).collect()} == {"c1": 2, "c2": 1}
    held.append(events.unionByName(events), "c")
    with pytest.raises(guards.GuardError, match="twice"):
        held.read(events)


def test_fragments_are_read_by_bucket(spark, tmp_path):
    from gridfold.sources import staging

    url = "https://example.org/a b/2026-05-01T07.parquet?x=1#y"
    held = staging.Fragments(spark, str(tmp_path))
    one = spark.createDataFrame([("c7",)], "condition string")
    assert held.read(one).count() == 0 and held.read(one).columns == ["source_row", "condition", "source"]
    events = spark.range(2_000).select(F.concat(F.lit("c"), (F.col("id") % 500).cast("string")).alias("condition"), F.col("id").alias("source_row"))
    held.append(events, url)
    held.append(events.where("source_row < 1000").limit(0), "empty")
    got = held.read(one)
    assert sorted(tuple(r) for r in got.select("condition", "source", "source_row").collect()) == [("c7", url, 7 + 500 * k) for k in range(4)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    (chosen,) = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert "bucket" in chosen and str(spark.range(1).select(staging.bucket(F.xxhash64(F.lit("c7")))).first()[0]) in chosen


def test_caps_and_owners(spark):
    owners = spark.createDataFrame([("a", "BTC")], "condition_id string, asset string")
    with pytest.raises(Exception, match="no asset for condition_id"):
        guards.over_caps(spark.createDataFrame([("z",)], "condition_id string"), owners, {"market_object": 1}).collect()
    with pytest.raises(guards.GuardError):
        source.require_scannable(spark.createDataFrame([("o",), ("o",)], "source_object string"), 1)
    with pytest.raises(Exception, match="more than 1 rows"):
        joins.require_few(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], 1).collect()


def test_segments_must_cover_and_agree(spark):
    from gridfold.plans import segments

    def receipt(i, starts, outcome="UP", **more):
        market = {"market_id": "m", "condition_id": "c", "market_start_ns": 0, "official_outcome": outcome}
        return (json.dumps({"day": "d", "segment_index": i, "segment_count": 2, "market_starts": starts, "source_bytes": 1, "markets": [market], "files": []} | more),)

    read = lambda *rows: segments.receipts(spark.createDataFrame(list(rows), "receipt string"))
    starts = spark.createDataFrame([(0,), (3600,)], "start_s long")
    assert segments.assembled(read(receipt(0, [0]), receipt(1, [3600])), starts).count() == 1
    with pytest.raises(guards.GuardError, match="cover"):
        segments.assembled(read(receipt(0, [0]), receipt(1, [])), starts)
    with pytest.raises(guards.GuardError, match="missing"):
        segments.assembled(read(receipt(0, [0, 3600])), starts)
    with pytest.raises(Exception, match="rows differ"):
        segments.assembled(read(receipt(0, [0]), receipt(1, [3600], "DOWN")), starts).collect()
    with pytest.raises(Exception, match="no receipt"):
        read(receipt(0, None)).collect()


def test_dispositions_of_slots(spark):
    start = datetime.fromtimestamp(START_S, UTC)
    slots = spark.createDataFrame([("BTC", start), ("ETH", start)], "asset string, start timestamp")
    slug = "bitcoin-up-or-down-may-1-2026-3pm-et"
    given = lambda *rows: spark.createDataFrame(list(rows), "slug string, payload string")
    accepted, excluded = market_source.dispose(slots, given((slug, payload()), ("ethereum-up-or-down-may-1-2026-3pm-et", "[]")))
    assert [r["market_id"] for r in accepted.collect()] == ["7"]
    x = excluded.first()
    assert (x["market_id"], x["reason_code"], set(json.loads(x["evidence_json"]))) == ("ethereum-up-or-down-may-1-2026-3pm-et", "SOURCE_GAP", {"payload_sha256"})
    accepted, excluded = market_source.dispose(slots.where("asset = 'BTC'"), given((slug, payload(closed=False))))
    x = excluded.first()
    assert (x["market_id"], x["reason_code"]) == ("7", "UNRESOLVED_MARKET") and json.loads(x["evidence_json"])["slug"] == slug
    with pytest.raises(Exception, match="another slot"):
        market_source.dispose(slots.where("asset = 'ETH'"), given(("ethereum-up-or-down-may-1-2026-3pm-et", payload())))[0].collect()


def test_markets_are_pushed_to_the_scan(spark, tmp_path):
    scanned(spark, full()).drop("source_object", "source_row").write.parquet(str(tmp_path / "a"))
    plan = source.select_rows(source.scan(spark, str(tmp_path / "a")), markets(spark))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]", 1)[0]
    assert "market" in pushed and "timestamp_received" in pushed


def test_explicit_starts(spark):
    day, first = date(2026, 5, 1), START_S - 19 * 3_600
    given = lambda *s: spark.createDataFrame([(x,) for x in s], "start_s long")
    assert [r[0] for r in calendar.explicit_starts(given(first + 7_200, first, first), day).collect()] == [first, first + 7_200]
    for wrong in (first + 1, first - 3_600, first + 86_400):
        with pytest.raises(Exception, match="no hour"):
            calendar.explicit_starts(given(wrong), day).collect()


def test_certification(spark):
    plan = spark.createDataFrame([("a",), ("b",)], "partition_id string")
    manifests = lambda *rows: spark.createDataFrame(list(rows), "partition_id string, tier string, files long")
    assert reconcile.certify(plan, manifests(("a", "TIER_A", 6), ("b", "EXCLUDED", 6)))["TIER_A"] == 1
    for rows in ([("a", "TIER_A", 6)], [("a", "TIER_A", 6), ("b", "TIER_A", 5)], [("a", "TIER_A", 6), ("c", "TIER_A", 6)]):
        with pytest.raises(ValueError):
            reconcile.certify(plan, manifests(*rows))
    found = spark.createDataFrame([("partial", "x"), ("divergent", "y")], "kind string, item string")
    assert [r["item"] for r in reconcile.fatal(found).collect()] == ["y"]


def fold_batches(n, rows=10_000):
    """One token's events as the fold gets them, made as they are asked for."""
    import numpy as np
    import pyarrow as pa

    rng, none = np.random.default_rng(5), pa.array(np.full(rows, book.NONE))
    for k in range(n):
        at = np.arange(k * rows, (k + 1) * rows)
        kind = np.where(at % 5_000 == 0, book.BOOK, np.where(at % 2, book.BUY, book.SELL)).astype(np.int8)
        price = np.where(kind == book.BUY, rng.integers(100, 4_900, rows), rng.integers(5_100, 9_900, rows))
        side = lambda v: pa.array([[v] if b else None for b in kind == book.BOOK], pa.list_(pa.int64()))  # noqa: B023, E731
        numbers = {"source_ts_ns": pa.array(at * 1_000), "receive_ts_ns": pa.array(at * 1_000), "sequence": pa.array(at), "price": pa.array(price), "size": pa.array(rng.integers(0, 3, rows))}
        yield pa.RecordBatch.from_pydict({"kind": pa.array(kind), "last": pa.array(np.ones(rows, bool)), **numbers, "best_bid": none, "best_ask": none, "old_tick": none, "new_tick": none, "bid_prices": side(5_000), "bid_sizes": side(1), "ask_prices": side(5_050), "ask_sizes": side(1)})


def test_a_token_of_two_million_events_needs_no_more_memory():
    import resource

    peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert sum(x.num_rows for x in book.fold("0xm", "1", fold_batches(10), 500_000)) == 200 + 1  # the first instant is a cell of its own
    before = peak()
    assert sum(x.num_rows for x in book.fold("0xm", "1", fold_batches(200), 500_000)) == 4_000 + 1
    assert peak() - before < 50_000  # KiB


def test_the_fold_carries_its_state_from_batch_to_batch():
    whole = list(book.fold("0xm", "1", fold_batches(2, 500), 9_000))
    cut = (x.slice(a, 7) for x in fold_batches(2, 500) for a in range(0, 500, 7))
    assert [r for x in book.fold("0xm", "1", cut, 9_000) for r in x.to_pylist()] == [r for x in whole for r in x.to_pylist()]


def test_the_fold_takes_no_events_out_of_order():
    first, second = fold_batches(2)
    with pytest.raises(ValueError, match="out of order"):
        list(book.fold("0xm", "1", iter([second, first])))


def test_the_fold_sorts_once_even_if_a_key_is_constant(spark):
    events = ordered(spark, full()).withColumn("condition_id", F.lit(COND))
    plan = book.rebuilt(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [gf_token") == 1


def test_an_audit_shuffles_only_buckets_that_differ(spark):
    from gridfold.operators import audit

    left = spark.range(50_000).select((F.col("id") % 25_000).alias("k"), F.col("id").alias("v"), F.lit("x").alias("w"))
    right = left.where("v <> 7").withColumn("w", F.when(F.col("v") == 11, None).otherwise(F.col("w"))).repartition(5)
    assert audit.differing(left, left.repartition(3), ["k"]).count() == 0
    assert audit.differing(left, right, ["k"]).count() == 2
    assert sorted((r["k"], r["change"], list(r["columns"])) for r in audit.changes(left, right, ["k"]).collect()) == [(7, "changed", []), (11, "changed", [])]
    one = spark.createDataFrame([(1, None), (None, 2), (3, 3)], "k int, v int")
    two = spark.createDataFrame([(1, 1), (None, 2), (4, 3)], "k int, v int")
    assert sorted((str(r["k"]), r["change"], list(r["columns"])) for r in audit.changes(one, two, ["k"], 16).collect()) == [("1", "changed", ["v"]), ("3", "absent", []), ("4", "added", [])]
    assert audit.changes(one, one, ["k"]).count() == 0


def orders_at(spark, tmp_path, keys):
    spark.createDataFrame([(k, "O") for k in keys], "o_orderkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_receipts_stay_small_however_many_orders(spark, tmp_path):
    from gridfold import queries_plans as q

    at = orders_at(spark, tmp_path, [*range(4_003), 9_000_000])
    sizes = q.segments.receipts(q.day_receipts(spark, at)).select(F.size("markets").alias("n"), "day").collect()
    assert max(r["n"] for r in sizes) < q.DAY_ORDERS / 2 and len(sizes) == 4 * len({r["day"] for r in sizes}) == 24
    assert q.assembled_segments(spark, at).count() == 4_004


def test_files_told_twice_are_one(spark):
    from gridfold.plans import segments

    told = spark.createDataFrame([([("f", 1, "x")],), ([("f", 1, "x"), ("g", 1, "y")],)], f"files array<{segments._FILE}>")
    now = spark.createDataFrame([("g", 1, "y"), ("h", 1, "z")], "path string, byte_length long, sha256 string")
    assert sorted(map(tuple, segments.changed_files(told, now).collect())) == [("f", "absent"), ("h", "in no receipt")]


def test_markets_beyond_nanoseconds_bind(spark, tmp_path):
    from gridfold import queries_archive as q

    at = orders_at(spark, tmp_path, [12, 600_000, 600_001, 600_007, 54_000_000])
    got = {r["event_id"]: r for r in q.market_payloads(spark, at).collect()}
    assert got["e12"]["start_ns"] == (q.DAY_S + 12 * 14_400) * 10**9
    assert [got[f"e{k}"]["disposition"] for k in (600_000, 54_000_000)] == ["ok", "ok"] and got["e600000"]["start_ns"] is None
    assert got["e600001"]["disposition"].endswith("the slug is canonical") and got["e600007"]["disposition"].endswith("an hour after the slug's start")
    assert {r[0] for r in q.merged_markets(spark, at).collect()} == {f"0x{k:064d}" for k in (12, 600_000, 600_001, 600_007, 54_000_000) if k % 3 < 2}
    assert {r[1] for r in q.expected_starts(spark, at).collect()} == {"accepted", "SOURCE_GAP", "UNRESOLVED_MARKET"}


def test_price_archives_stay_small(spark, tmp_path, monkeypatch):
    from gridfold import queries_archive as q

    spark.createDataFrame([(k, 1, 1.5) for k in range(100)], "l_orderkey long, l_linenumber int, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(q, "ARCHIVE_LINES", 7)
    seen, whole = [], q.prices.from_archives
    monkeypatch.setattr(q.prices, "from_archives", lambda files, *a: seen.append(files) or whole(files, *a))
    assert q.price_archives(spark, str(tmp_path)).count() == 100
    assert max(len(q.prices.csv_of(r["content"], 1 << 20).split(b"\n")) for files in seen for r in files.collect()) <= 8


def test_conflicts_of_odd_payloads(spark):
    event = '{"id":"e","markets":[{"conditionId":"%s","x":%s}]}'
    texts = [f"[{event % ('a', '1.0')}]", '[{"markets":[{"x":1.0,"conditionId":"a"}],"id":"e"}]', f"[{event % ('b', '1')}]", f"[{event % ('b', '2')}, 7]", "no JSON", "{}", "[3]", None]
    conflicts = lambda *more: {r[0] for r in market_source.conflicts(spark.createDataFrame([(t,) for t in (*texts, *more)], "payload string")).collect()}
    assert conflicts() == {"b"}
    with pytest.raises(Exception, match="DUPLICATE_KEY"):
        conflicts('[{"id":1,"id":2,"markets":[{"conditionId":"a"}]}]')


def test_merging_parses_a_text_once(spark, monkeypatch):
    market = {"id": "m", "slug": "bitcoin-up-or-down-may-1-2026-3pm-et", "conditionId": "0x" + "a" * 64, "outcomes": '["Up","Down"]', "clobTokenIds": '["1","2"]', "closed": True, "outcomePrices": '["1","0"]', "endDate": "2026-05-01T20:00:00Z", "resolutionSource": "https://www.binance.com/en/trade/BTC_USDT", "description": "Greater than or equal, otherwise; BTC by the Binance 1 hour candle BTC/USDT"}
    text, turned, other = (json.dumps([x]) for x in ({"id": "e", "markets": [market]}, {"markets": [market], "id": "e"}, {"id": "f", "markets": [market]}))
    given = lambda *texts: spark.createDataFrame([(t,) for t in texts], "payload string").repartition(3)
    seen = []
    for name in ("bind", "conflicts"):
        whole = getattr(market_source, name)
        monkeypatch.setattr(market_source, name, lambda p, whole=whole: seen.append(p) or whole(p))
    got = market_source.merged(given(*[text, turned, "no JSON", None] * 5)).collect()
    assert [(r["condition_id"], r["token_up"]) for r in got] == [("0x" + "a" * 64, "1")]
    assert [p.count() for p in seen] == [4, 4]
    with pytest.raises(Exception, match="payloads differ on 0xa"):
        market_source.merged(given(text, text, other)).collect()


def test_binding_works_each_part_out_once(spark):
    plan = market_source.bind(spark.createDataFrame([("[]",)], "payload string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(StringType") == 3  # outcomes, tokens, prices
    assert plan.count("from_utc_timestamp") == plan.count("to_utc_timestamp") == 1
