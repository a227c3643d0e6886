"""Identity of hourly markets: slugs, rules, outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridfold.functions.values import canonical_json, let

ZONE = "America/New_York"
#: How assets are named in slugs and in rules, and their pairs' pages.
SLUG_NAMES = {"BTC": "bitcoin", "ETH": "ethereum", "SOL": "solana", "XRP": "xrp", "DOGE": "dogecoin", "BNB": "bnb", "HYPE": "hype"}
RULE_NAMES = {
    "BTC": ("btc", "bitcoin"),
    "ETH": ("eth", "ethereum", "ether"),
    "SOL": ("sol", "solana"),
    "XRP": ("xrp", "ripple"),
    "DOGE": ("doge", "dogecoin"),
    "BNB": ("bnb", "binance coin"),
    "HYPE": ("hype", "hyperliquid"),
}
#: The forms of condition ids and of the pages that settle markets.
CONDITION = r"^0x[0-9a-f]{64}$"
SPOT_PAGE = r"^https://www\.binance\.com/en/trade/(BTC|ETH|SOL|XRP|DOGE|BNB)_USDT$"
FUTURES_PAGE = "https://www.binance.com/en/futures/HYPEUSDT"
#: What the rules must mention beside the asset, and the fields that say what a market is.
PAIR_SUFFIX, CANDLE, EXCHANGE = "/usdt", "1 hour candle", "binance"
AUTHORITY = (
    "asset", "venue", "timeframe", "event_id", "market_id", "condition_id", "token_up", "token_down", "market_start_ns", "market_end_ns",
    "rules_text_sha256", "resolution_source_url", "official_outcome", "official_resolution_ts_ns",
)
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _lookup(key: Column, pairs: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair]), key)


def hourly_slug(asset: Column, start: Column) -> Column:
    """The slug of an asset's market that starts at a UTC timestamp; null off the hour."""

    def text(local: Column) -> Column:
        hour = F.hour(local)
        clock = F.concat((F.pmod(hour - 1, F.lit(12)) + 1).cast("string"), F.when(hour < 12, "am").otherwise("pm"))
        month = F.get(F.array(*map(F.lit, MONTHS)), F.month(local) - 1)
        return F.concat_ws("-", _lookup(asset, SLUG_NAMES), F.lit("up-or-down"), month, F.dayofmonth(local).cast("string"), F.year(local).cast("string"), clock, F.lit("et"))

    return F.when((F.date_trunc("hour", start) == start) & asset.isin(*SLUG_NAMES), let(F.from_utc_timestamp(start, ZONE), text))


def named_asset(slug: Column) -> Column:
    """The asset that a slug begins with, be it canonical or not."""
    return _lookup(F.get(F.split(slug, "-", -1), 0), {v: k for k, v in SLUG_NAMES.items()})


def slug_asset(slug: Column) -> Column:
    return F.when(slug_start(slug).isNotNull(), named_asset(slug))


def slug_start(slug: Column) -> Column:
    """The UTC timestamp that a canonical slug names; null for any other text.

    The parts are read without checks; a slug is canonical if what was read spells it again."""

    def read(part: Column) -> Column:
        """part: asset, up, or, down, month, day, year, hour, et."""
        number = lambda i: F.get(part, i).try_cast("int")
        clock = F.get(part, 7)
        hour = F.left(clock, F.length(clock) - 2).try_cast("int") % 12 + F.when(F.right(clock, F.lit(2)) == "pm", 12).otherwise(0)
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.get(part, 4)).cast("int")
        local = F.try_make_timestamp(number(6), month, number(5), hour, F.lit(0), F.lit(0))
        asset = _lookup(F.get(part, 0), {v: k for k, v in SLUG_NAMES.items()})
        return let(F.to_utc_timestamp(local, ZONE), lambda s: F.when(hourly_slug(asset, s) == slug, s))

    return let(F.split(slug, "-", -1), read)


def outcome(prices: Column) -> Column:
    """UP, DOWN or SPLIT from the two settled prices; null otherwise."""

    def settled(p: Column) -> Column:
        is_ = lambda a, b: (F.size(p) == 2) & (F.get(p, 0) == a) & (F.get(p, 1) == b)
        return F.when(is_(1, 0), "UP").when(is_(0, 1), "DOWN").when(is_(0.5, 0.5), "SPLIT")

    return let(F.transform(prices, lambda x: x.try_cast("decimal(10,4)")), settled)


def bound_source(asset: Column, rules: Column, url: Column) -> Column:
    """The page of the hourly candle that the rules name, or null if they don't bind it."""

    def bound(x: Column) -> Column:
        page, low = x["page"], x["low"]
        spelled = F.lit(False)
        for a, names in RULE_NAMES.items():
            spelled = spelled | ((asset == a) & low.rlike(r"(?<![a-z0-9])(" + "|".join(names) + r")(?![a-z0-9])"))
        of_asset = F.when(asset == "HYPE", page == FUTURES_PAGE).otherwise(F.regexp_extract(page, SPOT_PAGE, 1) == asset)
        mentions = low.contains(F.concat(F.lower(asset), F.lit(PAIR_SUFFIX))) & low.contains(CANDLE) & low.contains(EXCHANGE)
        return F.when(of_asset & spelled & mentions, page)

    page = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "/+$", "")
    return let(F.struct(page.alias("page"), F.lower(rules).alias("low")), bound)


def authority(market: dict[str, Column]) -> Column:
    """What a market is, as canonical JSON: its digest tells whether two sources mean the same one."""
    return canonical_json(**{name: market[name] for name in AUTHORITY})
