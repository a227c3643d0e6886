"""Fixed schemas of the source rows and of the five published tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

PRICE, SIZE, VALUE = "decimal(9,4)", "decimal(18,6)", "decimal(24,8)"
LEVELS = f"array<struct<price:{PRICE},size:{SIZE}>>"
CONTRACT = "public-interchange/1.0.0"
SCHEMA_VERSION = "1.0.0"

SOURCE_DDL = f"""timestamp_received timestamp, timestamp timestamp, market binary, event_type string, asset_id string,
bids string, asks string, price {PRICE}, size {SIZE}, side string, best_bid {PRICE}, best_ask {PRICE},
fee_rate_bps int, transaction_hash string, old_tick_size {PRICE}, new_tick_size {PRICE}"""

#: Table: its columns and the order of its rows.
TABLES = {
    "markets": (
        """schema_version string, asset string, venue string, timeframe string, event_id string, market_id string,
condition_id string, token_up string, token_down string, market_start_ns bigint, market_end_ns bigint,
rules_text_sha256 string, resolution_source_url string, official_outcome string, official_resolution_ts_ns bigint,
quality_tier string, evidence_sha256 string, exclusion_reason string""",
        ("condition_id",),
    ),
    "book_events": (
        f"""condition_id string, token_id string, source_ts_ns bigint, receive_ts_ns bigint, source_object string,
source_row bigint, sequence bigint, event_type string, source_id string, bids {LEVELS}, asks {LEVELS}, side string,
price {PRICE}, size {SIZE}, best_bid {PRICE}, best_ask {PRICE}, old_tick_size {PRICE}, new_tick_size {PRICE},
fee_rate_bps int, transaction_hash string""",
        ("condition_id", "token_id", "receive_ts_ns", "sequence"),
    ),
    "book_200ms": (
        f"""condition_id string, token_id string, grid_ts_ns bigint, asof_source_ts_ns bigint,
asof_receive_ts_ns bigint, bids {LEVELS}, asks {LEVELS}, stale_ms bigint, source_event_sequence bigint,
quality_tier string, native_interval_ms int""",
        ("condition_id", "token_id", "grid_ts_ns"),
    ),
    "underlying": (
        f"""asset string, venue string, instrument_type string, symbol string, observation_kind string,
source_ts_ns bigint, receive_ts_ns bigint, value {VALUE}, source_path string, source_sha256 string,
is_settlement boolean""",
        ("asset", "source_ts_ns", "observation_kind"),
    ),
    "exclusions": ("market_id string, reason_code string, detail string, evidence_json string", ("market_id", "reason_code")),
}

#: Tables that stay with a partition and aren't published.
OWN = {
    "lineage": (
        """condition_id string, market_one bigint, market_two bigint, token_up string, token_down string,
source_object string, sha256 string, rows bigint""",
        ("condition_id", "source_object"),
    ),
}

ASSETS = ("BTC", "ETH", "SOL", "XRP", "DOGE", "BNB", "HYPE")
EVENT_TYPES = {"book": "BOOK", "price_change": "PRICE_CHANGE", "last_trade_price": "LAST_TRADE_PRICE", "tick_size_change": "TICK_SIZE_CHANGE"}


def table(name: str) -> StructType:
    return StructType.fromDDL((TABLES | OWN)[name][0].replace("\n", " "))


def row_order(name: str) -> tuple[str, ...]:
    return (TABLES | OWN)[name][1]


def source() -> StructType:
    return StructType.fromDDL(SOURCE_DDL.replace("\n", " "))
