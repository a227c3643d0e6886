"""Total order, duplicate removal and sequence numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Columns = Sequence[str | Column]

#: What tells events apart; where they come from doesn't.
PAYLOAD = (
    "condition_id", "token_id", "source_ts_ns", "receive_ts_ns", "event_type", "bids", "asks", "side", "price", "size",
    "best_bid", "best_ask", "old_tick_size", "new_tick_size", "fee_rate_bps", "transaction_hash",
)


def event_order() -> list[Column]:
    return [F.coalesce("receive_ts_ns", "source_ts_ns"), F.col("source_ts_ns"), F.col("source_object"), F.col("source_row")]


def fingerprint(columns: Columns) -> tuple[Column, Column]:
    """128 bits of what the columns hold. Which of them are null counts too: a hash alone skips nulls."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), *reversed(values), nulls)


def dedup_keep_first(df: DataFrame, payload: Columns, order: Columns, within: Columns = (), about: dict[str, Column] | None = None) -> DataFrame:
    """Of rows with an equal payload the first in the order; which one that is never depends on chance.

    The payload is grouped by its fingerprint, so wide and nested columns are hashed once and not compared.
    within: payload columns by which the rows are dealt out already. about: columns by name of what is to be known of
    all rows with a payload, as aggregates."""
    one, two = fingerprint(payload)
    same = Window.partitionBy(*within, "gf_one", "gf_two")
    numbered = df.withColumns({"gf_one": one, "gf_two": two}).withColumn("gf_n", F.row_number().over(same.orderBy(*order)))
    for name, aggregate in (about or {}).items():
        numbered = numbered.withColumn(name, aggregate.over(same))
    return numbered.where("gf_n = 1").drop("gf_one", "gf_two", "gf_n")


def sequence(df: DataFrame, partition: Columns, order: Columns, name: str = "sequence") -> DataFrame:
    """Dense numbers from 0 within each partition."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("long") - 1)


TOKEN = ("condition_id", "token_id")


def distinct_events(events: DataFrame, about: dict[str, Column] | None = None) -> DataFrame:
    """Events without duplicates, dealt out by token: equal payloads have equal tokens, so it is one shuffle,
    which numbering and rebuilding go on with."""
    return dedup_keep_first(events.repartition(*TOKEN), [c for c in PAYLOAD if c in events.columns], event_order(), TOKEN, about)


def number_events(events: DataFrame) -> DataFrame:
    """``sequence`` within each market, by token and time.

    Numbers are given by token, so that a busy market isn't one task; a token's first number is how many
    events the market's tokens before it have, which is known from a count for each token."""
    counts = events.groupBy(*TOKEN).agg(F.count("*").alias("gf_n"))
    before = Window.partitionBy("condition_id").orderBy("token_id").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("condition_id").alias("gf_condition"), F.col("token_id").alias("gf_token"), F.coalesce(F.sum("gf_n").over(before), F.lit(0)).alias("gf_first"))
    numbered = sequence(events, TOKEN, event_order(), "gf_own")
    same = F.col("condition_id").eqNullSafe(F.col("gf_condition")) & F.col("token_id").eqNullSafe(F.col("gf_token"))
    return numbered.join(first, same).withColumn("sequence", F.col("gf_own") + F.col("gf_first")).drop("gf_own", "gf_first", "gf_condition", "gf_token")


def order_events(events: DataFrame) -> DataFrame:
    """Events without duplicates, numbered within their market by token and time."""
    return number_events(distinct_events(events))


def batch_end(df: DataFrame, partition: Columns, order: Columns, time: str, name: str = "batch_end") -> DataFrame:
    """Whether the next row of the partition has another time, or there is none."""
    following = F.lead(time).over(Window.partitionBy(*partition).orderBy(*order))
    return df.withColumn(name, following.isNull() | (following != F.col(time)))
