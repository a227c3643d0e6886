"""Which markets are usable, and the evidence for those that aren't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.functions.values import canonical_json

#: How the table of exclusions words a gap, in words of our own: the source isn't named.
UNFIT = "source fidelity cannot satisfy the frozen 1h tier"


def gap_evidence(gaps: DataFrame) -> DataFrame:
    """condition_id, gap_count, gap_intervals_ns (by token), gap_total_ns."""
    span = F.struct("token_id", F.array("gap_start", "gap_end").alias("span"))
    return gaps.groupBy("condition_id").agg(
        F.count("*").alias("gap_count"),
        F.transform(F.array_sort(F.collect_list(span)), lambda x: x["span"]).alias("gap_intervals_ns"),
        F.sum(F.col("gap_end") - F.col("gap_start")).alias("gap_total_ns"),
    )


def first_errors(errors: DataFrame) -> DataFrame:
    """Of each market the error of its least token."""
    return errors.groupBy("condition_id").agg(F.min(F.struct("token_id", "error_kind", "error")).alias("e")).select("condition_id", "e.error_kind", "e.error")


def verdict(timeframe: Column, outcome: Column, error_kind: Column, has_events: Column, gap_count: Column) -> Column:
    """The reason for excluding a market, or null."""
    return (
        F.when(error_kind.isNotNull(), error_kind)
        .when(timeframe != "1h", "UNSUPPORTED_TIMEFRAME")
        .when(outcome == "UNRESOLVED", "UNRESOLVED_MARKET")
        .when(~has_events | (F.coalesce(gap_count, F.lit(0)) > 0), "SOURCE_GAP")
    )


def classify(markets: DataFrame, errors: DataFrame, gaps: DataFrame, with_events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted markets with their tier, and exclusions with evidence."""
    joined = (
        markets.join(first_errors(errors), "condition_id", "left")
        .join(gap_evidence(gaps), "condition_id", "left")
        .join(with_events.select("condition_id").distinct().withColumn("has_events", F.lit(True)), "condition_id", "left")
    )
    reason = verdict(F.col("timeframe"), F.col("official_outcome"), F.col("error_kind"), F.coalesce("has_events", F.lit(False)), F.col("gap_count"))
    judged = joined.withColumn("reason_code", reason)
    accepted = judged.where("reason_code IS NULL").select(*[c for c in markets.columns if c != "quality_tier"], F.lit("TIER_A").alias("quality_tier"))
    short = {"condition_id": F.col("condition_id"), "market_evidence_sha256": F.col("evidence_sha256")}
    full = short | {"official_outcome": F.col("official_outcome"), "resolution_source_url": F.col("resolution_source_url")}
    with_gaps = full | {k: F.col(k) for k in ("gap_count", "gap_intervals_ns", "gap_total_ns")}
    evidence = F.when(F.col("error_kind").isNotNull(), canonical_json(**short)).when(F.col("gap_count") > 0, canonical_json(**with_gaps)).otherwise(canonical_json(**full))
    detail = (
        F.when(F.col("error_kind") == "EVENT_CONFLICT", F.concat(F.lit("invalid market evidence: "), F.col("error")))
        .when(F.col("error_kind").isNotNull(), F.col("error"))
        .when(F.col("reason_code") == "UNSUPPORTED_TIMEFRAME", "only 1h is frozen")
        .when(F.col("reason_code") == "UNRESOLVED_MARKET", "official outcome unresolved")
        .otherwise(UNFIT)
    )
    excluded = judged.where("reason_code IS NOT NULL").select("market_id", "reason_code", detail.alias("detail"), evidence.alias("evidence_json"))
    return accepted, excluded


def statistics(accepted: DataFrame, excluded: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: numbers of accepted markets, exclusions and samples, and the samples' first and last time."""
    counts = accepted.agg(F.count("*").alias("market_count")).join(F.broadcast(excluded.agg(F.count("*").alias("exclusion_count"))))
    times = samples.agg(F.count("*").alias("sample_count"), F.min("grid_ts_ns").alias("sample_min_ts_ns"), F.max("grid_ts_ns").alias("sample_max_ts_ns"))
    return counts.join(F.broadcast(times))  # rows of totals, one each


def tier(accepted: DataFrame) -> DataFrame:
    """One row: the lowest tier among accepted markets, or EXCLUDED without any."""
    return accepted.agg(F.coalesce(F.max("quality_tier"), F.lit("EXCLUDED")).alias("quality_tier"))


def partition_tier(accepted: DataFrame) -> str:
    return tier(accepted).first()[0]
