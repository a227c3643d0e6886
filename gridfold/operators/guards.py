"""Checks that stop a job or name the rows at fault. Caps are errors: nothing is ever cut off."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.operators.joins import owned


class GuardError(ValueError):
    """A resource cap or a data contract is violated."""


def over_cap(df: DataFrame, keys: Sequence[str], cap: int, rows: str | None = None) -> DataFrame:
    """Keys with more rows than the cap, with their counts. rows: a column that says how many rows each stands for."""
    return df.groupBy(*keys).agg((F.count("*") if rows is None else F.sum(rows)).alias("rows")).where(F.col("rows") > cap)


def require_cap(df: DataFrame, keys: Sequence[str], cap: int, rows: str | None = None) -> DataFrame:
    worst = over_cap(df, keys, cap, rows).orderBy(F.desc("rows")).limit(1).collect()
    if worst:
        raise GuardError(f"{worst[0].asDict()} exceeds the cap of {cap} rows")
    return df


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def divergent(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys with more than one distinct value; nulls are values."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*values)).alias("versions")).where("versions > 1")


def require_empty(df: DataFrame, what: str) -> None:
    bad = df.limit(10).collect()
    if bad:
        raise GuardError(f"{what}: {[r.asDict() for r in bad]}")


def unique_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key; a key with two different rows is an error. One pass: the least and greatest row."""
    rest = F.struct(*[c for c in df.columns if c not in keys])
    text = F.concat_ws(" ", F.lit("rows differ for"), *[F.col(k).cast("string") for k in keys])
    both = df.groupBy(*keys).agg(F.min(rest).alias("gf_a"), F.max(rest).alias("gf_b"))
    checked = both.withColumn("gf_a", F.when(F.col("gf_a") == F.col("gf_b"), F.col("gf_a")).otherwise(F.raise_error(text)))
    return checked.select(*keys, "gf_a.*").select(*df.columns)


def over_caps(events: DataFrame, owners: DataFrame, caps: dict[str, int], before: DataFrame | None = None) -> DataFrame:
    """scope, key, rows, cap: what one object's events would push over a cap.

    owners: condition_id, asset; an event without owner is an error. before: condition_id, rows that the
    day has so far; they count for the caps by day. caps, each optional: market_object, asset_object,
    market_day, asset_day. Nothing is recorded here: the counts are checked before anything is kept."""
    new = owned(events.groupBy("condition_id").agg(F.count("*").alias("rows")), owners, "condition_id", "asset")
    day = new if before is None else new.unionByName(owned(before.select("condition_id", "rows"), owners, "condition_id", "asset"))
    parts = []
    for scope, cap in caps.items():
        kind, span = scope.split("_")
        # A market's key asks for its owner too, so that an event without one is an error in every scope.
        key = F.when(F.col("asset").isNotNull(), F.col("condition_id")) if kind == "market" else F.col("asset")
        rows = (new if span == "object" else day).groupBy(key.alias("key")).agg(F.sum("rows").alias("rows"))
        parts.append(rows.where(F.col("rows") > cap).select(F.lit(scope).alias("scope"), "key", "rows", F.lit(cap).cast("long").alias("cap")))
    return reduce(DataFrame.unionByName, parts)


def restored_counts(by_condition: DataFrame, owners: DataFrame) -> DataFrame:
    """asset, rows, markets from counts by condition; a condition without owner is an error."""
    return owned(by_condition, owners, "condition_id", "asset").groupBy("asset").agg(F.sum("rows").alias("rows"), F.count("*").alias("markets"))
