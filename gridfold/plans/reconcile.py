"""Holding a published inventory against the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.functions.timefn import HOUR_NS, half_month

#: The files of a complete partition.
FILES = ("markets.parquet", "book_events.parquet", "book_200ms.parquet", "underlying.parquet", "exclusions.parquet", "manifest.json")
NAME = r"^(BTC|ETH|SOL|XRP|DOGE|BNB|HYPE)--1h--(\d{4}-\d{2}-\d{2})--([0-9a-f]{64})--(.+)$"


def parse_listing(listing: DataFrame, name: str = "name", release: str | None = None, prefix: str | None = None) -> DataFrame:
    """partition_id, filename and digest from names like ``BTC--1h--2026-05-01--<digest>--markets.parquet``, and a fault.

    No row goes. ``fault``: noncanonical, if a name isn't one; release, if ``prefix`` is given and the file
    stands in another half month's release than its day's; null for all others."""
    ok = F.col(name).rlike(NAME) & F.try_to_date(F.regexp_extract(name, NAME, 2), "yyyy-MM-dd").isNotNull()
    part = lambda i: F.when(ok, F.regexp_extract(name, NAME, i))
    parsed = listing.withColumns({"partition_id": F.when(ok, F.concat_ws("/", part(1), F.lit("1h"), part(2))), "filename": part(4), "digest": part(3)})
    fault = F.when(~F.coalesce(ok, F.lit(False)), "noncanonical")
    if release is not None and prefix is not None:
        fault = fault.when(~F.col(release).eqNullSafe(F.concat(F.lit(f"{prefix}-"), half_month(F.to_date(part(2))))), "release")
    return parsed.withColumn("fault", fault)


def listing_faults(parsed: DataFrame, name: str = "name") -> DataFrame:
    """kind, item: what a listing has that no partition can own. Each of these ends a run."""
    return parsed.where("fault IS NOT NULL").select(F.col("fault").alias("kind"), F.col(name).alias("item"))


def complete(inventory: DataFrame, files: tuple[str, ...] = FILES) -> DataFrame:
    """partition_id of partitions with exactly the expected files, each once and uploaded."""
    want = F.array(*map(F.lit, sorted(files)))
    seen = inventory.groupBy("partition_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("filename")).alias("names"), F.bool_and(F.col("state") == "uploaded").alias("up"))
    return seen.where((F.col("n") == len(files)) & (F.col("names") == want) & F.col("up")).select("partition_id")


def anomalies(inventory: DataFrame, plan: DataFrame, files: tuple[str, ...] = FILES) -> DataFrame:
    """kind, item: partial, divergent, duplicate, unexpected_files, out_of_plan.

    One aggregate by file, one of these by partition, and one join with the plan."""
    by_file = inventory.groupBy("partition_id", "filename").agg(F.count("*").alias("n"), F.min("digest").alias("a"), F.max("digest").alias("b"), F.bool_and(F.col("state") == "uploaded").alias("up"))
    known = F.col("filename").isin(*files)
    kinds = F.array_compact(F.array(F.when(F.col("a") != F.col("b"), "divergent"), F.when(F.col("n") > 1, "duplicate"), F.when(~known, "unexpected_files")))
    found = F.collect_list(F.when(F.size(kinds) > 0, F.struct("filename", kinds.alias("kinds"))))
    good = F.sum(F.when(known & (F.col("n") == 1) & F.col("up"), 1).otherwise(0))
    by_partition = by_file.groupBy("partition_id").agg(F.sum("n").alias("n"), good.alias("good"), found.alias("found"))
    planned = by_partition.join(plan.select("partition_id").distinct().withColumn("planned", F.lit(True)), "partition_id", "left")
    whole = (F.col("n") == len(files)) & (F.col("good") == len(files))
    own = F.when(F.col("planned").isNull(), "out_of_plan").when(~whole, "partial")
    item = lambda kind, name: F.struct(kind.alias("kind"), name.alias("item"))
    of_files = F.flatten(F.transform("found", lambda x: F.transform(x["kinds"], lambda k: item(k, F.concat_ws("/", "partition_id", x["filename"])))))
    every = F.concat(of_files, F.when(own.isNotNull(), F.array(item(own, F.col("partition_id")))).otherwise(F.array().cast("array<struct<kind:string,item:string>>")))
    return planned.select(F.explode(every).alias("x")).select("x.kind", "x.item")


def fatal(found: DataFrame) -> DataFrame:
    """Anomalies that end a run: all but unfinished partitions."""
    return found.where(F.col("kind") != "partial")


def uncovered(plan: DataFrame, complete: DataFrame, staged: DataFrame) -> DataFrame:
    """partition_id of planned partitions that are neither complete nor staged."""
    return plan.select("partition_id").join(complete.select("partition_id"), "partition_id", "left_anti").join(staged.select("partition_id"), "partition_id", "left_anti")


def assets_by_day(plan: DataFrame) -> DataFrame:
    """day, assets (sorted)."""
    return plan.groupBy("day").agg(F.array_sort(F.collect_list("asset")).alias("assets"))


def peaks(receipts: DataFrame, highest: tuple[str, ...], lowest: tuple[str, ...] = ()) -> DataFrame:
    """One row: the greatest or least of each metric over all receipts."""
    return receipts.agg(*[F.max(c).alias(c) for c in highest], *[F.min(c).alias(c) for c in lowest])


def market_faults(markets: DataFrame, asset: Column, page: Column) -> DataFrame:
    """market_id, fault: published markets that aren't hourly, of the partition's asset, settled on its page."""
    fault = (
        F.when(~F.col("asset").eqNullSafe(asset), "asset")
        .when(~F.col("timeframe").eqNullSafe(F.lit("1h")), "timeframe")
        .when(~(F.col("market_end_ns") - F.col("market_start_ns")).eqNullSafe(F.lit(HOUR_NS)), "length")
        .when(~F.coalesce(F.col("official_outcome").isin("UP", "DOWN", "SPLIT"), F.lit(False)), "outcome")
        .when(~F.col("resolution_source_url").eqNullSafe(page), "page")
    )
    return markets.withColumn("fault", fault).where("fault IS NOT NULL").select("market_id", "fault")


def ledger(plan: DataFrame, done: DataFrame) -> DataFrame:
    """One row: planned, completed, unfinished and the first unfinished partition."""
    state = plan.select("partition_id").join(done.select("partition_id").distinct().withColumn("ok", F.lit(True)), "partition_id", "left")
    open_ = F.col("ok").isNull()
    return state.agg(F.count("*").alias("planned"), F.count_if(~open_).alias("completed"), F.count_if(open_).alias("unfinished"), F.min(F.when(open_, F.col("partition_id"))).alias("first_unfinished"))


TIERS = ("TIER_A", "TIER_B", "EXCLUDED")


def tier_counts(manifests: DataFrame) -> DataFrame:
    """One row: partitions of each tier, and files. manifests: partition_id, tier, files."""
    return manifests.agg(*[F.count_if(F.col("tier") == t).alias(t) for t in TIERS], F.coalesce(F.sum("files"), F.lit(0)).alias("files"))


def certify(plan: DataFrame, manifests: DataFrame, files_each: int = len(FILES)) -> dict[str, int]:
    """Tier counts of all partitions; they and the files must add up to the plan, and be its partitions."""
    row, planned = tier_counts(manifests).first().asDict(), plan.count()
    ids = plan.select("partition_id")
    if sum(row[t] for t in TIERS) != planned or row["files"] != planned * files_each or not ids.exceptAll(manifests.select("partition_id")).isEmpty():
        raise ValueError(f"{planned} partitions are planned, these are published: {row}")
    return row
