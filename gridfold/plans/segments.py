"""A day in segments: their receipts, and putting them together again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.operators.guards import divergent, require_empty, unique_records
from gridfold.operators.joins import compare_sets

_FILE = "struct<path:string,byte_length:bigint,sha256:string>"
_MARKET = "struct<market_id:string,condition_id:string,market_start_ns:bigint,official_outcome:string>"
RECEIPT = f"day string, segment_index int, segment_count int, market_starts array<bigint>, source_bytes bigint, markets array<{_MARKET}>, files array<{_FILE}>"
NAMES = ("day", "segment_index", "segment_count", "market_starts", "source_bytes", "markets", "files")


def receipts(texts: DataFrame) -> DataFrame:
    """day, segment_index, segment_count, market_starts, source_bytes, markets, files from JSON ``receipt``.

    A receipt that doesn't parse, or lacks one of these, is an error."""
    parsed = texts.select("receipt", F.from_json("receipt", RECEIPT).alias("r"))
    lacking = F.exists(F.array(*[F.col(f"r.{c}").isNull() for c in NAMES]), lambda x: x)
    whole = F.when(F.col("r").isNull() | lacking, F.raise_error(F.concat(F.lit("no receipt of a segment: "), F.left("receipt", F.lit(60))))).otherwise(F.col("r"))
    # Exploding keeps the plan from parsing a receipt again for every field that is read of it.
    return parsed.select(F.explode(F.array(whole)).alias("r")).select("r.*")


def changed_files(receipts_: DataFrame, present: DataFrame) -> DataFrame:
    """path, fault of files that a receipt lists and that are absent or other, and of files in no receipt.

    present: path, byte_length, sha256, as they are now. What several receipts say alike of a file counts once."""
    told = receipts_.select(F.explode("files").alias("f")).select("f.*").distinct().select("path", F.struct("byte_length", "sha256").alias("told"))
    there = present.select("path", F.struct("byte_length", "sha256").alias("there"))
    both = told.join(there, "path", "full")
    fault = F.when(F.col("there").isNull(), "absent").when(F.col("told").isNull(), "in no receipt").when(F.col("told") != F.col("there"), "changed")
    return both.withColumn("fault", fault).where("fault IS NOT NULL").select("path", "fault")


def gaps(receipts_: DataFrame, starts: DataFrame) -> DataFrame:
    """side, start_s: starts of the day that no segment has, or that aren't the day's."""
    return compare_sets(starts, receipts_.select(F.explode("market_starts").alias("start_s")), "start_s")


def assembled(receipts_: DataFrame, starts: DataFrame) -> DataFrame:
    """The day's markets, each once. Every start must be in a segment, every segment of one day be there, and
    what two segments say of one market must be the same."""
    require_empty(gaps(receipts_, starts), "segments don't cover the day")
    per = receipts_.groupBy("day").agg(F.count_distinct("segment_index").alias("have"), F.max("segment_count").alias("want"), F.min("segment_count").alias("least"))
    require_empty(per.where("have <> want OR want <> least"), "segments are missing")
    return unique_records(receipts_.select(F.explode("markets").alias("m")).select("m.*"), ["market_id"])


def contradictions(receipts_: DataFrame) -> DataFrame:
    """market_id, versions of markets on which segments differ."""
    return divergent(receipts_.select(F.explode("markets").alias("m")).select("m.*"), ["market_id"], ["condition_id", "market_start_ns", "official_outcome"])
