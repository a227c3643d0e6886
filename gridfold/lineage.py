"""Which source objects fed which market, and which markets another version of the sources or markets touches.

The lineage of a partition is a table beside its tables: a row for each market and object that holds rows of its, repeats
too. A market without rows has one row without object, and an object that fed no market one row without market, so that
all objects that were looked at are known by their digests. It follows from what the build keeps anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold import schemas
from gridfold.operators.order import fingerprint

#: Columns of kept events: how many rows each stands for, and in which objects those are.
COPIES, OBJECTS = "gf_copies", "gf_objects"


def about() -> dict[str, Column]:
    """What is kept with distinct events, over all rows with their payload."""
    return {COPIES: F.count("*"), OBJECTS: F.collect_set("source_object")}


def _row_hashes() -> tuple[Column, Column]:
    one, two = fingerprint(sorted(f.name for f in schemas.table("markets")))
    return one.alias("market_one"), two.alias("market_two")


def of_markets(markets: DataFrame, kept: DataFrame, objects: DataFrame) -> DataFrame:
    """The rows with a market. kept: distinct events with ``about``; objects: source_object, sha256; one without digest is an error."""
    known = markets.select("condition_id", *_row_hashes(), "token_up", "token_down")
    counts = kept.groupBy("condition_id").agg(F.sum(COPIES).alias("rows"))
    fed = kept.select("condition_id", F.explode(OBJECTS).alias("source_object")).distinct().join(objects, "source_object", "left")
    text = F.concat(F.lit("no digest of "), "source_object")
    fed = fed.withColumn("sha256", F.when(F.col("sha256").isNotNull(), F.col("sha256")).otherwise(F.raise_error(text)))
    rows = known.join(counts, "condition_id", "left").join(fed, "condition_id", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return rows.select(*schemas.table("lineage").names)


def whole(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """``rows`` and those of the objects that fed no market."""
    idle = objects.join(rows.select("source_object").where("source_object IS NOT NULL").distinct(), "source_object", "left_anti")
    return rows.unionByName(idle.select("source_object", "sha256"), allowMissingColumns=True)


def changed_objects(before: DataFrame, objects: DataFrame) -> DataFrame:
    """source_object, change (added, absent, changed) since ``before``; an object without a digest counts as changed."""
    was = before.where("source_object IS NOT NULL").select("source_object", F.struct("sha256").alias("gf_was")).distinct()
    both = was.join(objects.select("source_object", F.struct("sha256").alias("gf_now")), "source_object", "full")
    same = F.coalesce(F.col("gf_was.sha256") == F.col("gf_now.sha256"), F.lit(False))
    change = F.when(F.col("gf_was").isNull(), "added").when(F.col("gf_now").isNull(), "absent").when(~same, "changed")
    return both.select("source_object", change.alias("change")).where("change IS NOT NULL")


def changed_tokens(before: DataFrame, markets: DataFrame) -> DataFrame:
    """token_id of tokens that only one of both versions of the markets has. An event's token may be another market's,
    which is a fault of the event's market: so these touch markets whose own row is the same."""
    both = lambda df, side: df.select(F.explode(F.array("token_up", "token_down")).alias("token_id")).where("token_id IS NOT NULL").distinct().withColumn(side, F.lit(True))
    return both(before, "was").join(both(markets, "now"), "token_id", "full").where("was IS NULL OR now IS NULL").select("token_id")


def touched(before: DataFrame, markets: DataFrame, changed: DataFrame, fed: DataFrame) -> DataFrame:
    """condition_id and reason of the markets whose results may differ, each once, by its first reason: new (there was no
    such market), market (its row is another), source (an object that fed it changed, or one that changed feeds it).

    changed: of ``changed_objects``; fed: condition_id of the rows that objects which are added or changed hold now. Markets
    that are no longer there aren't named: there is nothing to build for them."""
    now = markets.select("condition_id", F.struct(*_row_hashes()).alias("gf_now"))
    was = before.where("condition_id IS NOT NULL").select("condition_id", F.struct("market_one", "market_two").alias("gf_was")).distinct()
    sourced = before.join(changed, "source_object", "left_semi").select("condition_id").unionByName(fed.select("condition_id"))
    sourced = sourced.where("condition_id IS NOT NULL").distinct().withColumn("gf_source", F.lit(True))
    both = now.join(was, "condition_id", "left").join(sourced, "condition_id", "left")
    reason = F.when(F.col("gf_was").isNull(), "new").when(F.col("gf_was") != F.col("gf_now"), "market").when(F.col("gf_source"), "source")
    return both.select("condition_id", reason.alias("reason")).where("reason IS NOT NULL")
