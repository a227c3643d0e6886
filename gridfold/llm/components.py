"""Connected components of links that stay distributed: alternating large and small stars.

Each pass links a node's neighbours to the least node that any of them knows; the links become stars
within a number of passes that grows with the logarithm of the longest chain. Every pass is written to
the shared folder, so that lost executors cost one pass and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.llm import scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links a > b. Large: every greater neighbour of a node to its least neighbour; small: the others."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most: int = 100) -> DataFrame:
    """node, root: of nodes that have links (longs a, b), the least node that they reach.

    Links that are no stars after ``most`` passes (a chain of n links takes about 2 log n) are an error."""
    spark = links.sparkSession
    schema = "a long, b long"
    ordered = links.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct()
    out = scratch.write(ordered, "links")
    now = spark.read.schema(schema).parquet(out)
    seen = _digest(now)
    for _ in range(most):
        after = scratch.write(_star(_star(now, large=True), large=False), "stars")
        scratch.drop(spark, out)
        out, now, before = after, spark.read.schema(schema).parquet(after), seen
        seen = _digest(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"connected components did not settle in {most} passes")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
