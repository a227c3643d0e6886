"""Stored pages of a source's catalogue: the names that they list, and whether the pages are whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def names(pages: DataFrame, pattern: str, group: int = 1) -> DataFrame:
    """page, name: the different names that a page's text holds by a pattern. pages: page, html."""
    return pages.select("page", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(pattern), F.lit(group)))).alias("name"))


def overlaps(listed: DataFrame) -> DataFrame:
    """name, pages of names that more than one page lists: the catalogue changed while it was read."""
    return listed.groupBy("name").agg(F.count_distinct("page").alias("pages")).where("pages > 1")


def incomplete(pages: DataFrame, marker: str) -> DataFrame:
    """page of pages whose marker ("page i of n") is absent, names another page, or another number of pages.

    marker: a pattern with two groups, i and n."""
    part = lambda i: F.regexp_extract("html", marker, i).try_cast("int")
    said = pages.select("page", part(1).alias("i"), part(2).alias("n"))
    total = pages.agg(F.count("*").alias("total"))
    return said.join(F.broadcast(total)).where(~(F.col("i").eqNullSafe(F.col("page")) & F.col("n").eqNullSafe(F.col("total")))).select("page")  # one row
