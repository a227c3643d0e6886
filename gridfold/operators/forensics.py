"""What the events of one market look like, for finding out why it was excluded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridfold.functions.values import decimals_as_text


def profile(events: DataFrame) -> DataFrame:
    """condition_id, token_id, event_type, rows, first_receive_ns: one pass, combined before the shuffle."""
    return events.groupBy("condition_id", "token_id", "event_type").agg(F.count("*").alias("rows"), F.min("receive_ts_ns").alias("first_receive_ns"))


def neighbours(rows: DataFrame, partition: Sequence[str], order: Sequence[str], hit: Column, margin: int = 2) -> DataFrame:
    """Of each partition the rows from ``margin`` before the first hit to ``margin`` behind the last one."""
    own = Window.partitionBy(*partition)
    numbered = rows.withColumn("gf_i", F.row_number().over(own.orderBy(*order)))
    at = F.when(hit, F.col("gf_i"))
    near = numbered.withColumns({"gf_low": F.min(at).over(own), "gf_high": F.max(at).over(own)})
    return near.where(F.col("gf_i").between(F.col("gf_low") - margin, F.col("gf_high") + margin)).drop("gf_i", "gf_low", "gf_high")


def around(events: DataFrame, receive_ts_ns: int, margin: int = 2) -> DataFrame:
    """Each token's events at a receive time, and ``margin`` more to both sides; decimals as text."""
    near = neighbours(events, ["condition_id", "token_id"], ["sequence"], F.col("receive_ts_ns") == receive_ts_ns, margin)
    return near.select(*[decimals_as_text(F.col(f.name), f.dataType).alias(f.name) for f in near.schema])
