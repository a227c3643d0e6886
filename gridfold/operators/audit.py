"""Holding two versions of a table against each other by checksums of key buckets.

Each side is summed up by bucket: a count, and sums of two hashes of its rows. Only buckets whose sums differ are read
again, and only their rows are shuffled and joined, so what moves follows from what changed. The list of differing
buckets has at most ``buckets`` rows, which is what may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.operators.order import fingerprint

#: Key buckets; a differing one is read whole, so there should be many more of them than changes.
BUCKETS = 1 << 16


def bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def sums(rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, one, two: combined before their shuffle, a row a bucket and task at most."""
    one, two = fingerprint(sorted(rows.columns))
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    return rows.groupBy(bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("n"), wide(one).alias("one"), wide(two).alias("two"))


def differing(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """bucket: those whose rows aren't the same on both sides, order and files aside."""
    both = sums(left, keys, buckets).alias("l").join(sums(right, keys, buckets).alias("r"), "bucket", "full")
    same = F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.one").eqNullSafe(F.col("r.one")) & F.col("l.two").eqNullSafe(F.col("r.two"))
    return both.where(~same).select("bucket")


def changes(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """keys, change (added, absent, changed) and the columns that changed, of rows that aren't the same in both tables.

    Both have the same columns. Keys name rows; of rows that share their keys in one table the number and the sums of their
    hashes are compared, and no columns are named. Null keys are keys like others."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"the tables have other columns: {sorted(set(left.columns) ^ set(right.columns))}")
    rest = [c for c in sorted(left.columns) if c not in keys]
    buckets_of = F.broadcast(differing(left, right, keys, buckets))  # ``buckets`` rows at most
    one, two = fingerprint(sorted(left.columns))

    def side(rows: DataFrame, name: str) -> DataFrame:
        inside = rows.withColumn("bucket", bucket(keys, buckets)).join(buckets_of, "bucket", "left_semi")
        total = lambda h: F.sum(h.cast("decimal(20,0)"))
        return inside.groupBy(*keys).agg(F.struct(F.count("*").alias("n"), total(one).alias("one"), total(two).alias("two")).alias(f"gf_{name}"), F.struct(*(F.any_value(F.struct(c)).alias(c) for c in rest)).alias(f"gf_{name}_row"))

    a, b = side(left, "left"), side(right, "right").withColumnsRenamed({k: f"gf_key_{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"gf_key_{i}")) for i, k in enumerate(keys)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    joined = a.join(b, on, "full").where(~F.col("gf_left").eqNullSafe(F.col("gf_right")))
    one_each = (F.col("gf_left.n") == 1) & (F.col("gf_right.n") == 1)
    other = F.array_compact(F.array(*(F.when(~F.col(f"gf_left_row.{c}").eqNullSafe(F.col(f"gf_right_row.{c}")), F.lit(c)) for c in rest)))
    change = F.when(F.col("gf_left").isNull(), "added").when(F.col("gf_right").isNull(), "absent").otherwise("changed")
    found = [F.when(F.col("gf_left").isNull(), F.col(f"gf_key_{i}")).otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)]
    return joined.select(*found, change.alias("change"), F.when((change == "changed") & one_each, other).otherwise(F.array().cast("array<string>")).alias("columns"))
