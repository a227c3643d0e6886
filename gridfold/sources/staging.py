"""Events on their way: fragments by source, of which only committed sources count.

A run writes each source's events to a folder of its own and commits the source when that is complete; after
a crash whatever isn't committed is ignored and written again. Rows name conditions and sources by number,
as dictionaries, so a fragment is small; reading joins the names back.

A source's folder is called by its number, so its name may be an URL, and in it rows lie in folders by bucket of
condition. Reading some conditions lists and scans their buckets of the committed sources alone, and shuffles nothing to find
repeats: whether a source has a row twice is found once, as it is committed, and stands in its record.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold.operators.guards import GuardError, duplicates
from gridfold.storage import Store

KEY = ("condition_no", "source_no", "source_row")


def numbered(names: DataFrame, name: str) -> DataFrame:
    """name and a number that is the name's own, whatever else is there: equal names are one entry."""
    return names.select(name).distinct().withColumn(f"{name}_no", F.xxhash64(name))


def encoded(events: DataFrame) -> DataFrame:
    """Events with condition_no and source_no in place of both names."""
    return events.select(F.xxhash64("condition").alias("condition_no"), F.xxhash64("source").alias("source_no"), *[c for c in events.columns if c not in ("condition", "source")])


def resolved(rows: DataFrame, conditions: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their names again; a row whose condition or source isn't known is no row."""
    return rows.join(conditions, "condition_no").join(sources, "source_no").drop("condition_no", "source_no")


def committed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of committed sources (numbers that may repeat)."""
    return rows.join(sources.select("source_no"), "source_no", "left_semi")


def repeated(rows: DataFrame) -> DataFrame:
    """Keys of rows that are there more than once."""
    return duplicates(rows, KEY)


#: Buckets of conditions; a list of them is bounded, whatever the conditions.
BUCKETS = 256


def bucket(condition_no: str | Column) -> Column:
    return F.pmod(F.xxhash64(condition_no), F.lit(BUCKETS)).cast("int")


class Fragments:
    """A folder of fragments, one folder a source, and a record for each committed one.

    schema: the columns of events but condition and source, for a read before anything is committed."""

    def __init__(self, spark: SparkSession, root: str, schema: str = "source_row long") -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.store = Store(spark, self.root)

    def _number(self, source: str) -> int:
        return self.spark.range(1).select(F.xxhash64(F.lit(source))).first()[0]

    def append(self, events: DataFrame, source: str) -> None:
        """Write a source's events anew and commit it: a second time changes nothing."""
        number = self._number(source)
        out, record = f"{self.root}/rows/source_no={number}", f"committed/{number}.json"
        self.store.remove(record)
        rows = encoded(events.withColumn("source", F.lit(source))).drop("source_no").withColumn("bucket", bucket("condition_no"))
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "condition_no", "source_row")
        dealt.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").partitionBy("bucket").parquet(out)
        there = self.spark.read.parquet(out) if any(not x.startswith("_") for x in Store(self.spark, out).names()) else rows.limit(0)
        twice = duplicates(there, ("condition_no", "source_row")).count()
        self.store.write(record, json.dumps({"source": source, "source_no": number, "twice": twice}, sort_keys=True).encode())

    def records(self) -> list[dict]:
        """A record for each committed source."""
        log = Store(self.spark, f"{self.root}/committed")
        return [json.loads(log.read(x)) for x in log.names() if x.endswith(".json")]

    def sources(self) -> DataFrame:
        return self.spark.createDataFrame([(r["source"], r["source_no"]) for r in self.records()], "source string, source_no long")

    def read(self, conditions: DataFrame) -> DataFrame:
        """The events of these conditions (names) from all committed sources."""
        records = self.records()
        wanted = numbered(conditions, "condition")
        if bad := sorted(r["source"] for r in records if r["twice"]):
            raise GuardError(f"a source has a row twice: {bad[0]}")
        folders = [x for x in (f"{self.root}/rows/source_no={r['source_no']}" for r in records) if any(not n.startswith("_") for n in Store(self.spark, x).names())]
        if not folders:
            names = self.spark.createDataFrame([], f"condition string, source string, {self.schema}")
            return names.select(*[c for c in names.columns if c not in ("condition", "source")], "condition", "source")
        buckets = [r["b"] for r in wanted.select(bucket("condition_no").alias("b")).distinct().collect()]  # ``BUCKETS`` at most
        rows = self.spark.read.option("basePath", f"{self.root}/rows").parquet(*folders).where(F.col("bucket").isin(buckets)).drop("bucket")
        return resolved(rows, wanted, self.sources())

    def counts(self, conditions: DataFrame) -> DataFrame:
        return self.read(conditions).groupBy("condition").agg(F.count("*").alias("rows"))
