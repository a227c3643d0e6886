"""Line dedup over levelled sorted runs of line hashes.

The texts' line keys are hashed once and written by batch. A batch becomes one run: for each line key, by
its hash, in how many of the batch's documents it stands. Runs lie in the shared folder, dealt by hash into
the same buckets and sorted within them. A new batch is merge-anti-joined with each run there is: keys
that a run has in ``min_docs`` documents are settled and counted no further; what is left becomes the
batch's own run. As soon as a level has two runs they are merged, bucket by bucket, into one run of the next
level, so after b batches there are log(b) runs at most and each hash has been rewritten log(b) times.
Joins and merges are merge joins that neither shuffle nor sort the runs again. In the end all runs are
merged, and a key that stands in at least ``min_docs`` documents loses all its lines: the rule counts over
all documents, so lines of the first batches go as well.

All of it is DataFrame operations. A hot line is counted before it is shuffled; the last join carries only
a row's place and a hash, never a text, and adaptive execution may split its partitions.

A key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z lower-cased; keys are told apart by
a 64-bit hash. (A line that stands alone is wrongly dropped if it hits one of the frequent hashes: with
10**8 of those, once in 10**11 lines.)

Defined cases: a null or empty text is one empty line; a key that is too short is never dropped; a
document from which all lines go is an empty text; a text of any length, or with any number of frequent
lines, takes time by its length; repeated rows and null ids are documents of their own; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold.llm import scratch
from gridfold.llm.arrays import count_while, let, steps
from gridfold.llm.tables import ROW, with_row

#: The white space that is stripped.
BLANKS = " \t\n\x0b\x0c\r"


def key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), ascii_uppercase, ascii_lowercase)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def hashes(text: Column, min_chars: int) -> Column:
    """The distinct line keys of a text, hashed."""
    keys = F.filter(F.transform(lines(text), key), lambda k: F.length(k) >= min_chars)
    return F.array_distinct(F.transform(keys, lambda k: F.xxhash64(k)))


@contextlib.contextmanager
def _sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Within it, plans trust that a bucket's one file is sorted, as runs are."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


Run = tuple[str, str]


class LineRuns:
    """The runs of all batches so far, one or none a level: tables of line and docs, bucketed and sorted."""

    def __init__(self, spark: SparkSession, min_docs: int) -> None:
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[Run | None] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [self.spark.table(run[0]) for run in self.levels if run]

    def _write(self, counts: DataFrame, what: str) -> Run:
        name, out = f"gf_lines_{uuid.uuid4().hex}", scratch.path(self.spark, what)
        # Counting has dealt the hashes out as buckets are: each is in one task, and one file.
        counts.write.format("parquet").option("path", out).bucketBy(self.buckets, "line").sortBy("line").saveAsTable(name)
        return name, out

    def _drop(self, run: Run) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        scratch.drop(self.spark, run[1])

    def _merged(self, one: Run, two: Run) -> DataFrame:
        a, b = self.spark.table(one[0]).hint("merge"), self.spark.table(two[0]).select("line", F.col("docs").alias("more"))
        return a.join(b, "line", "full").select("line", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))

    def _merge(self, one: Run, two: Run, what: str) -> Run:
        out = self._write(self._merged(one, two), what)
        self._drop(one)
        self._drop(two)
        return out

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """A merge anti join with each run. (As an outer join: an anti join would be moved before the count,
        which then wouldn't be combined before the shuffle.)"""
        for run in self.runs:
            settled = run.where(F.col("docs") >= self.min_docs).select("line", F.lit(True).alias("settled"))
            counts = counts.hint("merge").join(settled, "line", "left").where("settled IS NULL").drop("settled")
        return counts

    def add(self, batch: DataFrame) -> None:
        """Add the run of a batch's line hashes (a row for each line of each document), and compact."""
        with _sorted_buckets(self.spark):
            run = self._write(self.unsettled(batch.groupBy("line").agg(F.count("*").alias("docs"))), "lines-0")
            level = 0
            while level < len(self.levels) and (old := self.levels[level]):
                self.levels[level] = None
                level += 1
                run = self._merge(old, run, f"lines-{level}")
            self.levels[level : level + 1] = [run]

    def frequent(self) -> DataFrame:
        """line: the hashes of keys that stand in at least ``min_docs`` documents. All runs become one."""
        with _sorted_buckets(self.spark):
            every = [run for run in self.levels if run]
            while len(every) > 1:
                every[:2] = [self._merge(every[0], every[1], "lines")]
            self.levels = [*every]
            return scratch.cut(self.spark.table(every[0][0]).where(F.col("docs") >= self.min_docs).select("line"), "frequent-lines")

    def close(self) -> None:
        for run in self.levels:
            if run:
                self._drop(run)
        self.levels = []


def clean(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 6) -> DataFrame:
    """``docs`` with its text cleaned in column ``kept``, and how many lines it had and lost."""
    spark = docs.sparkSession
    # The documents' columns stay in a struct of their own while others are added, so no name of theirs meets one of these.
    rows = with_row(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("gf_doc"), F.col("text").alias("gf_text")))
    batch = F.pmod(F.xxhash64(ROW), F.lit(batches)).cast("int").alias("gf_batch")
    hashed = scratch.cut(rows.select(ROW, batch, hashes(F.col("gf_text"), min_chars).alias("lines")), "line-hashes", ("gf_batch",))
    runs = LineRuns(spark, min_docs)
    for i in range(batches):
        runs.add(hashed.where(F.col("gf_batch") == i).select(F.explode("lines").alias("line")))
    frequent = runs.frequent()
    runs.close()
    hits = hashed.select(ROW, F.explode("lines").alias("line")).join(frequent, "line", "left_semi").groupBy(ROW).agg(F.sort_array(F.collect_list("line")).alias("gf_hot"))
    joined = rows.join(hits, ROW, "left").withColumn("gf_steps", steps(F.col("gf_hot")))
    whole, hot = lines(F.col("gf_text")), F.col("gf_hot")

    def is_hot(h: Column) -> Column:
        return F.coalesce(F.get(hot, count_while(hot, F.col("gf_steps"), lambda x: x <= h) - 1) == h, F.lit(False))

    stays = lambda x: let(key(x), lambda k: (F.length(k) < min_chars) | ~let(F.xxhash64(k), is_hot))
    done = joined.withColumn("gf_kept", F.when(hot.isNull(), whole).otherwise(F.filter(whole, stays)))
    return done.select(
        *[F.col("gf_doc").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")],
        F.size(whole).cast("long").alias("n_lines"),
        (F.size(whole) - F.size("gf_kept")).cast("long").alias("n_dropped"),
        F.array_join("gf_kept", "\n").alias("kept"),
    )
