"""Publishing: files under their digests, copied and hashed by tasks, chunk by chunk.

A release is a folder. A file's published name is its partition, its digest and its own name. A task hashes a source file,
copies it to a draft's name, reads the draft again and renames it once the digest is right: what stands under a
published name is whole. A run that broke goes on where it stopped, for what is published already is only held against its
name. No bytes of files pass through the driver; it gets a row a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridfold import files
from gridfold.functions import values
from gridfold.plans import reconcile
from gridfold.storage import Conflict, Store

#: The length that a published file stays below; the markers of a release's two states.
MOST_BYTES = 1_900_000_000
DRAFT, PUBLISHED = ".draft", ".published"
RECEIPT = "partition_id string, filename string, name string, digest string, bytes long, state string"
#: Files that a task copies one after the other.
EACH = 4


def _receipts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
    names = [x.split()[0] for x in RECEIPT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _publish(folder: str):
    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = files.of(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            fs, path = files.of(row["source"])
            partition, filename = row["partition_id"], row["filename"]
            digest, length = files.digest(fs, path)
            if length >= MOST_BYTES:
                raise Conflict(f"{filename} has {length} bytes, {MOST_BYTES} or more")
            if others := sorted(set(row["published"] or ()) - {digest}):
                raise Conflict(f"{partition} has another {filename} published: {others[0]}")
            name = values.content_name_of(partition, filename, digest)
            target = f"{base}/{name}"
            state = "present" if to.get_file_info(target).type == files.pafs.FileType.File else "uploaded"
            if state == "uploaded":
                draft = f"{base}/.{name}.{uuid.uuid4().hex[:8]}.partial"
                try:
                    if files.copy(fs, path, to, draft) != (digest, length) or files.digest(to, draft) != (digest, length):
                        raise Conflict(f"{filename} was written as something else")
                    to.move(draft, target)
                except BaseException:
                    files.remove(to, draft)
                    raise
            elif files.digest(to, target) != (digest, length):
                raise Conflict(f"{name} isn't what its name says")
            yield _receipts([(partition, filename, name, digest, length, state)])

    return publish


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in (r for b in batches for r in b.to_pylist()):
        digest, length = files.digest(*files.of(row["path"]))
        yield _receipts([(row["partition_id"], row["filename"], row["name"], digest, length, row["fault"] or ("uploaded" if digest == row["digest"] else "digest"))])


class Release:
    """One release of many partitions' files, below a root that all tasks reach."""

    def __init__(self, spark: SparkSession, root: str, tag: str) -> None:
        self.spark, self.store, self.tag = spark, Store(spark, f"{str(root).rstrip('/')}/{tag}"), tag
        self.folder = self.store.fs.makeQualified(self.store._at("")).toString()

    def ensure_draft(self) -> None:
        if not self.store.exists(PUBLISHED) and not self.store.exists(DRAFT):
            self.store.write(DRAFT, b"")

    def finalise(self) -> None:
        """Once; nothing is published into the release afterwards."""
        if not self.store.exists(DRAFT):
            raise Conflict(f"{self.tag} isn't a draft")
        self.store.move(DRAFT, PUBLISHED)

    def _files(self, folder: str) -> DataFrame:
        """path, length of the files in a folder, by metadata alone; hidden ones are no files."""
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")

    def listing(self, prefix: str | None = None) -> DataFrame:
        """name, path, bytes, state and what the name says, with a fault for each that isn't a published name."""
        named = self._files(self.folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("bytes"), F.lit("uploaded").alias("state"), F.lit(self.tag).alias("release"))
        return reconcile.parse_listing(named, release="release", prefix=prefix)

    def publish(self, partition_id: str, folder: str) -> list[dict]:
        """Publishes a partition's files, one row each. A table's only file is called after the table, of several each is numbered."""
        if self.store.exists(PUBLISHED):
            raise Conflict(f"{self.tag} is published")
        self.ensure_draft()
        base = Store(self.spark, str(folder))
        root = base.fs.makeQualified(base._at("")).toString().rstrip("/") + "/"
        table = F.regexp_extract("inside", "^(.*)/[^/]*$", 1)
        inside = self._files(str(folder)).select(F.col("path").alias("source"), F.substr("path", F.lit(len(root) + 1)).alias("inside")).where("inside NOT LIKE '\\\\_%' AND inside NOT LIKE '%/\\\\_%'")
        own = Window.partitionBy(table)
        many = inside.withColumns({"n": F.count("*").over(own), "k": F.row_number().over(own.orderBy("inside"))})
        number = F.when(F.col("n") > 1, F.format_string("-%05d", "k")).otherwise("")
        named = many.select("source", F.when(table == "", F.col("inside")).otherwise(F.concat(F.replace(table, F.lit("/"), F.lit(".")), number, F.lit(".parquet"))).alias("filename"), F.lit(partition_id).alias("partition_id"))
        known = self.listing().where("fault IS NULL").groupBy("partition_id", "filename").agg(F.collect_set("digest").alias("published"))
        dealt = named.join(known, ["partition_id", "filename"], "left")
        tasks = max(1, -(-named.count() // EACH))
        out = dealt.repartition(tasks, "source").mapInArrow(_publish(self.folder), RECEIPT)
        return sorted((r.asDict() for r in out.collect()), key=lambda r: r["filename"])

    def verified(self, prefix: str | None = None) -> DataFrame:
        """A row for each file of the release, read again by tasks: ``state`` is uploaded, or what is wrong with it."""
        found = self.listing(prefix).select("path", "name", "partition_id", "filename", "digest", "fault")
        return found.repartition("path").mapInArrow(_check, RECEIPT)
