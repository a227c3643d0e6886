"""Lineage cuts: tables written to the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``. Only where that is unset and the session runs in one
process (``local[...]``: tests, a laptop) a temporary folder of this machine is taken; on a cluster an
unset folder is an error, for executors wouldn't see each other's files.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gridfold-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    """A new folder's name below the shared folder; it goes when the driver ends, if not before."""
    out = f"{root(spark)}/gridfold-{uuid.uuid4().hex[:12]}-{name}"
    _made[out] = spark
    return out


def write(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    out = path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(out)
    return out


def cut(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Losing an executor afterwards loses nothing: what follows starts from replicated files.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write(df, name, partition_by))


def drop(spark: SparkSession, out: str) -> None:
    """Delete a folder that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(out)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    _made.pop(out, None)


@atexit.register
def _clear() -> None:
    for out, spark in list(_made.items()):
        with contextlib.suppress(Exception):
            drop(spark, out)
