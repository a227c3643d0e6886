"""The operators' input tables, with the columns that are wanted under names of this package's own."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold.llm import scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo a number; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


ROW = "gf_row"
#: Plan nodes that hand on each row of a file at most once.
_ROW_BY_ROW = ("Project", "Filter", "SubqueryAlias")


def _rows_of_files(df: DataFrame) -> bool:
    """Whether each row of ``df`` is one row of a Parquet file, and again the same one in a second run."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in _ROW_BY_ROW:
        plan = plan.children().head()
    if not plan.children().isEmpty():
        return False
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself if its rows are those of files, and otherwise written once and read again."""
    return df if _rows_of_files(df) else scratch.cut(df, "rows")


def with_row(df: DataFrame) -> DataFrame:
    """``df`` with one more column that names each row for good: its file and its index there.

    Ids in the data may be null or repeat, and numbers made up during a job may change when a lost
    executor's work is done again; a row's place in a Parquet file doesn't. The file is told by 64 bits of
    its whole path, for writers name the files of one task alike in every folder. What isn't rows of
    files is written once."""
    place = F.concat_ws("#", F.hex(F.xxhash64("_metadata.file_path")), F.col("_metadata.row_index")).alias(ROW)
    return settled(df).select("*", place)


def share(share_of_rows: float, *columns: str | Column) -> Column:
    """A fixed share of the rows by hash: a sample of known expected size with no sort and no limit."""
    part = max(0.0, min(1.0, share_of_rows))
    return F.lit(True) if part >= 1 else F.shiftrightunsigned(F.xxhash64(*columns), 1) < F.lit(int(part * (1 << 63)))


def most_frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows of the largest counts, at most ``most``: all with at least some count.

    The count to be had is found in the histogram of counts, which has a few
    thousand levels at most; a sort would have each task
    send ``most`` rows to the driver."""
    levels = F.when(F.col(column) < 1024, F.col(column)).otherwise(F.floor(F.log2(column) * 64).cast("long") + 1024)
    histogram = sorted(((r["level"], r["n"], r["least"]) for r in counts.groupBy(levels.alias("level")).agg(F.count("*").alias("n"), F.min(column).alias("least")).collect()), reverse=True)
    full, total = [], 0
    for _, n, least in histogram:
        total += n
        if total <= most:
            full.append(least)
    return counts.where(F.col(column) >= F.lit(full[-1])) if full else counts.where(F.lit(False))
