"""Parquet files whose tasks report them: a data source that writes, for the driver, each file's rows, bytes and digest.

A task streams its rows into one file under the output's name of its own attempt and hashes the bytes on their way. What
tasks report is put beside the files as ``_files.json`` when all have ended, so no file is read a second time for a
manifest. A task that fails deletes its file; a job that fails deletes its folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from gridfold import files

FORMAT, RECORD = "gridfold_table", "_files.json"
#: How published tables are written.
LEVEL, PAGES, VERSION, GROUP = 9, "2.0", "2.6", 65_536


@dataclass
class Written(WriterCommitMessage):
    """A task's file; without a name if it had no rows."""

    name: str
    rows: int
    bytes: int
    sha256: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: pa.Schema) -> None:
        self.path, self.schema = path, schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = files.of(self.path)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{uuid.uuid4().hex[:12]}.parquet"
        held, count, rows, out, writer = [], 0, 0, None, None
        try:
            for batch in iterator:
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    out = files.Hashed(fs.open_output_stream(f"{base}/{name}"))
                    writer = pq.ParquetWriter(out, self.schema, compression="zstd", compression_level=LEVEL, use_dictionary=False, write_statistics=True, data_page_version=PAGES, version=VERSION)
                held.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, self.schema, strict=True)], schema=self.schema))
                count += batch.num_rows
                while count >= GROUP:
                    table = pa.Table.from_batches(held)
                    writer.write_table(table.slice(0, GROUP), row_group_size=GROUP)
                    held, count, rows = table.slice(GROUP).to_batches(), count - GROUP, rows + GROUP
            if writer is None:
                return Written("", 0, 0, "")
            if count:
                writer.write_table(pa.Table.from_batches(held), row_group_size=GROUP)
            writer.close()
            out.close()
            return Written(name, rows + count, out.length, out.hash.hexdigest())
        except BaseException:
            if out is not None:
                out.close()
                files.remove(fs, f"{base}/{name}")
            raise

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """The record of all files; what an earlier attempt of a task may have left goes."""
        fs, base = files.of(self.path)
        fs.create_dir(base, recursive=True)
        found = sorted(({"name": m.name, "rows": m.rows, "bytes": m.bytes, "sha256": m.sha256} for m in messages if m is not None and m.name), key=lambda m: m["name"])
        known = {m["name"] for m in found}
        for x in fs.get_file_info(files.pafs.FileSelector(base)):
            if x.base_name not in known:
                fs.delete_file(x.path)
        if not found:  # an empty table has its columns all the same
            with files.Hashed(fs.open_output_stream(f"{base}/part-00000-none.parquet")) as out:
                pq.write_table(self.schema.empty_table(), out, version=VERSION)
            found = [{"name": "part-00000-none.parquet", "rows": 0, "bytes": out.length, "sha256": out.hash.hexdigest()}]
        with fs.open_output_stream(f"{base}/{RECORD}") as out:
            out.write(json.dumps(found, sort_keys=True, separators=(",", ":")).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = files.of(self.path)
        if fs.get_file_info(base).type != files.pafs.FileType.NotFound:
            fs.delete_dir(base)


class TableFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: object, overwrite: bool) -> _Writer:
        from pyspark.sql.pandas.types import to_arrow_schema

        return _Writer(self.options["path"], to_arrow_schema(schema))


def write(df: DataFrame, path: str) -> None:
    """Write ``df``, whose rows keep their order within each partition, into a new folder."""
    df.sparkSession.dataSource.register(TableFiles)
    df.write.format(FORMAT).mode("append").option("path", path).save()
