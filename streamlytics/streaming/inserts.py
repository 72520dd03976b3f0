"""Batched inserts into files with a commit protocol.

A data source for writers, ``batched_insert``: each task flushes every ``rows`` rows into a file of its own and reports the
file when it has come to its end; the driver then commits the files of all tasks in one small file, under the number of the
micro-batch. Rows of attempts that failed, of a task or of the driver, are in no commit and never show; a micro-batch
that is written again finds its number committed and adds nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

ROWS = 50
FORMAT = "batched_insert"


def _files(path: str):
    """The file system of a folder and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its file (none without rows), its rows, and how often it flushed."""

    file: str | None
    rows: int
    flushes: int


class _Task:
    """The part that tasks run."""

    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows

    def write(self, iterator: Iterator) -> Written:
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, root = _files(self.path)
        system.create_dir(f"{root}/data", recursive=True)
        name, writer, held, n, total, flushes = f"{uuid.uuid4().hex}.parquet", None, [], 0, 0, 0

        def flush(batches: list) -> None:
            nonlocal writer, flushes
            table = pa.Table.from_batches(batches)
            if writer is None:
                writer = pq.ParquetWriter(system.open_output_stream(f"{root}/data/{name}"), table.schema)
            writer.write_table(table)
            flushes += 1

        try:
            for batch in iterator:
                while batch.num_rows:
                    part = batch.slice(0, self.rows - n)
                    held.append(part)
                    n, total, batch = n + part.num_rows, total + part.num_rows, batch.slice(part.num_rows)
                    if n == self.rows:
                        flush(held)
                        held, n = [], 0
            if held:
                flush(held)
        finally:
            if writer is not None:
                writer.close()
        return Written(name if total else None, total, flushes)


def _commit(path: str, name: str, messages: list) -> None:
    system, root = _files(path)
    system.create_dir(f"{root}/commits", recursive=True)
    target = f"{root}/commits/{name}.json"
    if system.get_file_info(target).type.name != "NotFound":
        return  # the same micro-batch again
    done = [m for m in messages if m is not None and m.file]
    aside = f"{root}/commits/.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        out.write(json.dumps({
            "files": [m.file for m in done], "rows": sum(m.rows for m in done), "flushes": sum(m.flushes for m in done)}).encode())
    system.move(aside, target)


class StreamInsert(_Task, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        _commit(self.path, f"{batchId:012d}", messages)

    def abort(self, messages: list, batchId: int) -> None:
        """Files of a failed attempt stay, unnamed by any commit."""


class TableInsert(_Task, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        _commit(self.path, f"table-{uuid.uuid4().hex}", messages)

    def abort(self, messages: list) -> None:
        """As for a stream."""


class BatchedInsert(DataSource):
    """Options: ``path``, a folder that all nodes share, and ``rows``, after how many a task flushes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _of(self, kind: type):
        return kind(self.options["path"].rstrip("/"), int(self.options.get("rows", ROWS)))

    def streamWriter(self, schema, overwrite: bool) -> StreamInsert:
        return self._of(StreamInsert)

    def writer(self, schema, overwrite: bool) -> TableInsert:
        return self._of(TableInsert)


def insert_stream(df: DataFrame, path: str, rows: int = ROWS) -> DataStreamWriter:
    """A stream into the files below ``path``."""
    df.sparkSession.dataSource.register(BatchedInsert)
    return df.writeStream.format(FORMAT).option("path", path).option("rows", str(rows)).outputMode("append")


def insert_table(df: DataFrame, path: str, rows: int = ROWS) -> None:
    """A table into the files below ``path``."""
    df.sparkSession.dataSource.register(BatchedInsert)
    df.write.format(FORMAT).option("path", path).option("rows", str(rows)).mode("append").save()


def commits(path: str) -> list[dict]:
    """What each commit says, in order."""
    from pyarrow import fs

    system, root = _files(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    out = []
    for info in sorted(found, key=lambda x: x.base_name):
        if info.base_name.endswith(".json"):
            with system.open_input_stream(info.path) as text:
                out.append(json.loads(text.read()))
    return out


def read_inserted(spark: SparkSession, path: str, schema) -> DataFrame:
    """The committed rows."""
    files = [f"{path.rstrip('/')}/data/{f}" for commit in commits(path) for f in commit["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
