"""Folders of line files as a data source: read with a rate limit, written once per micro-batch.

``spark.readStream.format("tidegauge-spool")`` gives the names of files as they appear, at
most ``filesPerBatch`` at a time; their lines are read by the tasks (``spooled_lines``), so
nothing but names passes through the driver. Its offset is the name of the last file, so
names have to grow, and a restarted query goes on behind the last committed file.

``writeStream.format("tidegauge-spool")`` lets every task write its lines to a file of its
own in a staging folder; committing the micro-batch moves them into ``batch=<n>`` and
aborting it removes them. A repeated micro-batch replaces its folder, so a line is delivered
once. Paths may be those of any store pyarrow reads.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, SimpleDataSourceStreamReader, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "tidegauge-spool"
FILE = "path string, length bigint"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class NewFiles(SimpleDataSourceStreamReader):
    """Names of the files behind an offset, up to a limit."""

    def __init__(self, path: str, limit: int):
        self.path, self.limit = path, limit

    def initialOffset(self) -> dict:
        return {"last": ""}

    def _after(self, last: str) -> list[fs.FileInfo]:
        store, path = _store(self.path)
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        kept = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")) and f.base_name > last]
        return sorted(kept, key=lambda f: f.base_name)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        files = self._after(start["last"])[: self.limit]
        end = {"last": files[-1].base_name} if files else start
        return iter([(f.base_name, f.size) for f in files]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(f.base_name, f.size) for f in self._after(start["last"]) if f.base_name <= end["last"]])


@dataclass
class Staged(WriterCommitMessage):
    file: str | None
    lines: int


class LineWriter(DataSourceStreamWriter):
    """Lines into a file a task, published with the micro-batch."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> Staged:
        store, path = _store(self.path)
        name, lines, out = f"{uuid.uuid4().hex}.txt", 0, None
        staging = posixpath.join(path, "_staging")
        for row in iterator:
            if out is None:
                store.create_dir(staging, recursive=True)
                out = store.open_output_stream(posixpath.join(staging, name))
            out.write((row[0] + "\n").encode())
            lines += 1
        if out is not None:
            out.close()
        return Staged(name if out is not None else None, lines)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        store, path = _store(self.path)
        target = posixpath.join(path, f"batch={batchId}")
        if store.get_file_info(target).type != fs.FileType.NotFound:
            store.delete_dir(target)
        store.create_dir(target, recursive=True)
        for message in messages:
            if message and message.file:
                store.move(posixpath.join(path, "_staging", message.file), posixpath.join(target, message.file))

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        store, path = _store(self.path)
        for message in messages:
            if message and message.file:
                store.delete_file(posixpath.join(path, "_staging", message.file))


class Spool(DataSource):
    """Options: path, and for reading filesPerBatch (16 unless given)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FILE

    def simpleStreamReader(self, schema: StructType) -> NewFiles:
        return NewFiles(self.options["path"], int(self.options.get("filesPerBatch", "16")))

    def streamWriter(self, schema: StructType, overwrite: bool) -> LineWriter:
        return LineWriter(self.options["path"])


def _lines(path: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    store, root = _store(path)
    for batch in batches:
        for name in batch["path"]:
            with store.open_input_stream(posixpath.join(root, name)) as file:
                rest = b""
                while part := file.read(8 * 2**20):
                    *lines, rest = (rest + part).split(b"\n")
                    yield pd.DataFrame({"value": [x.decode(errors="replace") for x in lines], "path": name})
                if rest:
                    yield pd.DataFrame({"value": [rest.decode(errors="replace")], "path": name})


def spooled_lines(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """(value, path) of a stream: the lines of files as they appear, so many files a micro-batch."""
    spark.dataSource.register(Spool)
    names = spark.readStream.format(FORMAT).options(path=path, filesPerBatch=str(files_per_batch)).load()
    return names.repartition("path").mapInPandas(partial(_lines, path), "value string, path string")


def deliver_stream(lines: DataFrame, path: str, checkpoint: str):
    """A writer that delivers a stream of lines (one column)."""
    lines.sparkSession.dataSource.register(Spool)
    return lines.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)
