"""Several sinks fed by one micro-batch, each of which gets it once.

Spark repeats a micro-batch whose callback failed. With a ``Ledger`` a sink is marked when
it has written a micro-batch, and a repeated one skips the sinks that are marked, so a sink
that failed is tried again without the others getting their rows twice. What remains is the
moment between a sink's write and its mark: a sink that must not repeat even that is one
whose writer replaces what the batch wrote before (``files.batch_writer``), or whose readers
follow the marks (``Ledger.published``).
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Sink:
    """One destination: what it takes from the batch and how it writes it.

    A failure of a required sink fails the batch, which Spark then repeats; a
    failure of another one is logged.
    """

    name: str
    write: BatchWriter
    view: Callable[[DataFrame], DataFrame] = lambda batch: batch
    required: bool = True
    enabled: bool = True


class Ledger:
    """Marks of what each sink has written, as empty files ``<sink>/<batch>`` in a shared folder.

    The folder belongs to one query; keep it below the query's checkpoint, whose batch
    numbers it uses.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def has(self, sink: str, batch_id: int) -> bool:
        files, path = self._file(f"{sink}/{batch_id}")
        return files.exists(path)

    def mark(self, sink: str, batch_id: int) -> None:
        files, path = self._file(f"{sink}/{batch_id}")
        files.create(path, True).close()

    def batches(self, sink: str) -> list[int]:
        """The batches a sink has written, oldest first."""
        files, path = self._file(sink)
        if not files.exists(path):
            return []
        return sorted(int(f.getPath().getName()) for f in files.listStatus(path))

    def published(self, sink: str, path: str, schema: str, file_format: str = "parquet") -> DataFrame:
        """What ``files.batch_writer`` wrote to ``path`` in marked batches; a batch is seen whole or not at all."""
        folders = [os.path.join(path, f"batch_id={n}") for n in self.batches(sink)]
        reader = self.spark.read.format(file_format).schema(schema)
        return reader.load(folders) if folders else self.spark.createDataFrame([], schema)


def after(prepare: Callable[[DataFrame], DataFrame], write: BatchWriter) -> BatchWriter:
    """Write what ``prepare`` makes of a micro-batch, which is computed once however often it is read."""

    def prepared(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batch.count()
            write(prepare(batch), batch_id)
        finally:
            batch.unpersist()

    return prepared


def fan_out(sinks: Iterable[Sink], ledger: Ledger | None = None) -> BatchWriter:
    """A ``foreachBatch`` callback that computes the batch once for all its sinks.

    With a ledger every sink is tried before a failure is raised.
    """
    active = [sink for sink in sinks if sink.enabled]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Counting runs every task of the batch once, which the state of a
            # stream needs even when no sink is active or one takes only a part.
            if batch.count() == 0:
                return
            failures = []
            for sink in active:
                if ledger and ledger.has(sink.name, batch_id):
                    continue
                try:
                    done = _deliver(sink, batch, batch_id)
                except Exception as error:
                    if not ledger:
                        raise
                    failures.append(error)
                else:
                    if ledger and done:
                        ledger.mark(sink.name, batch_id)
            if failures:
                raise failures[0]
        finally:
            batch.unpersist()

    return write


def _deliver(sink: Sink, batch: DataFrame, batch_id: int) -> bool:
    """Whether the sink has written the batch."""
    try:
        sink.write(sink.view(batch), batch_id)
        return True
    except Exception as error:
        if sink.required:
            raise
        log.warning("sink %s failed on batch %s: %s", sink.name, batch_id, error)
        return False
