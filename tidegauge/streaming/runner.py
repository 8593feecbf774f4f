"""Starting and finishing streaming queries."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegauge.session import scratch_dir


def start(
    writer: DataStreamWriter, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Start an endless query, one micro-batch per interval if ``every`` is given."""
    writer = writer.outputMode(mode)
    return (writer.trigger(processingTime=every) if every else writer).start()


def drain(writer: DataStreamWriter, mode: str = "append") -> None:
    """Process what the source holds now, then stop."""
    drain_all([writer], mode)


def drain_all(writers: Iterable[DataStreamWriter], mode: str = "append") -> None:
    """Drain independent queries side by side; the first failure is raised."""
    running = [w.outputMode(mode).trigger(availableNow=True).start() for w in writers]
    try:
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()


def wait_for_any(spark: SparkSession) -> None:
    """Block until one of the session's queries ends or fails."""
    spark.streams.awaitAnyTermination()


def drained(rows: DataFrame, purpose: str) -> DataFrame:
    """What a stream gives for the data its source holds now, as a static table.

    The stream writes to a fresh folder under the session's checkpoint folder and
    the files are read back.
    """
    spark = rows.sparkSession
    root = scratch_dir(spark, purpose)
    out = os.path.join(root, "out")
    drain(
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", os.path.join(root, "checkpoint"))
    )
    return spark.read.schema(rows.schema).parquet(out)
