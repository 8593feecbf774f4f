"""Files and registry tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge import schemas


# Spark writes instants to JSON in milliseconds unless told otherwise.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def archive_stream(
    rows: DataFrame, path: str, checkpoint: str, file_format: str = "parquet"
) -> DataStreamWriter:
    """Append a stream to the lake, one folder per day.

    The file sink records which files each micro-batch committed, so a repeated
    batch does not add its rows twice.
    """
    return (
        rows.writeStream.format(file_format)
        .options(**JSON_TIMES if file_format == "json" else {})
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").options(**JSON_TIMES).json(path)


def overwrite_days(rows: DataFrame, path: str, only_given_days: bool = False) -> None:
    """Replace a day-partitioned table, or only the days present in ``rows``.

    Rows are gathered by day for few files per day; adaptive execution still cuts
    a day that is too large for one task.
    """
    mode = "dynamic" if only_given_days else "static"
    (
        rows.hint("rebalance", F.col("dt"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("dt")
        .parquet(path)
    )


def batch_writer(path: str, file_format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Micro-batch writer that gives every batch its own folder.

    A repeated batch replaces its folder, so its rows are there once.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        target = os.path.join(path, f"batch_id={batch_id}")
        rows.write.mode("overwrite").format(file_format).save(target)

    return write


def text_stream(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append a stream of lines (one column) to text files, every line exactly once."""
    return (
        lines.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def console_stream(lines: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Print every line of a stream (one column); for a person who watches.

    Spark's console sink prints 20 rows of a micro-batch and drops the rest.
    """
    return lines.writeStream.foreachBatch(print_lines).option("checkpointLocation", checkpoint)


def print_lines(lines: DataFrame, _: int = 0) -> None:
    """Print all rows of one column, fetched partition by partition."""
    for (line,) in lines.toLocalIterator():
        print(line, flush=True)


def append_table(rows: DataFrame, name: str, root: str) -> None:
    """Append rows to a registry table with its declared column order and types."""
    _declared(rows, name).write.mode("append").parquet(os.path.join(root, name))


def clear_table(spark: SparkSession, name: str, root: str) -> None:
    """Remove all rows of a registry table; also creates it when missing."""
    empty = spark.createDataFrame([], schemas.REGISTRY[name])
    empty.write.mode("overwrite").parquet(os.path.join(root, name))


def recreate_registry(spark: SparkSession, root: str) -> None:
    """Empty registry tables, children cleared before their parents."""
    for name in schemas.REGISTRY_DROP_ORDER:
        clear_table(spark, name, root)


def _declared(rows: DataFrame, name: str) -> DataFrame:
    target = rows.sparkSession.createDataFrame([], schemas.REGISTRY[name]).schema
    return rows.select(
        *[
            F.col(f.name).cast(f.dataType)
            if f.name in rows.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
