"""The files of a table as rows, without reading them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "path string, modificationTime timestamp, length bigint, dt date"


def exists(spark: SparkSession, *parts: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(*parts))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length, dt) of a Parquet table in day folders.

    The content of the files is a column nobody asks for. Where a stream writes the table,
    only files of committed micro-batches are listed.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "modificationTime", "length", F.col("dt").cast("date").alias("dt"))
    )


def same_path(path: Column) -> Column:
    """Paths are written with one or three slashes after their scheme."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")
