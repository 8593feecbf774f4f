"""The lake and the registry tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidegauge import schemas
from tidegauge.settings import JdbcSettings


def lake(spark: SparkSession, path: str, schema: str = schemas.ARCHIVED_MESSAGE) -> DataFrame:
    """Archived rows; the partition column ``dt`` comes back as a date."""
    return spark.read.schema(schema).parquet(path)


def registry_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """A registry table kept as Parquet under ``root``, with its declared types."""
    return spark.read.schema(schemas.REGISTRY[name]).parquet(os.path.join(root, name))


def jdbc_options(jdbc: JdbcSettings, table: str | None = None) -> dict[str, str]:
    return {
        "url": jdbc.url,
        "dbtable": table or jdbc.table,
        "user": jdbc.user,
        "password": jdbc.password,
        "driver": jdbc.driver,
    }


def jdbc_table(
    spark: SparkSession,
    jdbc: JdbcSettings,
    table: str,
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 32,
) -> DataFrame:
    """A database table; ``split_column`` with ``bounds`` reads it by many tasks."""
    reader = spark.read.format("jdbc").options(**jdbc_options(jdbc, table))
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=str(splits),
        )
    return reader.load()
