"""Daily statistics kept up to date day by day.

The statistics of a day can be merged with those of other days (``offline.thresholds``,
``offline.trend``), so what is known of a day is stored and a day is read again only when
its files have changed: a new day, or one that late rows were added to. A mark per day,
number, size and newest time of its files, tells.
"""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.operators import offline
from tidegauge.sinks import files as day_files
from tidegauge.sinks.listing import exists, files

MARKS = "files bigint, bytes bigint, newest timestamp, dt date"


def _marks(spark: SparkSession, lake_path: str) -> DataFrame:
    return (
        files(spark, lake_path)
        .groupBy("dt")
        .agg(
            F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")
        )
    )


def _of_days(days: list[date | None]) -> Column:
    named = F.col("dt").isin([d for d in days if d is not None])
    return named | F.col("dt").isNull() if None in days else named


def daily(spark: SparkSession, root: str) -> DataFrame:
    """The stored statistics of all days."""
    return spark.read.schema(schemas.DAILY_STATS).parquet(os.path.join(root, "stats"))


def touched_days(spark: SparkSession, lake_path: str, root: str) -> list[date | None]:
    """Days whose files differ from those their statistics were made of."""
    now = _marks(spark, lake_path)
    if exists(spark, root, "marks"):
        known = spark.read.schema(MARKS).parquet(os.path.join(root, "marks"))
    else:
        known = spark.createDataFrame([], MARKS)
    alike = [now[c].eqNullSafe(known[c]) for c in ("dt", "files", "bytes", "newest")]
    return [r.dt for r in now.join(known, alike, "left_anti").select("dt").collect()]


def touched_rows(lake: DataFrame, days: list[date | None]) -> DataFrame:
    """The rows of some days; other days' folders are not read."""
    return lake.filter(_of_days(days))


def refresh(lake: DataFrame, lake_path: str, root: str) -> list[date | None]:
    """Bring the statistics below ``root`` up to date with the lake; the days that were read.

    Statistics are replaced before marks. Files that arrive meanwhile, or a run that ends
    between the two, make a day count as touched again, and replacing it twice does no harm.
    Statistics of a day that has left the lake stay.
    """
    spark = lake.sparkSession
    days = touched_days(spark, lake_path, root)
    if days:
        # listed before the rows are read, so nothing that is read later is taken for known
        marks = _marks(spark, lake_path).filter(_of_days(days))
        marks = spark.createDataFrame(marks.collect(), marks.schema)
        stats = offline.daily_stats(touched_rows(lake, days))
        day_files.overwrite_days(stats, os.path.join(root, "stats"), only_given_days=True)
        day_files.overwrite_days(marks, os.path.join(root, "marks"), only_given_days=True)
    return days
