"""Batch statistics over the lake and their use as thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.scores import zscore
from tidegauge.operators.asof import as_of
from tidegauge.operators.metrics import explode_metrics
from tidegauge.settings import MIN_STD

SERIES = ("device_id", "metric")


def daily_stats(
    lake: DataFrame, since: str | None = None, until: str | None = None, gather: str | None = None
) -> DataFrame:
    """Count, mean and sample std per day, device and metric.

    ``since`` and ``until`` (both inclusive days) prune lake partitions.

    Readings are aggregated where they are read, so that a series with many readings a day
    is shuffled as a few rows. Where devices send few messages a day that shrinks nothing,
    and each reading is hashed and shuffled as a wide state. ``gather``, a unit of time such
    as "month", is for such a lake: messages are shuffled whole, each once, by device and
    unit, and the readings of a day are sorted together. A trend by that unit or a longer one
    then merges days before it shuffles them.
    """
    if since is not None:
        lake = lake.filter(F.col("dt") >= F.lit(since).cast("date"))
    if until is not None:
        lake = lake.filter(F.col("dt") <= F.lit(until).cast("date"))
    aggregates = {"n": F.count("*"), "mean": F.avg("value"), "stddev": F.stddev("value")}
    if gather is not None:
        return _gathered_stats(lake, gather, aggregates)
    rows = explode_metrics(lake, carry=("dt", "device_id"), drop_null_values=True)
    return rows.groupBy("dt", *SERIES).agg(*(c.alias(name) for name, c in aggregates.items()))


def _gathered_stats(lake: DataFrame, unit: str, aggregates: dict[str, Column]) -> DataFrame:
    """The aggregates per day and series, without a map of all days and series in a task.

    The number of tasks is given, because Spark would make them by the size of the messages,
    which is far less than that of the readings sorted.
    """
    tasks = int(lake.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    messages = lake.select("dt", "device_id", "metrics", F.date_trunc(unit, F.col("dt")).alias("unit"))
    messages = messages.repartition(tasks, "device_id", "unit")
    rows = explode_metrics(messages, carry=("unit", "dt", "device_id"), drop_null_values=True)
    day = Window.partitionBy("device_id", "unit", "metric", "dt").orderBy("value")
    whole = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = rows.select(
        "dt",
        *SERIES,
        *(c.over(whole).alias(name) for name, c in aggregates.items()),
        F.row_number().over(day).alias("place"),
    )
    return placed.filter(F.col("place") == 1).drop("place")


def trend(daily: DataFrame, unit: str = "month") -> DataFrame:
    """Count and mean per device and metric for each day, week or month.

    Works from daily statistics; weeks begin on Monday.
    """
    period = F.date_trunc(unit, F.col("dt")).cast("date").alias("period")
    return daily.groupBy(period, *SERIES).agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
    )


def thresholds(daily: DataFrame, k: float = 3.0) -> DataFrame:
    """Overall mean, sample std and mean +/- k std bounds per device and metric.

    Days are combined exactly: the squared deviations of a day around the overall
    mean are those around its own mean plus n times the squared distance of the
    two means. A series spans as many rows here as it has days, and the window
    and the aggregate share one shuffle.
    """
    series = Window.partitionBy(*SERIES)
    total = F.sum("n").over(series)
    mean = F.sum(F.col("n") * F.col("mean")).over(series) / total
    own = (F.col("n") - 1) * F.pow(F.coalesce("stddev", F.lit(0.0)), F.lit(2))
    shift = F.col("n") * F.pow(F.col("mean") - F.col("overall"), F.lit(2))
    combined = (
        daily.withColumn("overall", mean)
        .groupBy(*SERIES)
        .agg(
            F.sum("n").alias("n"),
            F.max("overall").alias("mean"),
            F.sum(own + shift).alias("squares"),
        )
    )
    std = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return combined.withColumn("stddev", std).select(
        *SERIES,
        "n",
        "mean",
        "stddev",
        (F.col("mean") - k * F.col("stddev")).alias("lower"),
        (F.col("mean") + k * F.col("stddev")).alias("upper"),
    )


def score_against_thresholds(
    rows: DataFrame, limits: DataFrame, min_std: float = MIN_STD
) -> DataFrame:
    """Live readings scored against offline statistics instead of their own window.

    ``rows`` may be a stream. Readings of a series without offline statistics keep
    a null score. ``limits`` grows with the fleet, so it is not forced to be
    broadcast; Spark does that when its measured size allows.
    """
    known = limits.select(*SERIES, "mean", "stddev", "lower", "upper")
    return _against_limits(rows.join(known, list(SERIES), "left"), min_std)


def score_as_of(rows: DataFrame, versions: DataFrame, min_std: float = MIN_STD, block: str = "1 day") -> DataFrame:
    """Readings scored against the version of the thresholds in force at their time.

    Static input, such as a micro-batch; ``valid_from`` tells the version. A series with
    many readings is worked out block by block of time.
    """
    known = versions.select(*SERIES, "valid_from", "mean", "stddev", "lower", "upper")
    return _against_limits(as_of(rows, known, SERIES, block=block), min_std)


def _against_limits(rows: DataFrame, min_std: float) -> DataFrame:
    value = F.col("value")
    return (
        rows.withColumn("zscore", zscore(value, F.col("mean"), F.col("stddev"), min_std))
        .withColumn("abs_z", F.abs("zscore"))
        .withColumn("out_of_range", (value < F.col("lower")) | (value > F.col("upper")))
    )
