"""Long and wide forms of metric readings, and their windowed features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions.times import before, instant
from tidegauge.functions.values import is_finite, text_or


def explode_metrics(
    df: DataFrame, carry: tuple[str, ...] = ("ts", *schemas.TAGS), drop_null_values: bool = False
) -> DataFrame:
    """One row per (message, metric); messages without metrics give no rows."""
    rows = df.select(*carry, F.explode("metrics").alias("metric", "value"))
    rows = rows.filter(F.col("metric").isNotNull())
    return rows.filter(F.col("value").isNotNull()) if drop_null_values else rows


def drop_non_finite(rows: DataFrame, value: str = "value") -> DataFrame:
    """Remove NaN and infinite readings; null readings stay."""
    return rows.filter(F.col(value).isNull() | is_finite(F.col(value)))


def drop_nan_readings(
    df: DataFrame, columns: tuple[str, ...] = ("humidity", "temperature")
) -> DataFrame:
    """Remove wide rows in which a probe reported NaN."""
    for name in columns:
        df = df.filter(~F.isnan(F.coalesce(F.col(name), F.lit(0.0))))
    return df


def metric_points(rows: DataFrame) -> DataFrame:
    """Long rows to one point per (ts, tags) with a metric-to-value map.

    Readings repeating (ts, tags, metric) keep the largest value, so the result
    does not depend on row order. They collapse on the map side before anything
    is grouped per point, so a point that arrived many times stays one small
    group. Missing tags become ``unknown``; null and non-finite values and points
    left without values are dropped. Static input, or a micro-batch.
    """
    tags = {name: text_or(F.col(name), "unknown") for name in schemas.TAGS}
    readings = rows.filter(
        F.col("ts").isNotNull()
        & F.col("metric").isNotNull()
        & F.col("value").isNotNull()
        & is_finite(F.col("value"))
    ).withColumns(tags)
    distinct = readings.groupBy("ts", *schemas.TAGS, "metric").agg(F.max("value").alias("value"))
    entries = F.array_sort(F.collect_list(F.struct("metric", "value")))
    return distinct.groupBy("ts", *schemas.TAGS).agg(
        F.map_from_entries(entries).alias("metrics")
    )


def _in_order(ts: Column, value: Column) -> Column:
    """A number that orders readings by time, and simultaneous ones by value.

    The whole part is the time in microseconds; the fraction grows with the value, as its
    logarithm does.
    """
    grown = F.lit(0.5) + F.signum(value) * F.log1p(F.abs(value)) / 1500
    fraction = F.when(is_finite(value), grown).otherwise(F.when(value < 0, 0.0).otherwise(1.0))
    return F.unix_micros(ts).cast("decimal(19,0)") + fraction.cast("decimal(19,18)")


def window_features(
    rows: DataFrame,
    window: str = "1 minute",
    keys: tuple[str, ...] = ("device_id", "metric"),
    watermark: str | None = None,
) -> DataFrame:
    """Count, mean, population std, min, max, change and rate of change per window.

    Change is last minus first reading by time (of simultaneous readings: the
    smallest first, the largest last, as far as their first 13 digits tell); rate is
    per second and null when all readings share one instant. All buffers are of
    fixed width, so the aggregate hashes on the map side and never sorts readings.
    """
    source = rows.filter(F.col("value").isNotNull())
    source = source.withWatermark("ts", watermark) if watermark else source
    at = _in_order(F.col("ts"), F.col("value"))
    grouped = source.groupBy(F.window("ts", window).alias("w"), *keys).agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.min_by("value", at).alias("first"),
        F.max_by("value", at).alias("last"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    delta = F.col("last") - F.col("first")
    seconds = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *keys,
        "n",
        "mean",
        "std",
        "min",
        "max",
        delta.alias("delta"),
        F.try_divide(delta, seconds).alias("rate"),
    )


def downsample(
    rows: DataFrame,
    bucket: str,
    keys: tuple[str, ...] = (*schemas.TAGS, "metric"),
    watermark: str | None = None,
) -> DataFrame:
    """Mean reading per coarser time bucket."""
    source = rows.withWatermark("ts", watermark) if watermark else rows
    grouped = source.groupBy(F.window("ts", bucket).alias("w"), *keys).agg(
        F.avg("value").alias("value"), F.count("value").alias("n")
    )
    return grouped.select(F.col("w.start").alias("ts"), *keys, "value", "n")


def series_range(
    rows: DataFrame,
    as_of: str | Column,
    span: str = "15 minutes",
    metric: str | None = None,
    device_id: str | None = None,
) -> DataFrame:
    """Readings of the last ``span`` before ``as_of``, optionally of one series."""
    ts = F.col("ts")
    picked = rows.filter((ts >= before(as_of, span)) & (ts < instant(as_of)))
    if metric is not None:
        picked = picked.filter(F.col("metric") == metric)
    if device_id is not None:
        picked = picked.filter(F.col("device_id") == device_id)
    return picked


def metrics_matching(rows: DataFrame, pattern: str) -> DataFrame:
    """Readings whose metric name contains a match of the regular expression."""
    return rows.filter(F.col("metric").rlike(pattern))
