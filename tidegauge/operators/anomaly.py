"""Windowed statistics and the anomaly rules built on them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions.moments import gathered, merged, moments
from tidegauge.functions.scores import severity, zscore
from tidegauge.functions.times import micros
from tidegauge.operators.metrics import drop_non_finite
from tidegauge.settings import MIN_STD, WINDOW, Z_THRESHOLD

# How anomalies name the rule that found them.
METHOD = "zscore"
PEAK_METHOD = "zscore_window_1m"

# Join tasks a key is spread over on a stream, where no adaptive splitting exists.
STREAM_SALTS = 16


def window_stats(
    rows: DataFrame,
    window: str = WINDOW,
    keys: tuple[str, ...] = schemas.SCORING_KEYS,
    watermark: str | None = None,
) -> DataFrame:
    """Mean and population standard deviation per tumbling window and key."""
    source = rows.withWatermark("ts", watermark) if watermark else rows
    return source.groupBy(F.window("ts", window).alias("w"), *keys).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def score_rows(
    rows: DataFrame,
    window: str = WINDOW,
    keys: tuple[str, ...] = schemas.SCORING_KEYS,
    watermark: str | None = None,
    min_std: float = MIN_STD,
    nan_policy: str = "drop",
    salts: int = STREAM_SALTS,
) -> DataFrame:
    """Every reading with the mean, std and z-score of its own window and key.

    Readings with a null key never match statistics and keep a null score. On a
    stream a reading comes out when its window closes; one that is too late for
    its window comes out unscored. Only readings with complete keys move the
    watermark, because Spark drops the others ahead of the statistics.

    The statistics are aggregated on the map side, so only one row per key and
    task is shuffled for them. The readings of one very large window-key are
    spread over several join tasks. On static input adaptive execution splits them
    by measured size; it can because the join is on the start of the window, not on
    the window the statistics are grouped by, so both sides are shuffled for the join
    itself. On a stream each reading draws one of ``salts`` copies of its statistics
    row. The draw is repeatable for rows that come straight from a source, so a
    repeated task gives the same rows.

    ``nan_policy='propagate'`` keeps NaN and infinite readings, which turns all
    statistics of their window into NaN.
    """
    if nan_policy == "drop":
        rows = drop_non_finite(rows)
    elif nan_policy != "propagate":
        raise ValueError(f"nan_policy must be 'drop' or 'propagate', not {nan_policy!r}")
    if rows.isStreaming and not watermark:
        raise ValueError("scoring a stream needs a watermark")

    stats = window_stats(rows, window, keys, watermark)
    readings = rows.withColumn("w", F.window("ts", window))
    on = ["w", *keys]
    if rows.isStreaming and salts > 1:
        copies = F.sequence(F.lit(0), F.lit(salts - 1))
        stats = stats.withColumn("salt", F.explode(copies))
        readings = readings.withColumn("salt", (F.rand(seed=7) * salts).cast("int"))
        on.append("salt")
    elif not rows.isStreaming:
        stats = stats.withColumn("bucket", F.col("w.start")).drop("w")
        readings = readings.withColumn("bucket", F.col("w.start"))
        on[0] = "bucket"

    z = zscore(F.col("value"), F.col("mean"), F.col("std"), min_std)
    return (
        readings.join(stats, on, "left")
        .drop("salt", "bucket")
        .withColumn("zscore", z)
        .withColumn("abs_z", F.abs("zscore"))
    )


def anomalies(
    scored: DataFrame, z_threshold: float = Z_THRESHOLD, method: str = METHOD
) -> DataFrame:
    """Scored readings at or beyond the threshold, as anomaly rows."""
    return scored.filter(F.col("abs_z") >= z_threshold).select(
        "ts",
        *schemas.TAGS,
        "metric",
        F.col("value").cast("double").alias("value"),
        F.col("zscore").cast("double").alias("score"),
        F.lit(method).alias("method"),
        severity(F.col("abs_z")).alias("severity"),
    )


def wide_window_stats(
    df: DataFrame,
    metrics: dict[str, str] | None = None,
    window: str = WINDOW,
    keys: tuple[str, ...] = ("device_id",),
    watermark: str | None = None,
    ts: str = "event_ts",
) -> DataFrame:
    """Mean and population std per window for metrics held in columns.

    ``metrics`` maps each column to the prefix of its result columns.
    """
    metrics = metrics or {"temperature": "temp", "humidity": "hum"}
    source = df.withWatermark(ts, watermark) if watermark else df
    aggregates = []
    for name, prefix in metrics.items():
        aggregates.append(F.avg(name).alias(f"{prefix}_mean"))
        aggregates.append(F.stddev_pop(name).alias(f"{prefix}_std"))
    return source.groupBy(F.window(ts, window).alias("w"), *keys).agg(*aggregates)


def window_rule_anomalies(
    stats: DataFrame, mean_ceiling: float = 40.0, std_ceiling: float = 5.0
) -> DataFrame:
    """Windows whose mean temperature or its spread reaches a fixed ceiling."""
    breach = (F.col("temp_mean") >= mean_ceiling) | (F.col("temp_std") >= std_ceiling)
    others = [name for name in stats.columns if name != "w"]
    return stats.filter(breach).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *others,
        F.lit(True).alias("is_anomaly"),
    )


def sliding_peak_anomalies(
    df: DataFrame,
    value: str = "temperature",
    window: str = "1 minute",
    slide: str = "10 seconds",
    watermark: str | None = None,
    min_score: float = 4.0,
    ts: str = "event_ts",
) -> DataFrame:
    """Sliding windows whose maximum lies far above their mean.

    Score is (max - mean) / sample std; windows without spread are skipped. The
    row carries the window end as its time.

    Readings are aggregated once, into panes as wide as what window and slide have in
    common; a window merges the states of its panes. Only panes are copied per window
    they belong to, and a window gathers no more than window / pane of them.
    """
    source = df.withWatermark(ts, watermark) if watermark else df
    width = math.gcd(micros(window), micros(slide))
    panes = (
        source.groupBy(F.window(ts, f"{width} microseconds").alias("pane"), "device_id")
        .agg(*(c.alias(name) for name, c in moments(value).items()), F.max(value).alias("peak"))
        .filter("n > 0")
    )
    # a pane lies in a window as its last instant does
    at = F.window_time("pane") if df.isStreaming else F.col("pane.start")
    place = F.expr(f"(unix_micros(pane.start) - unix_micros(w.start)) div {width}")
    state = merged(gathered("place", micros(window) // width))
    windows = (
        panes.withColumn("w", F.window(at, window, slide))
        .select("w", "device_id", place.alias("place"), "n", "mean", "squares", "peak")
        .groupBy("w", "device_id")
        .agg(state.alias("all"), F.max("peak").alias("peak"))
        .select(
            "w",
            "device_id",
            F.col("all.mean").alias("mean"),
            F.when(F.col("all.n") > 1, F.sqrt(F.col("all.squares") / (F.col("all.n") - 1))).alias("std"),
            "peak",
        )
    )
    score: Column = (F.col("peak") - F.col("mean")) / F.col("std")
    return (
        windows.filter(F.col("std") > 0)
        .withColumn("score", score)
        .filter(F.col("score") >= min_score)
        .select(
            F.col("w.end").alias("ts"),
            "device_id",
            F.lit(value).alias("metric"),
            F.col("peak").alias("value"),
            "score",
            F.lit(PEAK_METHOD).alias("method"),
            F.lit("high").alias("severity"),
        )
    )
