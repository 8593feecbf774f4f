"""Text and key-value forms in which rows leave the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions import lines
from tidegauge.functions.times import iso_utc
from tidegauge.functions.values import is_finite
from tidegauge.operators.metrics import metric_points
from tidegauge.settings import MEASUREMENT_ANOMALIES, MEASUREMENT_METRICS


def anomaly_messages(found: DataFrame) -> DataFrame:
    """Anomaly rows as (key, value) records: null key, JSON value, null fields left out."""
    body = F.struct(
        F.col("ts").cast("string").alias("ts"),
        *schemas.TAGS,
        "metric",
        "value",
        "score",
        "severity",
        F.lit(1).alias("is_anomaly"),
    )
    return found.select(F.lit(None).cast("string").alias("key"), F.to_json(body).alias("value"))


def sensor_records(normalized: DataFrame) -> DataFrame:
    """Normalised messages as (key, value) records keyed by device.

    A message that kept a text instead of metrics (column ``raw``) is sent with that
    text as its only metric.
    """
    columns = [name for name in normalized.columns if name != "raw"]
    body = F.to_json(F.struct(*columns))
    if "raw" in normalized.columns:
        kept = F.create_map(F.lit("raw"), F.col("raw")).alias("metrics")
        with_text = F.struct(*[kept if name == "metrics" else name for name in columns])
        body = F.when(F.col("raw").isNotNull(), F.to_json(with_text)).otherwise(body)
    return normalized.select(F.col("device_id").alias("key"), body.alias("value"))


def message_lines(sent: DataFrame, measurement: str = MEASUREMENT_METRICS) -> DataFrame:
    """Messages as line protocol, one line each, fields by metric name.

    A message already holds the metrics of its point, so nothing is shuffled; a store
    merges lines of equal tags and time. Null and non-finite values are left out, and
    messages without time or without values.
    """
    usable = F.filter(F.map_entries("metrics"), lambda e: e["value"].isNotNull() & is_finite(e["value"]))
    entry = F.transform(usable, lambda e: lines.field_text(e["key"], e["value"]))
    fields = F.array_join(F.array_sort(entry), ",")
    text = lines.line(measurement, lines.tag_text(schemas.TAGS), fields, F.col("ts"))
    return sent.filter(F.col("ts").isNotNull() & (fields != "")).select(text.alias("value"))


def metric_lines(rows: DataFrame, measurement: str = MEASUREMENT_METRICS) -> DataFrame:
    """Long rows as line protocol, one line per (ts, tags); regroups them by point first."""
    return message_lines(metric_points(rows), measurement)


def anomaly_lines(found: DataFrame, measurement: str = MEASUREMENT_ANOMALIES) -> DataFrame:
    """Anomaly rows as line protocol with fields value and score."""
    fields = F.concat_ws(
        ",",
        lines.field_text(F.lit("value"), F.col("value")),
        lines.field_text(F.lit("score"), F.col("score")),
    )
    tags = lines.tag_text((*schemas.TAGS, "metric", "severity"))
    text = lines.line(measurement, tags, fields, F.col("ts"))
    return found.filter(F.col("ts").isNotNull() & (fields != "")).select(text.alias("value"))


def inspect_messages(records: DataFrame, n: int = 5, newest: bool = False) -> DataFrame:
    """The first ``n`` records of a topic in readable form; all of them if ``n <= 0``.

    With ``newest`` the last ``n`` by time, whatever their partitions and offsets; every
    task hands on no more than ``n``. Bytes that are no UTF-8 show as replacement characters.
    """
    readable = records.select(
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        iso_utc(F.col("timestamp")).alias("kafka_ts"),
        F.make_valid_utf8(F.col("value").cast("string")).alias("value"),
    )
    order = (F.desc("kafka_ts"), "partition", F.desc("offset")) if newest else ("partition", "offset")
    return readable.orderBy(*order).limit(n) if n > 0 else readable
