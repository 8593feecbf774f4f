"""Message bytes to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions.once import with_computed, with_json
from tidegauge.functions.times import parse_ts
from tidegauge.functions.values import to_double


def parse_messages(
    raw: DataFrame, value: str = "value", mode: str = "strict", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Decode JSON messages into the sensor message columns, after the ``keep`` columns.

    ``strict`` nulls the whole metrics map when one entry is no number.
    ``lenient`` converts entry by entry and drops only the entries that fail.
    A message that is no JSON object gives a row of nulls in both modes.
    """
    text = F.col(value).cast("string")
    if mode == "strict":
        return with_json(raw, text, schemas.SENSOR_MESSAGE, keep)
    if mode != "lenient":
        raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")
    parsed = with_json(raw, text, schemas.SENSOR_MESSAGE_TEXT, keep)
    numbers = {"metrics": numeric_entries(F.col("metrics"))}
    return with_computed(parsed, numbers, parsed.columns[:-1])


def numeric_entries(metrics: Column) -> Column:
    """Text map to number map without the entries that are no numbers."""
    numbers = F.transform_values(metrics, lambda _, v: to_double(v))
    return F.map_filter(numbers, lambda _, v: v.isNotNull())


def valid_messages(parsed: DataFrame) -> DataFrame:
    """Typed timestamp; rows lacking timestamp, device or metrics are dropped."""
    return parsed.withColumn("ts", parse_ts(F.col("ts"))).dropna(
        subset=["ts", "device_id", "metrics"]
    )


def archive_rows(parsed: DataFrame) -> DataFrame:
    """Rows for the lake: event time and day key added, original text ts kept.

    Only a missing device drops a row; unreadable timestamps land in the null day.
    """
    event_ts = parse_ts(F.col("ts"))
    return (
        parsed.withColumn("event_ts", event_ts)
        .withColumn("dt", F.to_date("event_ts"))
        .dropna(subset=["device_id"])
    )


def metric_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One double column per named metric (null where absent) in place of the map."""
    picked = {name: F.col("metrics").getItem(name).cast("double") for name in names}
    return df.withColumns(picked).drop("metrics")


def valid_wide(df: DataFrame, ts: str = "event_ts", required: str = "temperature") -> DataFrame:
    """Wide rows that have device, event time and the leading metric."""
    return df.dropna(subset=["device_id", ts, required])
