"""Payloads of the ingestion paths to sensor messages.

Each normaliser takes the receive time as a column, so a replay gives the same
rows as the first run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions.once import with_computed, with_json
from tidegauge.functions.times import iso_utc
from tidegauge.functions.values import clamp, text_or, to_double
from tidegauge.operators.parsing import numeric_entries
from tidegauge.settings import DEFAULT_LOCATION, DEFAULT_MODEL, SOURCE_MQTT, SOURCE_REST

# Metrics accepted outside the map, and those that are percentages.
FLAT_METRICS = ("temperature", "humidity", "soil_moisture")
PERCENT_METRICS = ("humidity", "soil_moisture")

WHITESPACE = " \t\n\r\f\v"



def with_flat_metrics(metrics: Column, flat: dict[str, Column]) -> Column:
    """Metric map in which present flat fields replace the entries of that name."""
    entries = F.create_map(*[part for name, v in flat.items() for part in (F.lit(name), v)])
    given = F.map_filter(entries, lambda _, v: v.isNotNull())
    base = F.coalesce(metrics, F.create_map().cast("map<string,double>"))
    return F.map_zip_with(
        base, given, lambda _, old, new: F.coalesce(new, old)
    )


def clamp_percentages(metrics: Column) -> Column:
    return F.transform_values(
        metrics,
        lambda name, v: F.when(name.isin(*PERCENT_METRICS), clamp(v, 0.0, 100.0)).otherwise(v),
    )


def read_rest_payloads(bodies: DataFrame, value: str = "value") -> DataFrame:
    """Request bodies as payload columns plus ``problem``, null for usable ones.

    Unlike a message on the topic, a request with one bad number is refused whole.
    """
    others = tuple(c for c in bodies.columns if c != value)
    parsed = with_json(bodies, F.col(value).cast("string"), schemas.REST_PAYLOAD, others)
    kept = [*others, "device_id", "ts", "location", "model"]
    # expressions of one generator are not shared, so the map is converted in one of its own
    given = [F.col(name).isNotNull().alias(f"{name}_given") for name in FLAT_METRICS]
    converted = with_computed(
        parsed.select("*", F.size("metrics").alias("entries"), *given),
        {"numbers": numeric_entries(F.col("metrics")), **{name: to_double(F.col(name)) for name in FLAT_METRICS}},
        [*kept, "entries", *[f"{name}_given" for name in FLAT_METRICS]],
    )
    # an entry that is no number is missing from the converted map
    bad = F.coalesce(F.size("numbers") < F.col("entries"), F.lit(False))
    for name in FLAT_METRICS:
        bad = bad | (F.col(f"{name}_given") & F.col(name).isNull())
    return converted.select(
        *kept, F.col("numbers").alias("metrics"), *FLAT_METRICS, F.when(bad, F.lit("invalid number")).alias("problem")
    )


def checked_rest(payloads: DataFrame) -> DataFrame:
    """Payload rows with their merged metrics and the reason to refuse them, if any."""
    flat = {name: F.col(name) for name in FLAT_METRICS}
    merged = with_flat_metrics(F.col("metrics"), flat)
    earlier = F.col("problem") if "problem" in payloads.columns else F.lit(None).cast("string")
    reason = F.coalesce(
        F.when(F.col("device_id").isNull(), F.lit("missing device_id")),
        earlier,
        F.when(F.size("merged") == 0, F.lit("no metrics")),
    )
    return with_computed(payloads, {"merged": merged}, payloads.columns).withColumn("reason", reason)


def normalize_rest(
    payloads: DataFrame, received: str = "received_at", keep: tuple[str, ...] = ()
) -> DataFrame:
    """REST payload rows to sensor messages; payloads that must be refused are left out."""
    return accepted_rest(checked_rest(payloads), received, keep)


def accepted_rest(
    checked: DataFrame, received: str = "received_at", keep: tuple[str, ...] = ()
) -> DataFrame:
    return (
        checked.filter(F.col("reason").isNull())
        .select(
            *keep,
            text_or(F.col("ts"), iso_utc(F.col(received))).alias("ts"),
            "device_id",
            text_or(F.col("location"), DEFAULT_LOCATION).alias("location"),
            text_or(F.col("model"), DEFAULT_MODEL).alias("model"),
            clamp_percentages(F.col("merged")).alias("metrics"),
            F.lit(SOURCE_REST).alias("source"),
        )
    )


def rejected_rest(payloads: DataFrame) -> DataFrame:
    """The payload rows ``normalize_rest`` leaves out, with the reason."""
    return refused_rest(checked_rest(payloads))


def refused_rest(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNotNull()).drop("merged", "problem")


def normalize_mqtt(
    records: DataFrame,
    received: str = "received_at",
    topic: str = "topic",
    value: str = "payload",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """MQTT records to sensor messages; nothing is refused.

    The device comes from the payload, else from the second topic segment. Entries
    that are no numbers are skipped. A record without any metric that is no JSON
    object, or has a ``raw`` member, keeps that text in column ``raw``.
    """
    text = F.trim(F.make_valid_utf8(F.col(value).cast("string")), F.lit(WHITESPACE))
    trimmed = records.select(
        *keep, F.col(topic).alias("topic"), F.col(received).alias("received"), text.alias("text")
    )
    opened = with_json(
        trimmed, F.col("text"), schemas.MQTT_PAYLOAD, (*keep, "topic", "received", "text")
    )
    is_object = F.json_object_keys("text").isNotNull() & F.col("text").endswith("}")
    flat = {name: to_double(F.col(name)) for name in FLAT_METRICS}
    metrics = clamp_percentages(with_flat_metrics(numeric_entries(F.col("metrics")), flat))
    raw = F.when(is_object, F.col("raw")).otherwise(F.col("text"))
    from_topic = F.coalesce(
        F.try_element_at(F.split("topic", "/"), F.lit(2)), F.lit("mqtt-device")
    )
    return opened.withColumn("numbers", metrics).select(
        *keep,
        text_or(F.col("ts"), iso_utc(F.col("received"))).alias("ts"),
        text_or(F.col("device_id"), from_topic).alias("device_id"),
        text_or(F.col("location"), DEFAULT_LOCATION).alias("location"),
        text_or(F.col("model"), DEFAULT_MODEL).alias("model"),
        F.col("numbers").alias("metrics"),
        F.when(F.size("numbers") == 0, raw).alias("raw"),
        F.lit(SOURCE_MQTT).alias("source"),
        "topic",
    )


def normalize_board(
    requests: DataFrame,
    path: str = "path",
    received: str = "received_at",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Board requests ``/temperature/humidity/soil/device1/device2`` to board events.

    Paths with another number of segments or with unreadable numbers are left out.
    """
    parts = F.split(F.col(path), "/")
    numbers = {
        "temperature": to_double(parts[1]),
        "humidity": to_double(parts[2]),
        "soil_moisture": parts[3].try_cast("int"),
    }

    def switch(name: str, state: Column) -> Column:
        shown = F.when(state == "1", F.lit("ON")).otherwise(F.lit("OFF"))
        return F.struct(F.lit(name).alias("name"), shown.alias("state"))

    complete = (F.size(parts) == 6) & ~F.exists(F.slice(parts, 2, 5), lambda p: p == "")
    return (
        requests.filter(complete)
        .select(
            *keep,
            F.lit("iot_event").alias("type"),
            *[number.alias(name) for name, number in numbers.items()],
            switch("pump", parts[4]).alias("device1"),
            switch("fan", parts[5]).alias("device2"),
            (F.unix_micros(F.col(received)) / 1e6).alias("timestamp"),
        )
        .dropna(subset=list(numbers))
    )
