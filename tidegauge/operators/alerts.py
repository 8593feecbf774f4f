"""Which anomaly messages raise an alert, and the alert text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.once import with_computed
from tidegauge.functions.values import number_text, text_or, to_double
from tidegauge.settings import ALERT_THRESHOLD


def read_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Anomaly messages as columns score, flag and the texts an alert shows.

    Score and flag both come from the nested ``anomaly`` object when the top level
    has no score. A JSON number or boolean is a score and a flag; a text is a score
    if it reads as a number and a flag only if it reads as a whole number. What
    cannot be converted is null. Messages that are no JSON object are skipped.
    """
    text = F.col(value).cast("string")
    objects = messages.filter(text.rlike(r"^\s*\{")).select(text.alias("text"))
    # numbers JSON has no form for are put in quotes, where a text holds such and cannot be read otherwise
    quoted = F.regexp_replace("text", r"(?<=[:\s])(NaN|-?Infinity)(?=[\s,}])", '"$1"')
    body = F.coalesce(F.try_parse_json("text"), F.when(quoted != F.col("text"), F.try_parse_json(quoted)))
    parsed = with_computed(objects, {"body": body}, [])

    def at(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("body", f"$.{path}", kind)

    shown = {name: at(name) for name in ("ts", "event_ts", "device_id", "deviceId", "metric")}
    # a JSON null is no score either
    top = at("score", "variant")
    nested = top.isNull() | F.is_variant_null(top)
    fields = {
        name: F.when(nested, at(f"anomaly.{name}", "variant")).otherwise(at(name, "variant"))
        for name in ("score", "is_anomaly")
    }
    events = with_computed(parsed, {**shown, **fields, "nested_metric": at("anomaly.metric")}, [])

    def of(name: str, kind: str) -> Column:
        """A field as text, or as what it is if it has the JSON type ``kind``."""
        of_kind = F.schema_of_variant(F.col(name))
        got = F.try_variant_get(name, "$", kind)
        if kind == "string":
            return got
        return F.when(of_kind == "BOOLEAN" if kind == "boolean" else ~of_kind.isin("BOOLEAN", "STRING", "VOID"), got)

    score = F.coalesce(of("score", "boolean").cast("double"), to_double(of("score", "string")))
    whole = F.regexp_extract(of("is_anomaly", "string"), r"^\s*([+-]?[0-9]+)\s*$", 1)
    flag = F.coalesce(
        of("is_anomaly", "boolean").cast("int"), of("is_anomaly", "double").try_cast("int"), whole.try_cast("int")
    )
    device = text_or(F.col("device_id"), text_or(F.col("deviceId"), "unknown-device"))
    metric = text_or(F.col("metric"), text_or(F.col("nested_metric"), "unknown-metric"))
    return events.select(
        score.alias("score"),
        flag.alias("flag"),
        text_or(F.col("ts"), text_or(F.col("event_ts"), "unknown-ts")).alias("ts"),
        device.alias("device_id"),
        metric.alias("metric"),
    )


def alerting(
    events: DataFrame, threshold: float = ALERT_THRESHOLD, only_flagged: bool = True
) -> DataFrame:
    """Events that alert.

    With ``only_flagged`` a present flag decides alone; otherwise the score must
    reach the threshold. Events without a score never alert.
    """
    score = F.col("score")
    far = ~F.isnan(score) & (F.abs(score) >= threshold)
    if only_flagged:
        far = F.when(F.col("flag").isNotNull(), F.col("flag") == 1).otherwise(far)
    return events.filter(score.isNotNull() & far)


def alert_lines(events: DataFrame) -> DataFrame:
    """One text line per event."""
    text = F.format_string(
        "[ANOMALY ALERT] ts=%s device_id=%s metric=%s score=%s flag=%s",
        F.col("ts"),
        F.col("device_id"),
        F.col("metric"),
        number_text(F.col("score")),
        F.coalesce(F.col("flag").cast("string"), F.lit("None")),
    )
    return events.select(text.alias("value"))
