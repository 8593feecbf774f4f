"""The jobs of a deployment, from a source DataFrame to running sinks.

Each takes its records as an argument, so it runs on a topic, on files or on a
test stream alike. ``main`` wires them to the environment.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge import schemas, settings
from tidegauge.operators import alerts, anomaly, messages, metrics, normalize, offline, parsing
from tidegauge.session import build_session
from tidegauge.sinks import files, records, timeseries
from tidegauge.sources import tables, topics
from tidegauge.streaming import closing, runner
from tidegauge.streaming.fanout import Ledger, Sink, after, fan_out


def parsed_messages(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """Topic records to the messages that can be used."""
    return parsing.valid_messages(parsing.parse_messages(raw, mode=mode))


def sensor_rows(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """Topic records to readings."""
    return metrics.explode_metrics(parsed_messages(raw, mode))


def archive(raw: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Every message that names a device, into the lake by day."""
    rows = parsing.archive_rows(parsing.parse_messages(raw))
    return files.archive_stream(rows, path, checkpoint)


def speed(
    raw: DataFrame,
    sinks: Iterable[Sink],
    checkpoint: str,
    scoring: settings.ScoringSettings = settings.ScoringSettings(),
) -> DataStreamWriter:
    """Readings scored when their window closes, handed to all sinks.

    Readings that no window takes any more come out unscored, with the reason.
    """
    closed = closing.closed_windows(sensor_rows(raw), scoring.window, scoring.watermark, scoring.salts)

    def score(batch: DataFrame) -> DataFrame:
        return closing.score_closed(batch, scoring.window, scoring.min_std)

    ledger = Ledger(raw.sparkSession, os.path.join(checkpoint, "delivered"))
    return closed.writeStream.foreachBatch(after(score, fan_out(sinks, ledger))).option("checkpointLocation", checkpoint)


def live_metrics(
    raw: DataFrame, send: Callable[[str], None], checkpoint: str
) -> DataStreamWriter:
    """Messages as line protocol at once, without waiting for a window to close."""

    def deliver(rows: DataFrame, _: int) -> None:
        timeseries.deliver_lines(rows, send)

    return (
        messages.message_lines(parsing.valid_messages(parsing.parse_messages(raw)))
        .writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
    )


def offline_statistics(lake: DataFrame, path: str, since: str | None = None) -> None:
    """Daily statistics of the lake; with ``since`` only those days are replaced."""
    files.overwrite_days(
        offline.daily_stats(lake, since), path, only_given_days=since is not None
    )


def export_thresholds(daily: DataFrame, path: str, k: float = 3.0) -> None:
    """Thresholds of all series from the daily statistics, replacing the table at ``path``."""
    offline.thresholds(daily, k).write.mode("overwrite").parquet(path)


def publish_thresholds(daily: DataFrame, path: str, valid_from: str, k: float = 3.0) -> None:
    """Add a version of the thresholds that holds from an instant on; earlier versions stay.

    The version has a folder of its own, so a repeated run replaces it.
    """
    version = offline.thresholds(daily, k).withColumn("valid_from", F.lit(valid_from).cast("timestamp"))
    name = re.sub(r"\W", "-", valid_from)
    version.write.mode("overwrite").parquet(os.path.join(path, f"version={name}"))


def threshold_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions published so far; a folder that is still being written has no complete file."""
    return spark.read.schema(schemas.THRESHOLDS).parquet(path)


def speed_against_thresholds(
    raw: DataFrame, path: str, sinks: Iterable[Sink], checkpoint: str, min_std: float = settings.MIN_STD
) -> DataStreamWriter:
    """Readings scored at once against the thresholds in force at their time, handed to all sinks.

    The versions are read anew for every micro-batch, so a version published while the
    stream runs holds for the readings from its instant on.
    """

    def score(batch: DataFrame) -> DataFrame:
        versions = threshold_versions(batch.sparkSession, path)
        return offline.score_as_of(batch, versions, min_std)

    ledger = Ledger(raw.sparkSession, os.path.join(checkpoint, "delivered"))
    return (
        sensor_rows(raw)
        .writeStream.foreachBatch(after(score, fan_out(sinks, ledger)))
        .option("checkpointLocation", checkpoint)
    )


def ingest(
    bodies: DataFrame,
    accepted: Callable[[DataFrame, int], None],
    refused: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> DataStreamWriter:
    """Request bodies to messages keyed by device; refused ones apart, with their reason.

    ``bodies`` has value and received_at. Both go out of one micro-batch, which is
    computed once.
    """
    checked = normalize.checked_rest(normalize.read_rest_payloads(bodies))
    sinks = [
        Sink("accepted", accepted, lambda rows: messages.sensor_records(normalize.accepted_rest(rows))),
        Sink("refused", refused, normalize.refused_rest),
    ]
    return checked.writeStream.foreachBatch(fan_out(sinks)).option("checkpointLocation", checkpoint)


def alert_rows(
    found: DataFrame, rules: settings.AlertSettings = settings.AlertSettings()
) -> DataFrame:
    """Anomaly records to the alert lines they raise."""
    raised = alerts.alerting(alerts.read_events(found), rules.threshold, rules.only_flagged)
    return alerts.alert_lines(raised)


def speed_sinks(
    env: Mapping[str, str], z_threshold: float, broker: settings.BrokerSettings
) -> list[Sink]:
    """The sinks switched on in the environment.

    Only publishing to the topic may fail without failing the micro-batch.
    """

    def found(batch: DataFrame) -> DataFrame:
        return anomaly.anomalies(batch, z_threshold)

    sinks = []
    if settings.flag(env, "WRITE_TO_POSTGRES", True):
        jdbc = settings.JdbcSettings.from_env(env)
        sinks.append(
            Sink("database", lambda rows, _: records.store_anomalies(rows, jdbc), found)
        )
    if settings.flag(env, "WRITE_TO_KAFKA", True):
        sinks.append(
            Sink(
                "topic",
                lambda rows, _: records.publish_anomalies(rows, broker),
                found,
                required=False,
            )
        )
    if settings.flag(env, "WRITE_TO_INFLUX", True):
        target = settings.TimeSeriesSettings.from_env(env)
        send = timeseries.HttpTransport.of(target)

        def points(batch: DataFrame) -> DataFrame:
            return messages.metric_lines(batch, target.metrics_measurement)

        def marks(batch: DataFrame) -> DataFrame:
            return messages.anomaly_lines(found(batch), target.anomalies_measurement)

        for name, view in (("metrics", points), ("anomalies", marks)):
            sinks.append(Sink(name, lambda rows, _: timeseries.deliver_lines(rows, send), view))
    return sinks


def run(job: str, spark: SparkSession, env: Mapping[str, str]) -> None:
    broker = settings.BrokerSettings.from_env(env)
    if job in ("offline", "thresholds"):
        lake = settings.LakeSettings.from_env(env)
        if job == "offline":
            path = settings.require(env, "OFFLINE_STATS_S3_PATH") if not lake.offline_path else lake.offline_path
            offline_statistics(tables.lake(spark, lake.raw_path), path, env.get("OFFLINE_SINCE"))
        else:
            daily = offline.daily_stats(tables.lake(spark, lake.raw_path), env.get("OFFLINE_SINCE"))
            now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
            publish_thresholds(daily, settings.require(env, "THRESHOLDS_S3_PATH"), env.get("VALID_FROM", now))
        return
    if job == "inspect":
        held = topics.topic_records(
            spark, broker, broker.raw_topic, env.get("STARTING_OFFSETS", "earliest"), env.get("ENDING_OFFSETS", "latest")
        )
        shown = messages.inspect_messages(
            held, int(env.get("MAX_MESSAGES", "5")), newest=settings.flag(env, "NEWEST", False)
        )
        files.print_lines(shown.select(F.to_json(F.struct("*"))))
        return

    checkpoint = settings.checkpoint_location(job, env)
    topic = broker.anomaly_topic if job == "alerts" else broker.raw_topic
    source = topics.topic_stream(spark, broker, topic)
    if job == "archive":
        writer = archive(source, settings.LakeSettings.from_env(env).raw_path, checkpoint)
    elif job == "limits":
        scoring = settings.ScoringSettings.from_env(env)
        path = settings.require(env, "THRESHOLDS_S3_PATH")
        sinks = speed_sinks(env, scoring.z_threshold, broker)
        writer = speed_against_thresholds(source, path, sinks, checkpoint, scoring.min_std)
    elif job == "ingest":
        bodies = topics.topic_stream(spark, broker, settings.require(env, "KAFKA_TOPIC_PAYLOADS")).select(
            F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at")
        )
        writer = ingest(
            bodies,
            lambda rows, _: records.publish(rows, broker, broker.raw_topic),
            files.batch_writer(settings.require(env, "QUARANTINE_PATH")),
            checkpoint,
        )
    elif job == "speed":
        scoring = settings.ScoringSettings.from_env(env)
        sinks = speed_sinks(env, scoring.z_threshold, broker)
        writer = speed(source, sinks, checkpoint, scoring)
    elif job == "metrics":
        send = timeseries.HttpTransport.of(settings.TimeSeriesSettings.from_env(env))
        writer = live_metrics(source, send, checkpoint)
    else:
        lines = alert_rows(source, settings.AlertSettings.from_env(env))
        if env.get("ALERT_PATH"):
            writer = files.text_stream(lines, env["ALERT_PATH"], checkpoint)
        elif env.get("KAFKA_TOPIC_ALERTS"):
            writer = records.publish_stream(lines, broker, env["KAFKA_TOPIC_ALERTS"], checkpoint)
        elif settings.flag(env, "ALERT_CONSOLE", False):
            # every line passes the driver: for a person who watches, not for a deployment
            writer = files.console_stream(lines, checkpoint)
        else:
            raise settings.MissingSetting("set ALERT_PATH, KAFKA_TOPIC_ALERTS or, to watch, ALERT_CONSOLE=true")
    runner.start(writer)
    runner.wait_for_any(spark)


JOBS = ("ingest", "archive", "speed", "metrics", "offline", "thresholds", "limits", "alerts", "inspect")


def main(arguments: list[str] | None = None) -> int:
    arguments = sys.argv[1:] if arguments is None else arguments
    if len(arguments) != 1 or arguments[0] not in JOBS:
        print(f"usage: python -m tidegauge {{{'|'.join(JOBS)}}}", file=sys.stderr)
        return 2
    run(arguments[0], build_session(f"tidegauge-{arguments[0]}"), os.environ)
    return 0
