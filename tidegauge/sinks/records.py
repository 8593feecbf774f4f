"""Topics and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.operators.messages import anomaly_messages
from tidegauge.operators.registry import anomaly_columns
from tidegauge.settings import BrokerSettings, JdbcSettings
from tidegauge.sources.tables import jdbc_options


def publish(records: DataFrame, broker: BrokerSettings, topic: str) -> None:
    """Write (key, value) records to a topic; an empty input sends nothing."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", broker.bootstrap)
        .option("topic", topic)
        .save()
    )


def publish_stream(
    records: DataFrame, broker: BrokerSettings, topic: str, checkpoint: str
) -> DataStreamWriter:
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", broker.bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def publish_anomalies(found: DataFrame, broker: BrokerSettings) -> None:
    publish(anomaly_messages(found), broker, broker.anomaly_topic)


def store_anomalies(found: DataFrame, jdbc: JdbcSettings) -> None:
    """Append anomalies to the registry table of a database.

    A micro-batch repeated after a failure appends its rows again.
    """
    anomaly_columns(found).write.format("jdbc").options(**jdbc_options(jdbc)).mode(
        "append"
    ).save()
