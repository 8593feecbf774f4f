"""Message topics, read as streams or as static records.

The broker connector is a package the cluster provides. A folder of files with the
same columns can stand in for a topic, which is how the tests feed every stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.settings import BrokerSettings


def topic_options(broker: BrokerSettings, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": broker.bootstrap,
        "subscribe": topic,
        "startingOffsets": broker.starting_offsets,
        "failOnDataLoss": str(broker.fail_on_data_loss).lower(),
    }


def topic_stream(spark: SparkSession, broker: BrokerSettings, topic: str) -> DataFrame:
    """Endless records of a topic, rate limited per trigger if the deployment says so."""
    reader = spark.readStream.format("kafka").options(**topic_options(broker, topic))
    if broker.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(broker.max_offsets_per_trigger))
    return reader.load()


def topic_records(
    spark: SparkSession, broker: BrokerSettings, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """The records a topic holds now.

    ``starting`` and ``ending`` are names or JSON offsets per partition; with the
    latter an inspection reads no more than the records it shows.
    """
    options = {**topic_options(broker, topic), "startingOffsets": starting, "endingOffsets": ending}
    return spark.read.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of files as they appear in a folder."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.load(path)
