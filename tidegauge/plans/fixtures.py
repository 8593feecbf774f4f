"""Sensor data derived from the test tables.

Every view covers all rows of the table it is made from. ``oracles.py`` holds the
same views in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.sources import topics

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The events table with ts as an instant, as Spark's watermarks need it."""
    if streaming:
        # a pattern, because a streamed path may then be a single file or a folder
        path = f"{sf_dir}/events.parque[t]"
        rows = topics.file_stream(spark, path, EVENTS_SCHEMA)
    else:
        rows = table(spark, sf_dir, "events")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def sensor_rows(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Readings of two devices; a quarter of them has no model."""
    return events(spark, sf_dir, streaming).selectExpr(
        "ts",
        "concat('dev-', user_id % 2) as device_id",
        "concat('zone', user_id % 2 + 1) as location",
        "case when user_id % 4 <> 3 then concat('model-', user_id % 2) end as model",
        "event_type as metric",
        "value",
    )


def fleet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of 120 devices named like suppliers, not all of which exist."""
    return events(spark, sf_dir).selectExpr(
        "ts",
        "concat('sup-', user_id % 120) as device_id",
        "concat('zone', user_id % 120 % 4) as location",
        "concat('model-', user_id % 120 % 3) as model",
        "event_type as metric",
        "value",
    )


def wide_rows(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Readings with temperature and humidity in columns, from the events."""
    return events(spark, sf_dir, streaming).selectExpr(
        "ts as event_ts",
        "concat('dev-', user_id % 2) as device_id",
        "value as temperature",
        "case when event_type <> 'error' then value / 2 end as humidity",
    )


def sensor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message with four metrics per order line, sent by its supplier."""
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    placed = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return placed.select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.concat(F.lit("sup-"), "l_suppkey").alias("device_id"),
        F.col("n_name").alias("location"),
        F.col("l_returnflag").alias("model"),
        F.create_map(
            F.lit("quantity"), "l_quantity",
            F.lit("price"), "l_extendedprice",
            F.lit("discount"), "l_discount",
            F.lit("tax"), "l_tax",
        ).alias("metrics"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device registry: one device per supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('sup-', s_suppkey) as device_id",
        "s_nationkey + 1 as zone_id",
        "concat('model-', s_suppkey % 3) as model",
        "case when s_suppkey % 2 = 0 then 'Environment' else 'Process Gauge' end as sensor_type",
        "case when s_suppkey % 3 = 0 then 'quantity, price, voltage'"
        " else 'quantity,price , discount, tax' end as metrics",
        "'' as base_values",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey + 1 as zone_id",
        "n_name as zone_code",
        "concat('Zone ', n_name) as zone_name",
        "case when n_nationkey % 2 = 0 then 'REST' else 'MQTT' end as protocol",
    )


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey + 1 as int) as schedule_id",
        "concat('sup-', s_suppkey) as device_id",
        "date_add(date '2024-01-01', cast(s_suppkey % 30 as int)) as last_maintained",
        "date_add(date '2024-01-01', cast(s_suppkey % 30 as int) + 90) as next_maintained",
        "'preventive' as maint_type",
        "cast(null as string) as notes",
    )


def iso(ts: str, pattern: str = "yyyy-MM-dd''T''HH:mm:ss.SSSSSS") -> str:
    return f"date_format({ts}, '{pattern.replace(chr(39) * 2, chr(92) + chr(39))}')"


def message_records(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Topic records of sensor messages, good and bad, one per event."""
    head = (
        f"""concat('{{"ts":"', {iso('ts')}, 'Z","device_id":"dev-', user_id % 2, """
        """'","location":"zone', user_id % 2 + 1, '","model":"model-0",')"""
    )
    text = f"""case event_id % 8
        when 1 then concat({head}, '"metrics":{{"', event_type, '":"', value, '"}}}}')
        when 2 then concat({head}, '"metrics":{{"', event_type, '":', value, ',"note":"x"}}}}')
        when 3 then concat({head}, '"metrics":[1]}}')
        when 4 then concat({head}, '"extra":', value, '}}')
        when 5 then concat('not json ', event_id)
        when 6 then concat('{{"ts":"', {iso('ts')}, 'Z","metrics":{{"', event_type, '":', value, '}}}}')
        when 7 then concat('{{"ts":"bad","device_id":"dev-', user_id % 2, '","metrics":{{"', event_type, '":', value, '}}}}')
        else concat({head}, '"metrics":{{"', event_type, '":', value, ',"level":', user_id % 10, '}}}}')
        end"""
    return events(spark, sf_dir, streaming).selectExpr(
        "cast(concat('dev-', user_id % 2) as binary) as key",
        f"cast({text} as binary) as value",
        "'iot.sensor.raw' as topic",
        "cast(user_id % 3 as int) as partition",
        "event_id as offset",
        "ts as timestamp",
    )


def rest_bodies(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Request bodies, acceptable and not, one per event."""
    text = f"""case event_id % 8
        when 0 then concat('{{"device_id":"d', user_id, '","ts":"', {iso('ts')}, 'Z","metrics":{{"temperature":1,"x":', value, '}},"temperature":', value, '}}')
        when 1 then concat('{{"device_id":"d', user_id, '","humidity":', value, ',"location":"lab","model":"M1"}}')
        when 2 then concat('{{"device_id":"d', user_id, '"}}')
        when 3 then concat('{{"temperature":', value, '}}')
        when 4 then concat('{{"device_id":"d', user_id, '","metrics":{{"x":"abc","y":', value, '}}}}')
        when 5 then concat('{{"device_id":"d', user_id, '","ts":"","location":"","metrics":{{"x":', value, '}},"soil_moisture":', value - 100, '}}')
        when 6 then concat('{{"device_id":"d', user_id, '","metrics":{{"humidity":', value - 50, '}},"humidity":null}}')
        else concat('{{"device_id":"d', user_id, '","metrics":{{}},"temperature":null}}')
        end"""
    return events(spark, sf_dir, streaming).selectExpr("event_id", "ts as received_at", f"{text} as value")


def mqtt_records(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """MQTT records with full, flat, partly numeric and plain-text payloads."""
    topic = """case user_id % 3 when 0 then 'iot'
        when 1 then concat('iot/node-', user_id, '/telemetry') else 'iot/gate' end"""
    text = f"""case event_id % 7
        when 0 then concat('  {{"device_id":"d', user_id, '","ts":"', {iso('ts')}, 'Z","metrics":{{"temperature":1,"x":', value, ',"bad":"abc"}},"temperature":', value, '}} ')
        when 1 then concat('{{"humidity":', value, ',"soil_moisture":"', value - 100, '","temperature":"warm"}}')
        when 2 then concat('hello ', event_id)
        when 3 then concat('[', value, ']')
        when 4 then concat('{{"device_id":"","location":"lab","raw":"code ', event_id, '"}}')
        when 5 then concat('{{"device_id":"d', user_id, '","metrics":[1],"x":', value, '}}')
        else concat('{{"device_id":"d', user_id, '","metrics":{{"x":', value, '}}')
        end"""
    return events(spark, sf_dir, streaming).selectExpr(
        "event_id", "ts as received_at", f"{topic} as topic", f"cast({text} as binary) as payload"
    )


def board_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board request paths; some lack a segment or carry unreadable numbers."""
    path = """case event_id % 6
        when 4 then concat('/', value, '/', user_id, '/7/1')
        when 5 then concat('/', value, '/', user_id, '/7.5/1/0')
        else concat('/', value, '/', user_id / 10, '/', event_id % 100, '/', user_id % 2, '/', event_id % 2)
        end"""
    return events(spark, sf_dir).selectExpr("event_id", "ts as received_at", f"{path} as path")


def alert_messages(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Anomaly messages in all accepted shapes; the event value is the score."""
    head = """'{"ts":"t', event_id, '","device_id":"d', user_id, '",'"""
    text = f"""case event_id % 11
        when 0 then concat({head}, '"metric":"', event_type, '","score":', value / 20, ',"is_anomaly":1}}')
        when 1 then concat('{{"event_ts":"t', event_id, '","deviceId":"d', user_id, '","metric":"","score":', value / 20, ',"is_anomaly":0}}')
        when 2 then concat({head}, '"score":-', value / 20, '}}')
        when 3 then concat({head}, '"is_anomaly":1}}')
        when 4 then concat('{{"device_id":"d', user_id, '","anomaly":{{"score":', value / 20, ',"is_anomaly":true,"metric":"', event_type, '"}}}}')
        when 5 then concat({head}, '"score":"abc","is_anomaly":1}}')
        when 7 then concat({head}, '"score":"', value / 20, '","is_anomaly":"true"}}')
        when 8 then concat({head}, '"score":', value / 20, ',"is_anomaly":"1.0"}}')
        when 9 then concat({head}, '"score":true}}')
        when 10 then concat({head}, '"score":', value / 20, ',"is_anomaly":1.0}}')
        else concat('[', value, ']')
        end"""
    return events(spark, sf_dir, streaming).selectExpr("event_id", f"{text} as value")


# Added before rounding, so that a mean lying exactly between two roundings does
# not fall to either side with the order of a floating-point sum.
TIE_SHIFT = 1.23e-8


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable result: instants without zone, doubles rounded."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c + TIE_SHIFT, digits)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def arrivals(rows: DataFrame, folder: str, *parts: str) -> Iterator[str]:
    """Add rows to a folder of Parquet files part by part; what comes after a part runs before the next."""
    for condition in parts:
        rows.filter(condition).write.mode("append").parquet(folder)
        yield condition


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of ``sensor_rows`` with the number of their event."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "ts",
        "concat('dev-', user_id % 2) as device_id",
        "concat('zone', user_id % 2 + 1) as location",
        "case when user_id % 4 <> 3 then concat('model-', user_id % 2) end as model",
        "event_type as metric",
        "value",
    )
