"""Registered queries: one callable per operator, over the whole test tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.scores import severity
from tidegauge.functions.times import parse_ts
from tidegauge.functions.values import soil_percent
from tidegauge.operators import (
    alerts,
    anomaly,
    ewma,
    messages,
    metrics,
    normalize,
    offline,
    parsing,
    registry,
)
from tidegauge.plans import fixtures as fx
from tidegauge import schemas
from tidegauge.plans import jobs
from tidegauge.session import scratch_dir, tune
from tidegauge.sinks import files, increments, layout, upserts
from tidegauge.sinks.compaction import CompactedLake
from tidegauge.sources import spool, tables, topics
from tidegauge.streaming import closing, runner
from tidegauge.streaming import ewma as stateful_ewma
from tidegauge.streaming.fanout import Ledger, Sink, after, fan_out

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Instant the "last 24 hours" and "last 15 minutes" reports look back from.
AS_OF = "2024-01-30 00:00:00"
DAY = "1 day"
FLEET_WINDOW = "30 days"
DELAY = "2 minutes"
# Thresholds are learned from the days up to this one.
LEARNED_UNTIL = "2024-01-15"


def query(f: Query) -> Query:
    """Register a query; it runs on a session with the library's settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(tune(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


# --- scoring -----------------------------------------------------------------


def _daily_scores(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    rows = fx.sensor_rows(spark, sf_dir, streaming)
    return anomaly.score_rows(rows, DAY, watermark=DELAY if streaming else None)


def _fleet_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomalies(anomaly.score_rows(fx.fleet_rows(spark, sf_dir), FLEET_WINDOW))


@query
def zscore_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(anomaly.anomalies(_daily_scores(spark, sf_dir)))


@query
def window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = anomaly.window_stats(fx.sensor_rows(spark, sf_dir), DAY)
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return fx.plain(stats.select(*bounds, *[c for c in stats.columns if c != "w"]))


def _flat_scores(scored: DataFrame) -> DataFrame:
    return fx.plain(
        scored.select(F.col("w.end").alias("window_end"), *[c for c in scored.columns if c != "w"])
    )


@query
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_scores(_daily_scores(spark, sf_dir))


@query
def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All severities, from windows long enough to reach them."""
    scored = anomaly.score_rows(
        fx.sensor_rows(spark, sf_dir), FLEET_WINDOW, keys=("device_id", "metric")
    )
    return (
        scored.withColumn("severity", severity(F.col("abs_z")))
        .groupBy("severity")
        .agg(F.count("*").alias("n"), F.count("zscore").alias("n_scored"))
    )


@query
def wide_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = anomaly.wide_window_stats(
        parsing.valid_wide(fx.wide_rows(spark, sf_dir)), window="6 hours"
    )
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return fx.plain(stats.select(*bounds, *[c for c in stats.columns if c != "w"]))


@query
def window_rule_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = anomaly.wide_window_stats(
        parsing.valid_wide(fx.wide_rows(spark, sf_dir)), window="6 hours"
    )
    return fx.plain(anomaly.window_rule_anomalies(stats, mean_ceiling=60.0, std_ceiling=55.0))


@query
def sliding_peak_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(
        anomaly.sliding_peak_anomalies(
            fx.wide_rows(spark, sf_dir), window=DAY, slide="6 hours", min_score=4.0
        )
    )


# --- parsing -----------------------------------------------------------------


def _with_readings(df: DataFrame) -> DataFrame:
    """The metrics map as comparable columns: entry count and sorted entries."""

    def entry(e: Column) -> Column:
        return F.concat(e["key"], F.lit("="), F.coalesce(e["value"].cast("decimal(18,4)").cast("string"), F.lit("null")))

    return df.select(
        *[c for c in df.columns if c != "metrics"],
        F.when(F.col("metrics").isNotNull(), F.size("metrics")).alias("n_metrics"),
        F.array_join(F.array_sort(F.transform(F.map_entries("metrics"), entry)), ",").alias("readings"),
    )


@query
def parse_messages_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.message_records(spark, sf_dir)
    return fx.plain(_with_readings(parsing.parse_messages(records, keep=("offset",))))


@query
def parse_messages_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.message_records(spark, sf_dir)
    parsed = parsing.parse_messages(records, mode="lenient", keep=("offset",))
    return fx.plain(_with_readings(parsed))


@query
def valid_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsing.parse_messages(fx.message_records(spark, sf_dir), keep=("offset",))
    return fx.plain(_with_readings(parsing.valid_messages(parsed)))


@query
def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsing.parse_messages(fx.message_records(spark, sf_dir), keep=("offset",))
    return fx.plain(_with_readings(parsing.archive_rows(parsed)))


@query
def explode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsing.parse_messages(
        fx.message_records(spark, sf_dir), mode="lenient", keep=("offset",)
    )
    rows = metrics.explode_metrics(
        parsing.valid_messages(parsed), carry=("offset", "ts", "device_id", "location", "model")
    )
    return fx.plain(rows)


@query
def explode_order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(metrics.explode_metrics(fx.sensor_messages(spark, sf_dir)))


@query
def metric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("price", "quantity", "voltage")
    return fx.plain(parsing.metric_columns(fx.sensor_messages(spark, sf_dir), names))


@query
def normalize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps written in six ways, two of them unreadable, and read back."""
    iso = fx.iso("ts")
    shifted = fx.iso("ts + interval 7 hours")
    text = f"""case event_id % 6 when 0 then concat({iso}, 'Z')
        when 1 then concat({shifted}, '+07:00')
        when 2 then concat({fx.iso("ts", "yyyy-MM-dd''T''HH:mm:ss.SSS")}, '+00:00')
        when 3 then concat({fx.iso("ts", "yyyy-MM-dd''T''HH:mm:ss")}, 'Z')
        when 4 then {fx.iso("ts", "yyyy-MM-dd")}
        else cast(event_id as string) || 'x' end"""
    rows = fx.events(spark, sf_dir).selectExpr("event_id", f"{text} as text")
    read = parse_ts(F.col("text"))
    return fx.plain(rows.select("event_id", read.alias("ts"), F.to_date(read).alias("dt")))


# --- registry and reports ----------------------------------------------------


@query
def latest_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(registry.latest_anomalies(_fleet_anomalies(spark, sf_dir), 50))


@query
def anomaly_count_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.anomaly_count(_fleet_anomalies(spark, sf_dir), AS_OF)


@query
def top_devices_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.top_devices(_fleet_anomalies(spark, sf_dir), AS_OF)


@query
def anomalies_by_zone_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = registry.lookup(
        fx.devices(spark, sf_dir), fx.zones(spark, sf_dir), "zone_id", "zone_name"
    )
    found = _fleet_anomalies(spark, sf_dir).select("ts", "device_id")
    return registry.anomalies_by(found, known, "zone_name", "model")


@query
def before_after_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.before_after_maintenance(
        _fleet_anomalies(spark, sf_dir), fx.schedules(spark, sf_dir), days=7
    )


@query
def orphan_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.fleet_rows(spark, sf_dir)
    return registry.orphan_report(rows, fx.devices(spark, sf_dir), "device_id")


@query
def rows_of_known_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.fleet_rows(spark, sf_dir)
    return fx.plain(registry.valid_references(rows, fx.devices(spark, sf_dir), "device_id"))


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices first seen in the readings that the registry does not hold."""
    seen = fx.events(spark, sf_dir).selectExpr(
        "concat('sup-', user_id % 120) as device_id",
        "cast(user_id % 25 + 1 as int) as zone_id",
        "event_type as model",
        "event_id as position",
    )
    return registry.insert_if_absent(fx.devices(spark, sf_dir), seen, "device_id", "position")


@query
def device_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone_id found by zone_code, as when devices are inserted by code."""
    coded = fx.table(spark, sf_dir, "supplier").selectExpr(
        "concat('sup-', s_suppkey) as device_id",
        "case when s_suppkey % 10 = 0 then 'nowhere'"
        " else concat('NATION_', s_nationkey) end as zone_code",
    )
    return registry.lookup(coded, fx.zones(spark, sf_dir), "zone_code", "zone_id")


@query
def registry_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables recreated, filled, appended to and cleared; what each then holds."""
    root = scratch_dir(spark, "registry")
    files.recreate_registry(spark, root)
    files.append_table(fx.zones(spark, sf_dir), "zones", root)
    files.append_table(fx.devices(spark, sf_dir), "devices", root)
    files.append_table(fx.schedules(spark, sf_dir), "maintain_schedules", root)
    found = registry.anomaly_columns(_fleet_anomalies(spark, sf_dir))
    files.append_table(found, "anomalies", root)
    stored = tables.registry_table(spark, "anomalies", root)
    kept = os.path.join(root, "before-clearing")
    stored.write.parquet(kept)
    files.clear_table(spark, "anomalies", root)

    def held(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        return rows.select(F.lit(name).alias("name"), text.alias("row"))

    anomaly_key = ("device_id", "metric", "severity")
    return (
        held(tables.registry_table(spark, "zones", root), "zones", "zone_id", "zone_code", "zone_name")
        .unionByName(held(tables.registry_table(spark, "devices", root), "devices", "device_id", "zone_id", "model"))
        .unionByName(
            held(
                tables.registry_table(spark, "maintain_schedules", root),
                "maintain_schedules", "schedule_id", "device_id", "last_maintained",
            )
        )
        .unionByName(held(spark.read.parquet(kept), "anomalies before clearing", *anomaly_key))
        .unionByName(held(tables.registry_table(spark, "anomalies", root), "anomalies", *anomaly_key))
    )


@query
def series_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.sensor_rows(spark, sf_dir)
    return fx.plain(metrics.series_range(rows, AS_OF, "6 hours", "click", "dev-1"))


@query
def metric_regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(metrics.metrics_matching(fx.sensor_rows(spark, sf_dir), "click|view|sign"))


@query
def declared_vs_observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.explode_metrics(fx.sensor_messages(spark, sf_dir))
    return registry.declared_vs_observed(fx.devices(spark, sf_dir), rows)


# --- batch layer -------------------------------------------------------------


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.sensor_messages(spark, sf_dir).withColumn("dt", F.to_date("ts"))


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event readings as a lake of single-metric messages."""
    return fx.sensor_rows(spark, sf_dir).select(
        F.to_date("ts").alias("dt"),
        "device_id",
        F.create_map("metric", "value").alias("metrics"),
    )


@query
def offline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(offline.daily_stats(_lake(spark, sf_dir), gather="month"))


@query
def offline_stats_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive to day folders, read back a range of days, write and read statistics."""
    root = scratch_dir(spark, "lake")
    raw, stats = os.path.join(root, "raw"), os.path.join(root, "offline_stats")
    parsed = parsing.parse_messages(fx.message_records(spark, sf_dir), mode="lenient")
    files.overwrite_days(parsing.archive_rows(parsed), raw)
    kept = tables.lake(spark, raw)
    files.overwrite_days(offline.daily_stats(kept, "2024-01-05", "2024-01-20"), stats)
    files.overwrite_days(
        offline.daily_stats(kept, "2024-01-18", "2024-01-25"), stats, only_given_days=True
    )
    kept = spark.read.parquet(stats)
    return fx.plain(kept.select("dt", "device_id", "metric", "n", "mean", "stddev"))


@query
def trend_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(offline.trend(offline.daily_stats(_lake(spark, sf_dir), gather="month"), "month"))


@query
def trend_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(offline.trend(offline.daily_stats(_event_days(spark, sf_dir)), "week"))


@query
def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(offline.thresholds(offline.daily_stats(_lake(spark, sf_dir), gather="month"), k=2.0), 4)


@query
def threshold_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings against the thresholds of their device and metric, learned from earlier days."""
    daily = offline.daily_stats(_event_days(spark, sf_dir), until=LEARNED_UNTIL)
    limits = offline.thresholds(daily, k=2.0)
    return fx.plain(offline.score_against_thresholds(fx.sensor_rows(spark, sf_dir), limits))


@query
def window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(metrics.window_features(fx.sensor_rows(spark, sf_dir), "6 hours"))


@query
def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(metrics.downsample(fx.sensor_rows(spark, sf_dir), "1 hour"))


@query
def ewma_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = metrics.window_features(fx.sensor_rows(spark, sf_dir), "6 hours")
    return fx.plain(ewma.ewma_scores(means, block="5 days"))


# --- outgoing messages -------------------------------------------------------


@query
def anomaly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.anomalies(_daily_scores(spark, sf_dir))
    shown = found.withColumn("score", F.round("score", 4))
    return messages.anomaly_messages(shown)


@query
def metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines straight from messages."""
    return messages.message_lines(fx.sensor_messages(spark, sf_dir))


@query
def metric_lines_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines from readings that have to be brought together by point first."""
    return messages.metric_lines(fx.sensor_rows(spark, sf_dir))


@query
def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(_with_readings(metrics.metric_points(fx.sensor_rows(spark, sf_dir))), 4)


@query
def anomaly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.anomalies(_daily_scores(spark, sf_dir))
    return messages.anomaly_lines(found.withColumn("score", F.round("score", 4)))


@query
def alert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = alerts.read_events(fx.alert_messages(spark, sf_dir))
    shown = events.withColumn("score", F.round("score", 4))
    return alerts.alert_lines(alerts.alerting(shown))


@query
def alerts_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = alerts.read_events(fx.alert_messages(spark, sf_dir))
    return fx.plain(alerts.alerting(events, threshold=4.0, only_flagged=False), 4)


@query
def inspect_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.inspect_messages(fx.message_records(spark, sf_dir), 20)


@query
def inspect_newest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.inspect_messages(fx.message_records(spark, sf_dir), 20, newest=True)


@query
def inspect_all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.inspect_messages(fx.message_records(spark, sf_dir), 0)


# --- ingestion ---------------------------------------------------------------


@query
def normalize_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = normalize.read_rest_payloads(fx.rest_bodies(spark, sf_dir))
    return fx.plain(_with_readings(normalize.normalize_rest(payloads, keep=("event_id",))), 4)


@query
def rejected_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = normalize.read_rest_payloads(fx.rest_bodies(spark, sf_dir))
    return normalize.rejected_rest(payloads).select("event_id", "device_id", "reason")


@query
def normalize_mqtt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_mqtt(fx.mqtt_records(spark, sf_dir), keep=("event_id",))
    return fx.plain(_with_readings(rows), 4)


@query
def mqtt_wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the records published, and the metrics a strict reader gets from them."""
    rows = normalize.normalize_mqtt(fx.mqtt_records(spark, sf_dir))
    parsed = parsing.parse_messages(messages.sensor_records(rows), keep=("key",))
    return _with_readings(parsed).select("key", "device_id", "n_metrics", "readings")


@query
def normalize_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_board(fx.board_requests(spark, sf_dir), keep=("event_id",))
    switches = {
        f"{device}_{part}": F.col(f"{device}.{part}")
        for device in ("device1", "device2")
        for part in ("name", "state")
    }
    return fx.plain(rows.withColumns(switches).drop("device1", "device2"))


@query
def calibrate_soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.events(spark, sf_dir)
    raw = (F.col("user_id") * 37 % 4096).cast("int")
    return rows.select("event_id", raw.alias("raw"), soil_percent(raw).alias("percent"))


@query
def drop_nan_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN injected into a third of each column, nulls left as they are."""
    nan = F.lit(float("nan"))
    rows = fx.events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, nan).otherwise(F.col("value")).alias("temperature"),
        F.when(F.col("user_id") % 3 == 0, nan)
        .when(F.col("user_id") % 3 == 1, F.lit(None))
        .otherwise(F.col("value"))
        .alias("humidity"),
    )
    return metrics.drop_nan_readings(rows)


@query
def stream_normalize_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = normalize.read_rest_payloads(fx.rest_bodies(spark, sf_dir, True))
    rows = normalize.normalize_rest(payloads, keep=("event_id",))
    return fx.plain(_with_readings(runner.drained(rows, "rest")), 4)


@query
def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = normalize.read_rest_payloads(fx.rest_bodies(spark, sf_dir, True))
    rows = normalize.rejected_rest(payloads).select("event_id", "device_id", "reason")
    return runner.drained(rows, "rejected")


@query
def stream_normalize_mqtt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_mqtt(fx.mqtt_records(spark, sf_dir, True), keep=("event_id",))
    return fx.plain(_with_readings(runner.drained(rows, "mqtt")), 4)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job on a stream of bodies: keyed records as a reader gets them, and refused bodies with their reason."""
    root = scratch_dir(spark, "ingest")
    raw, refused = os.path.join(root, "raw"), os.path.join(root, "refused")
    bodies = fx.rest_bodies(spark, sf_dir, True)
    writers = files.batch_writer(raw), files.batch_writer(refused)
    runner.drain(jobs.ingest(bodies, *writers, os.path.join(root, "checkpoint")))
    parsed = parsing.parse_messages(spark.read.parquet(raw), keep=("key",))
    accepted = _with_readings(parsed).withColumn("reason", F.lit(None).cast("string"))
    left = spark.read.parquet(refused).select(F.col("device_id").alias("key"), "reason")
    return fx.plain(accepted.unionByName(left, allowMissingColumns=True), 4)


@query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alert line of a stream of anomaly messages, through the job's file sink."""
    root = scratch_dir(spark, "alerts")
    path = os.path.join(root, "lines")
    lines = jobs.alert_rows(fx.alert_messages(spark, sf_dir, True))
    runner.drain(files.text_stream(lines, path, os.path.join(root, "checkpoint")))
    return spark.read.text(path)


# --- streams: what a stream gives for the data present --------------------------


@query
def stream_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_scores(runner.drained(_daily_scores(spark, sf_dir, True), "zscore"))


@query
def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.anomalies(_daily_scores(spark, sf_dir, True))
    return fx.plain(runner.drained(found, "anomalies"))


@query
def stream_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.sensor_rows(spark, sf_dir, True)
    stats = runner.drained(anomaly.window_stats(rows, DAY, watermark=DELAY), "stats")
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return fx.plain(stats.select(*bounds, *[c for c in stats.columns if c != "w"]))


@query
def stream_window_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsing.valid_wide(fx.wide_rows(spark, sf_dir, True))
    stats = anomaly.wide_window_stats(rows, window="6 hours", watermark=DELAY)
    found = anomaly.window_rule_anomalies(stats, mean_ceiling=60.0, std_ceiling=55.0)
    return fx.plain(runner.drained(found, "rule"))


@query
def stream_sliding_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.sliding_peak_anomalies(
        fx.wide_rows(spark, sf_dir, True), window=DAY, slide="6 hours", watermark=DELAY
    )
    return fx.plain(runner.drained(found, "peak"))


@query
def stream_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.sensor_rows(spark, sf_dir, True)
    features = metrics.window_features(rows, "6 hours", watermark=DELAY)
    return fx.plain(runner.drained(features, "features"))


@query
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "archive")
    parsed = parsing.parse_messages(fx.message_records(spark, sf_dir, True))
    path = os.path.join(root, "raw")
    rows = parsing.archive_rows(parsed)
    runner.drain(files.archive_stream(rows, path, os.path.join(root, "checkpoint")))
    return fx.plain(_with_readings(tables.lake(spark, path)))


@query
def stream_threshold_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream against exported thresholds; nothing waits for a window to close."""
    path = os.path.join(scratch_dir(spark, "thresholds"), "limits")
    jobs.export_thresholds(offline.daily_stats(_event_days(spark, sf_dir), until=LEARNED_UNTIL), path, k=2.0)
    limits = spark.read.parquet(path)
    rows = fx.sensor_rows(spark, sf_dir, True)
    scored = offline.score_against_thresholds(rows, limits)
    return fx.plain(runner.drained(scored, "limits"))


@query
def stream_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source, two independent queries: the archive and the sliding peaks."""
    root = scratch_dir(spark, "two")
    rows = fx.wide_rows(spark, sf_dir, True)
    archive, peaks = os.path.join(root, "raw"), os.path.join(root, "peaks")
    found = anomaly.sliding_peak_anomalies(rows, window=DAY, slide="6 hours", watermark=DELAY)
    runner.drain_all(
        [
            files.archive_stream(
                rows.withColumn("dt", F.to_date("event_ts")),
                archive,
                os.path.join(root, "checkpoint-raw"),
                "json",
            ),
            found.writeStream.format("parquet")
            .option("path", peaks)
            .option("checkpointLocation", os.path.join(root, "checkpoint-peaks")),
        ]
    )
    kept = spark.read.schema(
        "event_ts timestamp, device_id string, temperature double, humidity double, dt date"
    ).json(archive)
    raised = spark.read.schema(found.schema).parquet(peaks)
    columns = ("branch", "dt", "ts", "device_id", "temperature", "humidity", "score")
    none = F.lit(None).cast("double")
    both = kept.select(
        F.lit("archive").alias("branch"), "dt", F.col("event_ts").alias("ts"), "device_id", "temperature", "humidity",
        none.alias("score"),
    ).unionByName(
        raised.select(
            F.lit("peaks").alias("branch"), F.to_date("ts").alias("dt"), "ts", "device_id",
            F.col("value").alias("temperature"), none.alias("humidity"), "score",
        )
    )
    return fx.plain(both.select(*columns))


@query
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored stream into an anomaly table, topic records and line protocol."""
    root = scratch_dir(spark, "fanout")
    out = {name: os.path.join(root, name) for name in ("registry", "records", "metrics", "lines")}

    def found(batch: DataFrame) -> DataFrame:
        return anomaly.anomalies(batch).withColumn("score", F.round("score", 4))

    def failing(_: DataFrame, __: int) -> None:
        raise RuntimeError("unreachable broker")

    sinks = [
        Sink("registry", files.batch_writer(out["registry"]), anomaly.anomalies),
        Sink("broken", failing, required=False),
        Sink("off", failing, enabled=False),
        Sink(
            "records",
            files.batch_writer(out["records"]),
            lambda batch: messages.anomaly_messages(found(batch)),
        ),
        Sink("metrics", files.batch_writer(out["metrics"], "text"), messages.metric_lines),
        Sink(
            "lines",
            files.batch_writer(out["lines"], "text"),
            lambda batch: messages.anomaly_lines(found(batch)),
        ),
    ]
    scored = _daily_scores(spark, sf_dir, True)
    runner.drain(
        scored.writeStream.foreachBatch(fan_out(sinks)).option(
            "checkpointLocation", os.path.join(root, "checkpoint")
        )
    )
    stored = spark.read.parquet(out["registry"])
    delivered = stored.select(
        F.lit("registry").alias("sink"),
        F.concat_ws("|", "device_id", "metric", "severity", F.col("value").cast("string")).alias("value"),
    ).unionByName(spark.read.parquet(out["records"]).select(F.lit("records").alias("sink"), "value"))
    for name in ("metrics", "lines"):
        delivered = delivered.unionByName(spark.read.text(out[name]).select(F.lit(name).alias("sink"), "value"))
    return delivered


@query
def stream_ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.sensor_rows(spark, sf_dir, True)
    means = metrics.window_features(rows, "6 hours", watermark=DELAY)
    return fx.plain(runner.drained(stateful_ewma.ewma_scores(means), "ewma"))


# --- streams whose input arrives in parts ------------------------------------------

ARCHIVE_PARTS = ("offset % 3 = 0", "offset % 3 = 1", "offset % 3 = 2")
#: The second half of the month follows the first, and some rows of either come last.
LATE_PARTS = (
    "event_id % 50 <> 0 and ts < timestamp'2024-01-16'",
    "event_id % 50 <> 0 and ts >= timestamp'2024-01-16'",
    "event_id % 50 = 0",
)
#: Instants new thresholds hold from; each is learned from all days before it.
VERSIONS = ("2024-01-08", "2024-01-15", "2024-01-22")


def _streamed(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    return spark.readStream.schema(rows.schema).parquet(folder)


@query
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings scored by one stateful operator; those that come too late, with the reason."""
    root = scratch_dir(spark, "closing")
    folder, out = os.path.join(root, "in"), os.path.join(root, "out")
    rows = fx.numbered_rows(spark, sf_dir)
    write = after(lambda batch: closing.score_closed(batch, DAY), files.batch_writer(out))
    for _ in fx.arrivals(rows, folder, *LATE_PARTS):
        closed = closing.closed_windows(_streamed(spark, rows, folder), DAY, DELAY, salts=4)
        writer = closed.writeStream.foreachBatch(write)
        runner.drain(writer.option("checkpointLocation", os.path.join(root, "checkpoint")))
    return _flat_scores(spark.read.parquet(out).drop("batch_id"))


def _version(spark: SparkSession, sf_dir: str, path: str, valid_from: str) -> None:
    before = F.col("dt") < F.lit(valid_from).cast("date")
    jobs.publish_thresholds(offline.daily_stats(_event_days(spark, sf_dir).filter(before)), path, valid_from, k=2.0)


@query
def thresholds_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings against the version of the thresholds that was in force at their time."""
    path = os.path.join(scratch_dir(spark, "versions"), "limits")
    for valid_from in VERSIONS:
        _version(spark, sf_dir, path, valid_from)
    return fx.plain(offline.score_as_of(fx.sensor_rows(spark, sf_dir), jobs.threshold_versions(spark, path)))


@query
def stream_thresholds_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream against thresholds of which new versions are published while it runs."""
    root = scratch_dir(spark, "versions")
    path, folder, out = (os.path.join(root, name) for name in ("limits", "in", "out"))
    rows = fx.numbered_rows(spark, sf_dir)
    first, second = (f"ts < timestamp'{v}'" for v in VERSIONS[1:])
    parts = (first, f"not ({first}) and {second}", f"not ({second})")

    def score(batch: DataFrame) -> DataFrame:
        return offline.score_as_of(batch, jobs.threshold_versions(spark, path))

    for valid_from, part in zip(VERSIONS, parts, strict=True):
        _version(spark, sf_dir, path, valid_from)
        rows.filter(part).write.mode("append").parquet(folder)
        readings = _streamed(spark, rows, folder).drop("event_id")
        writer = readings.writeStream.foreachBatch(after(score, files.batch_writer(out)))
        runner.drain(writer.option("checkpointLocation", os.path.join(root, "checkpoint")))
    return fx.plain(spark.read.parquet(out).drop("batch_id"))


@query
def stream_delivery_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row once in every sink, though one sink fails at first and others only append."""
    root = scratch_dir(spark, "ledger")
    out = {name: os.path.join(root, name) for name in ("appended", "flaky", "published")}
    ledger = Ledger(spark, os.path.join(root, "checkpoint", "delivered"))
    failed: list[int] = []

    def appending(name: str) -> Callable[[DataFrame, int], None]:
        return lambda rows, _: rows.write.mode("append").parquet(out[name])

    def flaky(rows: DataFrame, batch_id: int) -> None:
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("the sink is away")
        appending("flaky")(rows, batch_id)

    def found(batch: DataFrame) -> DataFrame:
        return anomaly.anomalies(batch)

    sinks = [
        Sink("appended", appending("appended"), found),
        Sink("flaky", flaky, found),
        Sink("published", files.batch_writer(out["published"]), found),
    ]
    scored = _daily_scores(spark, sf_dir, True)
    writer = scored.writeStream.foreachBatch(fan_out(sinks, ledger))
    writer = writer.option("checkpointLocation", os.path.join(root, "checkpoint"))
    try:
        runner.drain(writer)
    except Exception as error:
        if "the sink is away" not in str(error):
            raise
    runner.drain(writer)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found(_daily_scores(spark, sf_dir)).schema)
    rows = {name: spark.read.schema(schema).parquet(out[name]) for name in ("appended", "flaky")}
    rows["published"] = ledger.published("published", out["published"], schema)
    value = F.concat_ws("|", "device_id", "metric", "severity", F.col("value").cast("string")).alias("value")
    parts = [df.select(F.lit(name).alias("sink"), value) for name, df in rows.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def incremental_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds from daily states that are brought up to date as days and late rows arrive."""
    root = scratch_dir(spark, "increments")
    raw, stats = os.path.join(root, "raw"), os.path.join(root, "stats")
    rows = fx.numbered_rows(spark, sf_dir).select(
        "event_id", "ts", F.to_date("ts").alias("dt"), "device_id", F.create_map("metric", "value").alias("metrics")
    )
    for part in LATE_PARTS:
        rows.filter(part).drop("event_id", "ts").write.mode("append").partitionBy("dt").parquet(raw)
        increments.refresh(tables.lake(spark, raw), raw, stats)
    return fx.plain(offline.thresholds(increments.daily(spark, stats), k=2.0), 4)


@query
def stream_compacted_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of several micro-batches after its small files were put together, and more came."""
    root = scratch_dir(spark, "compaction")
    folder, path = os.path.join(root, "in"), os.path.join(root, "raw")
    records = fx.message_records(spark, sf_dir)
    compacted = CompactedLake(spark, path, os.path.join(root, "compacted"))
    for part in ARCHIVE_PARTS:
        records.filter(part).write.mode("append").parquet(folder)
        rows = parsing.archive_rows(parsing.parse_messages(_streamed(spark, records, folder)))
        runner.drain(files.archive_stream(rows, path, os.path.join(root, "checkpoint")))
        if part != ARCHIVE_PARTS[-1]:
            compacted.compact()
    return fx.plain(_with_readings(compacted.read()))


@query
def series_range_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stretch of one series out of a lake that is laid out by device and time."""
    path = os.path.join(scratch_dir(spark, "layout"), "lake")
    layout.write_clustered(fx.sensor_rows(spark, sf_dir), path)
    until = F.lit(AS_OF).cast("timestamp")
    lake = layout.of_device(layout.between(spark.read.parquet(path), until - F.expr("interval 6 hours"), until), "dev-1")
    found = metrics.series_range(lake, AS_OF, "6 hours", metric="click", device_id="dev-1")
    return fx.plain(found.drop("dt", "device_bucket"))


@query
def stream_upserted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows in update mode over several micro-batches, newest version of each."""
    root = scratch_dir(spark, "upserts")
    folder = os.path.join(root, "in")
    rows = fx.numbered_rows(spark, sf_dir)
    keys = ("window_start", "window_end", "device_id", "metric", "location", "model")
    schema = ", ".join(f"{k} {'timestamp' if k.startswith('window') else 'string'}" for k in keys)
    table = upserts.KeyedTable(spark, os.path.join(root, "table"), f"{schema}, mean double, std double", keys)
    for number, _ in enumerate(fx.arrivals(rows, folder, "event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2")):
        # everything stays in time for its window
        stats = anomaly.window_stats(_streamed(spark, rows, folder), DAY, watermark="60 days")
        flat = stats.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys[2:], "mean", "std")
        writer = flat.writeStream.foreachBatch(table.writer())
        runner.drain(writer.option("checkpointLocation", os.path.join(root, "checkpoint")), "update")
        if number == 1:
            table.fold(up_to=number)
    return fx.plain(table.read())


@query
def stream_spooled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages out of a spool at a limited rate, restarted once, and their lines into another one."""
    root = scratch_dir(spark, "spool")
    inbox, out, checkpoint = (os.path.join(root, name) for name in ("inbox", "out", "checkpoint"))
    fx.message_records(spark, sf_dir).select(F.col("value").cast("string")).repartition(6).write.text(inbox)
    for _ in range(2):
        lines = messages.message_lines(jobs.parsed_messages(spool.spooled_lines(spark, inbox, files_per_batch=2).select("value")))
        running = runner.start(spool.deliver_stream(lines, out, checkpoint), every="0 seconds")
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    return spark.read.text(os.path.join(out, "batch=*"))
