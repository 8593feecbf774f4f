"""Row types of the sensor data model, as DDL text."""

# One telemetry message. Metrics stay in a map, so a device may report a new
# metric without any schema change.
SENSOR_MESSAGE = (
    "ts string, device_id string, location string, model string, metrics map<string,double>"
)
# Same message with metric values still as text, for entry-by-entry conversion.
SENSOR_MESSAGE_TEXT = SENSOR_MESSAGE.replace("map<string,double>", "map<string,string>")

# A message as archived: the text ts is kept, dt is the partition column.
ARCHIVED_MESSAGE = SENSOR_MESSAGE + ", event_ts timestamp, dt date"

# One reading per row ("long" form).
METRIC_ROW = (
    "ts timestamp, device_id string, location string, model string, metric string, value double"
)

DAILY_STATS = "device_id string, metric string, n bigint, mean double, stddev double, dt date"

# Bounds of a series from an instant on, until the next version.
THRESHOLDS = (
    "device_id string, metric string, n bigint, mean double, stddev double, lower double, upper double, "
    "valid_from timestamp"
)

# Anomaly message as published, plus the alternative spellings alert readers accept.
ALERT_EVENT = (
    "ts string, event_ts string, device_id string, deviceId string, metric string, "
    "score string, is_anomaly string, "
    "anomaly struct<score: string, is_anomaly: string, metric: string>"
)

REST_PAYLOAD = (
    "device_id string, ts string, location string, model string, metrics map<string,string>, "
    "temperature string, humidity string, soil_moisture string"
)
MQTT_PAYLOAD = REST_PAYLOAD + ", raw string"

KAFKA_RECORD = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

# Registry tables.
ZONES = "zone_id int, zone_code string, zone_name string, protocol string"
DEVICES = (
    "device_id string, zone_id int, model string, sensor_type string, "
    "metrics string, base_values string"
)
MAINTENANCE = (
    "schedule_id int, device_id string, last_maintained date, next_maintained date, "
    "maint_type string, notes string"
)
ANOMALIES = (
    "id bigint, ts timestamp, device_id string, metric string, value double, score double, "
    "method string, severity string"
)
REGISTRY = {
    "zones": ZONES,
    "devices": DEVICES,
    "maintain_schedules": MAINTENANCE,
    "anomalies": ANOMALIES,
}
# Children before parents, so tables can be dropped in this order.
REGISTRY_DROP_ORDER = ("anomalies", "maintain_schedules", "devices", "zones")

# Tags that identify a series; with the metric name they are the scoring key.
TAGS = ("device_id", "location", "model")
SCORING_KEYS = ("device_id", "metric", "location", "model")
