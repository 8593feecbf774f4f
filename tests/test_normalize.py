import json

import pytest

from helpers import at, texts
from tidegauge.operators import messages, normalize

RECEIVED = "2026-01-13T00:00:00.000000+00:00"


def rest(spark, *bodies):
    df = texts(spark, [json.dumps(b) if isinstance(b, dict) else b for b in bodies])
    stamped = spark.createDataFrame([(at(),)], "received_at timestamp")
    return normalize.read_rest_payloads(df.join(stamped))


def mqtt(spark, topic, payload):
    df = spark.createDataFrame(
        [(at(), topic, payload.encode())], "received_at timestamp, topic string, payload binary"
    )
    (row,) = normalize.normalize_mqtt(df).collect()
    return row


@pytest.mark.parametrize(
    "body,metrics",
    [
        ({"metrics": {"temperature": 1, "x": 3}, "temperature": 2}, {"temperature": 2, "x": 3}),
        ({"humidity": 130}, {"humidity": 100}),
        ({"metrics": {"soil_moisture": -5}}, {"soil_moisture": 0}),
        ({"humidity": None, "metrics": {"humidity": 40}}, {"humidity": 40}),
        ({"temperature": 28.2, "humidity": 65.0, "soil_moisture": 40.5},
         {"temperature": 28.2, "humidity": 65.0, "soil_moisture": 40.5}),
        ({"metrics": {"a": "2.5"}}, {"a": 2.5}),
    ],
)
def test_rest_metrics(spark, body, metrics):
    (row,) = normalize.normalize_rest(rest(spark, {"device_id": "d", **body})).collect()
    assert row["metrics"] == metrics and row["source"] == "ingress-rest-api"


def test_rest_defaults_replace_missing_and_empty_text(spark):
    body = {"device_id": "d", "location": "", "ts": "", "temperature": 1}
    (row,) = normalize.normalize_rest(rest(spark, body)).collect()
    assert (row["location"], row["model"], row["ts"]) == ("farm-zone-1", "ESP32", RECEIVED)


@pytest.mark.parametrize(
    "body,reason",
    [
        ({"device_id": "d"}, "no metrics"),
        ({"device_id": "d", "metrics": {}, "temperature": None}, "no metrics"),
        ({"temperature": 1}, "missing device_id"),
        ({"device_id": "d", "metrics": {"a": "x", "b": 1}}, "invalid number"),
        ({"device_id": "d", "metrics": {"a": None}}, "invalid number"),
        ({"device_id": "d", "temperature": "warm"}, "invalid number"),
        ("not json", "missing device_id"),
    ],
)
def test_rest_rejections(spark, body, reason):
    payloads = rest(spark, body)
    assert normalize.normalize_rest(payloads).count() == 0
    assert [r["reason"] for r in normalize.rejected_rest(payloads).collect()] == [reason]


def test_typed_payloads_need_no_reading(spark):
    schema = (
        "received_at timestamp, device_id string, ts string, location string, model string, "
        "metrics map<string,double>, temperature double, humidity double, soil_moisture double"
    )
    df = spark.createDataFrame([(at(), "d", None, None, None, None, 1.0, None, None)], schema)
    (row,) = normalize.normalize_rest(df).collect()
    assert row["metrics"] == {"temperature": 1.0}


def test_mqtt_payload_device_wins_over_topic(spark):
    body = '{"device_id":"esp32-002","temperature":24.2,"humidity":152,"soil_moisture":"31"}'
    row = mqtt(spark, "iot/esp32-001/telemetry", body)
    assert row["device_id"] == "esp32-002" and row["ts"] == RECEIVED
    assert row["metrics"] == {"temperature": 24.2, "humidity": 100.0, "soil_moisture": 31.0}
    assert (row["source"], row["topic"]) == ("ingress-mqtt", "iot/esp32-001/telemetry")


@pytest.mark.parametrize(
    "topic,payload,device,raw",
    [
        ("iot", " hello\n", "mqtt-device", "hello"),
        ("iot/n1", "[1]", "n1", "[1]"),
        ("iot/n1/x", '{"device_id":"","raw":"r"}', "n1", "r"),
        ("iot/n1/x", '{"a":1', "n1", '{"a":1'),
        ("iot/n1/x", '{"a":1} tail', "n1", '{"a":1} tail'),
        ("iot/n1/x", '{"a":1}', "n1", None),
        ("iot//x", "", "", ""),
    ],
)
def test_mqtt_without_metrics(spark, topic, payload, device, raw):
    row = mqtt(spark, topic, payload)
    assert (row["device_id"], row["metrics"], row["raw"]) == (device, {}, raw)


def test_mqtt_skips_entries_that_are_no_numbers(spark):
    row = mqtt(spark, "iot", '{"metrics":{"a":"x","b":"2","c":[1]},"temperature":"warm"}')
    assert row["metrics"] == {"b": 2.0}


def test_mqtt_record_on_the_wire(spark):
    df = spark.createDataFrame(
        [(at(), "iot", b"hello"), (at(), "iot/d", b'{"temperature":1}')],
        "received_at timestamp, topic string, payload binary",
    )
    wire = messages.sensor_records(normalize.normalize_mqtt(df))
    rows = {r["key"]: json.loads(r["value"])["metrics"] for r in wire.collect()}
    assert rows == {"mqtt-device": {"raw": "hello"}, "d": {"temperature": 1.0}}


def test_board_requests(spark):
    paths = ["/27.5/60.2/33/1/0", "/27.5/60.2/33/1", "/x/60.2/33/1/0", "/1/2/3.5/1/0", "/1/2/3/4/5/6",
             "/1/2/3//0"]
    df = spark.createDataFrame([(at(), p) for p in paths], "received_at timestamp, path string")
    (row,) = normalize.normalize_board(df).collect()
    assert (row["temperature"], row["humidity"], row["soil_moisture"]) == (27.5, 60.2, 33)
    assert row["device1"].asDict() == {"name": "pump", "state": "ON"}
    assert row["device2"].asDict() == {"name": "fan", "state": "OFF"}
    assert (row["type"], row["timestamp"]) == ("iot_event", 1768262400.0)
