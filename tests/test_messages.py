import json
import re

from helpers import at, column, reading, readings, texts
from tidegauge.operators import alerts, messages

ANOMALY = (
    "ts timestamp, device_id string, location string, model string, metric string, value double, "
    "score double, method string, severity string"
)


def test_metric_line(spark):
    rows = [
        reading(0, v, "zone1-motor-001", m, "zone1-production-floor", "Motor-A")
        for m, v in (("motor_current_a", 6.012), ("rpm", 1500.0), ("temperature_c", 60.5))
    ]
    assert column(messages.metric_lines(readings(spark, rows)), "value") == [
        "sensor_metrics,device_id=zone1-motor-001,location=zone1-production-floor,model=Motor-A "
        "motor_current_a=6.012,rpm=1500.0,temperature_c=60.5 1768262400000000000"
    ]


def test_tags_are_escaped_and_never_empty(spark):
    rows = [reading(0, 1.0, device="a b,c=d\\e", location="", model=None)]
    (line,) = column(messages.metric_lines(readings(spark, rows)), "value")
    assert line.startswith(
        "sensor_metrics,device_id=a\\ b\\,c\\=d\\\\e,location=unknown,model=unknown temperature=1.0 "
    )


def test_anomaly_line_leaves_out_what_cannot_be_written(spark):
    df = spark.createDataFrame(
        [
            (at(), "d", "l", "m", "t", 1.5, float("nan"), "zscore", "high"),
            (at(), "d", "l", "m", "t", None, float("inf"), "zscore", "high"),
            (None, "d", "l", "m", "t", 1.0, 2.0, "zscore", "high"),
        ],
        ANOMALY,
    )
    assert column(messages.anomaly_lines(df), "value") == [
        "sensor_anomalies,device_id=d,location=l,model=m,metric=t,severity=high value=1.5 "
        "1768262400000000000"
    ]


def test_anomaly_message(spark):
    df = spark.createDataFrame(
        [(at(), "d", None, "m", "t", 1.5, 9.25, "zscore", "critical")], ANOMALY
    )
    (row,) = messages.anomaly_messages(df).collect()
    assert row["key"] is None
    assert json.loads(row["value"]) == {
        "ts": "2026-01-13 00:00:00", "device_id": "d", "model": "m", "metric": "t",
        "value": 1.5, "score": 9.25, "severity": "critical", "is_anomaly": 1,
    }


ALERTS = [
    # message, alerts with only_flagged, alerts without
    ('{"score":2.1,"is_anomaly":1}', True, False),
    ('{"score":9,"is_anomaly":0}', False, True),
    ('{"score":-3.5}', True, True),
    ('{"is_anomaly":1}', False, False),
    ('{"score":"abc"}', False, False),
    ('{"anomaly":{"score":4,"is_anomaly":1}}', True, True),
    ('{"score":NaN}', False, False),
    ('{"score":5,"anomaly":{"score":1,"is_anomaly":0}}', True, True),
    ("[1]", False, False),
    ("text", False, False),
]


def test_alert_rules(spark):
    # the time of each message names it
    bodies = [b.replace("{", '{"ts":"%d",' % i, 1) for i, (b, *_) in enumerate(ALERTS)]
    events = alerts.read_events(texts(spark, bodies))
    for wanted, only_flagged in ((1, True), (2, False)):
        alerted = column(alerts.alerting(events, only_flagged=only_flagged), "ts")
        assert alerted == [str(i) for i, row in enumerate(ALERTS) if row[wanted]]


def test_alert_text(spark):
    bodies = [
        '{"ts":"t1","device_id":"d","metric":"m","score":4,"is_anomaly":1}',
        '{"event_ts":"t2","device_id":"","deviceId":"x","anomaly":{"score":3.5,"metric":"n"}}',
        '{"score":3.25}',
    ]
    lines = column(alerts.alert_lines(alerts.read_events(texts(spark, bodies))), "value")
    assert lines == [
        "[ANOMALY ALERT] ts=t1 device_id=d metric=m score=4.0 flag=1",
        "[ANOMALY ALERT] ts=t2 device_id=x metric=n score=3.5 flag=None",
        "[ANOMALY ALERT] ts=unknown-ts device_id=unknown-device metric=unknown-metric "
        "score=3.25 flag=None",
    ]


def test_inspection(spark):
    df = spark.createDataFrame(
        [(b"k", b'{"a":1}', "t", 1, 7, at(0.5)), (None, b"\xff\xfeab", "t", 0, 9, at()),
         (b"k", b"x", "t", 0, 8, at())],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    got = messages.inspect_messages(df, 2).collect()
    assert [(r["partition"], r["offset"], r["key"]) for r in got] == [(0, 8, "k"), (0, 9, None)]
    assert got[1]["value"] == "��ab"
    assert got[0]["kafka_ts"] == "2026-01-13T00:00:00.000000+00:00"
    assert messages.inspect_messages(df, 0).count() == 3
    newest = messages.inspect_messages(df, 2, newest=True).collect()
    assert [(r["partition"], r["offset"]) for r in newest] == [(1, 7), (0, 9)]


def test_far_future_timestamps_do_not_fail(spark):
    df = texts(spark, ["9999-12-31T00:00:00Z"]).selectExpr(
        "cast(value as timestamp) as ts", "'d' as device_id", "'l' as location", "'m' as model",
        "'t' as metric", "1.0D as value",
    )
    (line,) = column(messages.metric_lines(df), "value")
    assert line.endswith(" t=1.0 253402214400000000000")


def test_odd_json_is_still_read(spark):
    bodies = [
        '{"ts":"nan","score":NaN,"is_anomaly":1}', '{"ts":"inf","score": -Infinity}', '{"ts":"twice","score":1,"score":9}',
        "{'ts':'single','score':9}", '{"ts":"null","score":null,"anomaly":{"score":9}}', '{"ts":"cut","score":9',
    ]
    alerted = column(alerts.alerting(alerts.read_events(texts(spark, bodies))), "ts")
    assert alerted == ["nan", "inf", "twice", "null"]
    plan = alerts.read_events(texts(spark, bodies))._jdf.queryExecution().executedPlan().toString()
    # once as it is, and once more only where that fails
    assert "from_json" not in plan and len(re.findall("(?i)parsejson", plan)) == 2
