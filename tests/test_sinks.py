import os
import uuid
from datetime import date

import pytest

from helpers import column, texts
from tidegauge import settings
from tidegauge.session import scratch_dir
from tidegauge.sinks import files, records, timeseries
from tidegauge.sources import tables, topics


def one_file_per_request(folder):
    def send(text):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(text)

    return send


def refusing():
    def send(_):
        raise RuntimeError("status 400")

    return send


def test_delivery_in_requests(spark, tmp_path):
    lines = texts(spark, [f"m,a=b v={i} {i}" for i in range(25)]).coalesce(1)
    assert timeseries.deliver_lines(lines, one_file_per_request(str(tmp_path)), lines_per_request=10) == 25
    requests = [f.read_text().split("\n") for f in tmp_path.iterdir()]
    assert sorted(len(r) for r in requests) == [5, 10, 10]
    assert len({line for r in requests for line in r}) == 25


def test_delivery_of_nothing_and_refusal(spark, tmp_path):
    none = texts(spark, ["x"]).filter("false")
    assert timeseries.deliver_lines(none, one_file_per_request(str(tmp_path))) == 0
    with pytest.raises(Exception, match="status 400"):
        timeseries.deliver_lines(texts(spark, ["x"]), refusing())


def test_http_target():
    target = settings.TimeSeriesSettings("http://db:8086/", "o", "b", "secret")
    transport = timeseries.HttpTransport.of(target)
    assert transport.url == "http://db:8086/api/v2/write?org=o&bucket=b&precision=ns"
    assert "secret" not in repr(transport) and "secret" not in repr(target)


STATS = "dt date, device_id string, n int"


def test_overwriting_days(spark, tmp_path):
    path = str(tmp_path / "stats")
    first = spark.createDataFrame([(date(2026, 1, 1), "a", 1), (date(2026, 1, 2), "a", 1)], STATS)
    second = spark.createDataFrame([(date(2026, 1, 2), "a", 2)], STATS)
    files.overwrite_days(first, path)
    files.overwrite_days(second, path, only_given_days=True)
    kept = spark.read.parquet(path)
    assert sorted(column(kept, "n")) == [1, 2]
    files.overwrite_days(second, path)
    assert column(spark.read.parquet(path), "n") == [2]


def test_append_json(spark, tmp_path):
    path = str(tmp_path / "raw")
    files.append_json(texts(spark, ["a"]), path)
    files.append_json(texts(spark, ["b"]), path)
    assert sorted(column(spark.read.json(path), "value")) == ["a", "b"]


def test_connector_options():
    broker = settings.BrokerSettings.from_env({"KAFKA_TOPIC": "t", "KAFKA_BOOTSTRAP": "b:1"})
    assert (broker.raw_topic, broker.anomaly_topic) == ("t", "iot.sensor.anomaly")
    assert topics.topic_options(broker, broker.raw_topic) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    jdbc = settings.JdbcSettings.from_env(
        {"PG_URL": "jdbc:postgresql://h/db", "PG_USER": "u", "PG_PASSWORD": "p"}
    )
    assert tables.jdbc_options(jdbc)["dbtable"] == "anomalies"
    assert "'p'" not in repr(jdbc)


def test_connectors_absent_here_fail_clearly(spark):
    broker = settings.BrokerSettings()
    with pytest.raises(Exception, match="kafka"):
        topics.topic_stream(spark, broker, broker.raw_topic)
    with pytest.raises(Exception, match="kafka"):
        records.publish(texts(spark, ["x"]), broker, "t")


def test_credentials_have_no_default():
    with pytest.raises(settings.MissingSetting):
        settings.JdbcSettings.from_env({"PG_URL": "x", "PG_USER": "u"})
    with pytest.raises(settings.MissingSetting):
        settings.TimeSeriesSettings.from_env({"INFLUX_URL": "x"})


def test_checkpoint_location():
    look = settings.checkpoint_location
    assert look("job", {"JOB_CHECKPOINT_DIR": "s3a://x", "CHECKPOINT_DIR": "/c"}) == "s3a://x"
    assert look("job", {"CHECKPOINT_DIR": "/c", "CHECKPOINT_BASE_DIR": "/b"}) == "/c/job"
    assert look("job", {"CHECKPOINT_BASE_DIR": "/b"}) == "/b/job"
    with pytest.raises(settings.MissingSetting):
        look("job", {})


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings, self.conf = settings, self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_scratch_folders_follow_the_session():
    shared = Session(**{"spark.checkpoint.dir": "/shared/checkpoints"})
    one, two = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert one.startswith("/shared/checkpoints/x-") and one != two
    alone = Session(**{"spark.sql.warehouse.dir": "/shared/warehouse"})
    one, two = scratch_dir(alone, "x"), scratch_dir(alone, "x")
    assert one.startswith("/shared/warehouse/tidegauge-scratch/x-") and one != two
