import json

import pytest

from helpers import at, column
from tidegauge.operators import anomaly, messages
from tidegauge.plans import jobs
from tidegauge.settings import MissingSetting
from tidegauge.sinks import files
from tidegauge.sources import tables, topics
from tidegauge.streaming import runner
from tidegauge.streaming.fanout import Sink


def one_file(path):
    def send(text):
        with open(path, "a") as f:
            f.write(text + "\n")

    return send


@pytest.fixture
def raw(spark, tmp_path):
    """Messages of two metrics over ten minutes, with one outlier and one bad record."""
    folder = tmp_path / "topic"
    folder.mkdir()
    bodies = [
        json.dumps({"ts": at(i / 100).isoformat(), "device_id": "d", "location": "l", "model": "m",
                    "metrics": {"t": 500.0 if i == 7 else 20.0, "h": 50.0}})
        for i in range(100)
    ]
    later = {"ts": at(10).isoformat(), "device_id": "d", "metrics": {"t": 1}}
    # only readings with complete keys move the watermark of the statistics
    complete = {**later, "ts": at(9).isoformat(), "location": "l", "model": "m"}
    bodies += ["broken", json.dumps(later), json.dumps(complete)]
    (folder / "0.txt").write_text("\n".join(bodies))
    return topics.file_stream(spark, str(folder), "value string", "text")


def test_archive_then_offline(spark, raw, tmp_path):
    path, stats = str(tmp_path / "lake"), str(tmp_path / "stats")
    runner.drain(jobs.archive(raw, path, str(tmp_path / "checkpoint")))
    lake = tables.lake(spark, path)
    assert lake.count() == 102
    jobs.offline_statistics(lake, stats)
    jobs.offline_statistics(lake, stats, since="2026-01-13")
    got = {r["metric"]: r["n"] for r in spark.read.parquet(stats).collect()}
    assert got == {"t": 102, "h": 100}


def test_speed(spark, raw, tmp_path):
    out = str(tmp_path / "found")
    sinks = [Sink("records", files.batch_writer(out),
                  lambda b: messages.anomaly_messages(anomaly.anomalies(b)))]
    runner.drain(jobs.speed(raw, sinks, str(tmp_path / "checkpoint")))
    (body,) = column(spark.read.parquet(out), "value")
    assert json.loads(body)["metric"] == "t" and json.loads(body)["value"] == 500.0


def test_alerts(spark, tmp_path):
    folder = tmp_path / "anomalies"
    folder.mkdir()
    (folder / "0.txt").write_text('{"ts":"t","device_id":"d","metric":"m","score":4,"is_anomaly":1}\n{}')
    found = topics.file_stream(spark, str(folder), "value string", "text")
    lines = runner.drained(jobs.alert_rows(found), "alerts")
    assert column(lines, "value") == [
        "[ANOMALY ALERT] ts=t device_id=d metric=m score=4.0 flag=1"
    ]


def test_live_metrics_do_not_wait(raw, tmp_path):
    target = str(tmp_path / "lines")
    runner.drain(jobs.live_metrics(raw, one_file(target), str(tmp_path / "checkpoint")))
    with open(target) as f:
        lines = f.read().splitlines()
    assert len(lines) == 102
    assert "sensor_metrics,device_id=d,location=unknown,model=unknown t=1.0" in "\n".join(lines)


def test_sinks_follow_their_switches():
    off = {"WRITE_TO_POSTGRES": "false", "WRITE_TO_KAFKA": "false", "WRITE_TO_INFLUX": "false"}
    broker = jobs.settings.BrokerSettings()
    assert jobs.speed_sinks(off, 2.0, broker) == []
    (topic,) = jobs.speed_sinks({**off, "WRITE_TO_KAFKA": "true"}, 2.0, broker)
    assert topic.name == "topic" and not topic.required
    with pytest.raises(MissingSetting):
        jobs.speed_sinks({}, 2.0, broker)
    series = {"INFLUX_URL": "http://h", "INFLUX_ORG": "o", "INFLUX_BUCKET": "b", "INFLUX_TOKEN": "t"}
    both = jobs.speed_sinks({**off, **series, "WRITE_TO_INFLUX": "true"}, 2.0, broker)
    assert [(s.name, s.required) for s in both] == [("metrics", True), ("anomalies", True)]


def test_unknown_job(capsys):
    assert jobs.main(["nothing"]) == 2
    assert "archive|speed" in capsys.readouterr().err


def test_every_alert_of_a_batch_is_delivered(spark, tmp_path):
    folder = tmp_path / "anomalies"
    folder.mkdir()
    bodies = [json.dumps({"ts": f"t{i}", "device_id": "d", "metric": "m", "score": 9.5, "is_anomaly": 1}) for i in range(50)]
    (folder / "0.txt").write_text("\n".join(bodies))
    found = topics.file_stream(spark, str(folder), "value string", "text")
    path = str(tmp_path / "alerts")
    runner.drain(files.text_stream(jobs.alert_rows(found), path, str(tmp_path / "checkpoint")))
    lines = column(spark.read.text(path), "value")
    assert sorted(lines) == sorted(f"[ANOMALY ALERT] ts=t{i} device_id=d metric=m score=9.5 flag=1" for i in range(50))


def test_ingest_parts_bodies(spark, tmp_path):
    folder = tmp_path / "bodies"
    folder.mkdir()
    bodies = ['{"device_id":"d","metrics":{"t":1.5}}', '{"metrics":{"t":1}}', '{"device_id":"e","metrics":{"t":"x"}}']
    (folder / "0.txt").write_text("\n".join(bodies))
    stream = topics.file_stream(spark, str(folder), "value string", "text").selectExpr(
        "value", "timestamp'2026-01-13 00:00:00' as received_at"
    )
    raw, refused = str(tmp_path / "raw"), str(tmp_path / "refused")
    runner.drain(jobs.ingest(stream, files.batch_writer(raw), files.batch_writer(refused), str(tmp_path / "checkpoint")))
    (record,) = spark.read.parquet(raw).collect()
    assert record["key"] == "d" and json.loads(record["value"])["metrics"] == {"t": 1.5}
    left = spark.read.parquet(refused)
    assert {(r["device_id"], r["reason"]) for r in left.collect()} == {(None, "missing device_id"), ("e", "invalid number")}


def test_topic_options_follow_the_deployment():
    from tidegauge.settings import BrokerSettings

    assert topics.topic_options(BrokerSettings.from_env({}), "t")["failOnDataLoss"] == "true"
    assert topics.topic_options(BrokerSettings.from_env({"FAIL_ON_DATA_LOSS": "false"}), "t")["failOnDataLoss"] == "false"
    assert BrokerSettings.from_env({}).max_offsets_per_trigger is None
    assert BrokerSettings.from_env({"MAX_OFFSETS_PER_TRIGGER": "5"}).max_offsets_per_trigger == 5


def test_alerts_need_a_destination(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(jobs.topics, "topic_stream", lambda *_: topics.file_stream(spark, str(tmp_path), "value string", "text"))
    with pytest.raises(MissingSetting, match="ALERT_PATH"):
        jobs.run("alerts", spark, {"CHECKPOINT_DIR": str(tmp_path / "checkpoint")})
