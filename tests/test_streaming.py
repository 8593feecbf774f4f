import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import at, column, reading, readings
from tidegauge import schemas
from tidegauge.operators import anomaly, messages, metrics, parsing
from tidegauge.sinks import files
from tidegauge.sources import tables, topics
from tidegauge.streaming import runner
from tidegauge.streaming.fanout import Sink, fan_out


def feed(spark, folder, batches):
    """One file per micro-batch, oldest first."""
    os.makedirs(folder)
    for i, rows in enumerate(batches):
        name = os.path.join(folder, f"{i:03d}.json")
        with open(name, "w") as f:
            for ts, device, location, model, metric, value in rows:
                f.write(json.dumps({"ts": ts.isoformat(), "device_id": device, "location": location,
                                    "model": model, "metric": metric, "value": value}) + "\n")
        os.utime(name, (1_000_000 + i, 1_000_000 + i))
    return topics.file_stream(spark, folder, schemas.METRIC_ROW, "json", files_per_trigger=1)


def run(rows, tmp_path, mode="append"):
    """Rows with the number of the micro-batch that gave them."""
    seen = []

    def keep(batch, batch_id):
        seen.extend((batch_id, r) for r in batch.collect())

    writer = rows.writeStream.foreachBatch(keep)
    runner.drain(writer.option("checkpointLocation", str(tmp_path / "checkpoint")), mode)
    return seen


def test_scores_appear_when_the_window_closes(spark, tmp_path):
    batches = [
        [reading(1 / 60, 1.0), reading(2 / 60, 3.0)], [reading(5, 10.0)], [reading(5 + 1 / 60, 20.0)],
        [reading(5 + 2 / 60, 30.0)], [reading(0.5, 100.0)], [reading(9, 7.0)],
    ]
    rows = feed(spark, str(tmp_path / "in"), batches)
    seen = run(anomaly.score_rows(rows, watermark="2 minutes"), tmp_path)
    means = {r["value"]: r["mean"] for _, r in seen}
    # the late reading comes out unscored, the reading of the open window not at all
    assert means == {1.0: 2.0, 3.0: 2.0, 100.0: None, 10.0: 20.0, 20.0: 20.0, 30.0: 20.0}
    closed_in = {r["value"]: batch for batch, r in seen}
    assert closed_in[1.0] == closed_in[3.0] < closed_in[100.0] < closed_in[10.0]


def test_a_row_of_the_window_closed_last_is_still_counted(spark, tmp_path):
    batches = [[reading(1 / 60, 1.0)], [reading(5, 10.0)], [reading(0.5, 3.0)], [reading(9, 7.0)]]
    rows = feed(spark, str(tmp_path / "in"), batches)
    seen = run(anomaly.score_rows(rows, watermark="2 minutes"), tmp_path)
    assert {r["value"]: r["mean"] for _, r in seen} == {1.0: 2.0, 3.0: 2.0, 10.0: 10.0}


def test_scoring_a_stream_needs_a_watermark(spark, tmp_path):
    rows = feed(spark, str(tmp_path / "in"), [[reading(0, 1.0)]])
    with pytest.raises(ValueError):
        anomaly.score_rows(rows)


def test_update_mode_gives_windows_before_they_close(spark, tmp_path):
    rows = feed(spark, str(tmp_path / "in"), [[reading(0, 1.0)], [reading(0.5, 3.0)]])
    stats = anomaly.window_stats(rows, watermark="2 minutes")
    assert [(b, r["mean"]) for b, r in run(stats, tmp_path, "update")] == [(0, 1.0), (1, 2.0)]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = feed(spark, folder, [[reading(0.1, 1.0), reading(0.2, 3.0)]])
    scored = anomaly.score_rows(rows, watermark="2 minutes")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        writer = scored.writeStream.format("parquet").option("path", out)
        runner.drain(writer.option("checkpointLocation", checkpoint))
        return spark.read.schema(scored.schema).parquet(out)

    assert go().count() == 0
    with open(os.path.join(folder, "001.json"), "w") as f:
        f.write(json.dumps({"ts": at(9).isoformat(), "device_id": "d", "location": "l", "model": "m",
                            "metric": "temperature", "value": 7.0}) + "\n")
    assert sorted(column(go(), "mean")) == [2.0, 2.0]
    assert go().count() == 2


def test_archive_keeps_days_and_is_not_doubled(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    bodies = [
        '{"ts":"2026-01-13T00:00:00Z","device_id":"a","metrics":{"t":1.0}}',
        '{"ts":"2026-01-14T00:00:00Z","device_id":"a"}', '{"ts":"bad","device_id":"b"}', "junk",
    ]
    (folder / "0.txt").write_text("\n".join(bodies))
    raw = topics.file_stream(spark, str(folder), "value string", "text")
    rows = parsing.archive_rows(parsing.parse_messages(raw))
    path = str(tmp_path / "lake")
    for _ in range(2):
        runner.drain(files.archive_stream(rows, path, str(tmp_path / "checkpoint")))
    kept = tables.lake(spark, path)
    assert sorted(str(d) for d in column(kept, "dt")) == ["2026-01-13", "2026-01-14", "None"]
    plan = kept.filter("dt = date'2026-01-13'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_fan_out(spark, tmp_path):
    calls = []

    def failing(_, __):
        calls.append("failing")
        raise RuntimeError("down")

    batch = readings(spark, [reading(0.01 * i, 0.0) for i in range(99)] + [reading(0.999, 9.0)])
    scored = anomaly.score_rows(batch)
    records, lines = str(tmp_path / "records"), str(tmp_path / "lines")
    sinks = [
        Sink("broken", failing, required=False),
        Sink("off", failing, enabled=False),
        Sink("records", files.batch_writer(records, "json"),
             lambda b: messages.anomaly_messages(anomaly.anomalies(b))),
        Sink("lines", files.batch_writer(lines, "text"), messages.metric_lines),
    ]
    write = fan_out(sinks)
    write(scored, 5)
    write(scored, 5)  # a repeated batch replaces its files
    assert calls == ["failing", "failing"]
    assert spark.read.json(records).count() == 1
    assert spark.read.text(lines).count() == 100
    write(scored.limit(0), 6)
    assert len(calls) == 2
    assert fan_out([])(scored, 6) is None
    with pytest.raises(RuntimeError):
        fan_out([Sink("needed", failing)])(scored, 7)


def test_console_prints_every_line(spark, tmp_path, capsys):
    rows = feed(spark, str(tmp_path / "in"), [[reading(0, float(i)) for i in range(50)]])
    lines = rows.select(F.concat(F.lit("line "), F.col("value").cast("int")).alias("value"))
    query = runner.start(files.console_stream(lines, str(tmp_path / "checkpoint")), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert sorted(capsys.readouterr().out.split("\n")) == sorted(["", *(f"line {i}" for i in range(50))])


def test_downsample_and_features_stream(spark, tmp_path):
    batches = [[reading(0, 1.0), reading(0.5, 4.0)], [reading(30, 1.0)]]
    rows = feed(spark, str(tmp_path / "in"), batches)
    got = run(metrics.downsample(rows, "5 minutes", watermark="2 minutes"), tmp_path)
    assert [(r["value"], r["n"]) for _, r in got] == [(2.5, 2)]


def test_hot_key_on_a_stream_is_spread(spark, tmp_path):
    rows = feed(spark, str(tmp_path / "in"), [[reading(0.001 * i, float(i)) for i in range(300)],
                                              [reading(30, 1.0)]])
    scored = anomaly.score_rows(rows, watermark="2 minutes", salts=8)
    spread = scored.withColumn("part", F.spark_partition_id())
    seen = run(spread, tmp_path)
    assert len(seen) == 300 and len({r["part"] for _, r in seen}) > 1
    assert {r["mean"] for _, r in seen} == {149.5}
