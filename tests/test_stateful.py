"""Windows scored when they close, versions as of a time, deliveries made once, spools."""

import bisect
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, reading, readings
from test_scale import final_plan, skewed_rows
from test_streaming import feed, run
from tidegauge import schemas
from tidegauge.operators import anomaly, asof, offline
from tidegauge.plans import jobs
from tidegauge.sinks import files
from tidegauge.sources import spool, topics
from tidegauge.streaming import closing, runner
from tidegauge.streaming.fanout import Ledger, Sink, after, fan_out


def test_scores_equal_the_batch_and_late_rows_have_a_reason(spark, tmp_path):
    batches = [
        [reading(1 / 60, 1.0), reading(2 / 60, 3.0), reading(0.2, 5.0, model=None)], [reading(5, 10.0)], [reading(5 + 1 / 60, 20.0)],
        [reading(5 + 2 / 60, 30.0), reading(0.4, None)], [reading(0.5, 100.0)], [reading(9, 7.0)],
    ]
    rows = feed(spark, str(tmp_path / "in"), batches)
    out = str(tmp_path / "out")
    writer = closing.closed_windows(rows, salts=3).writeStream.foreachBatch(
        after(closing.score_closed, files.batch_writer(out))
    )
    runner.drain(writer.option("checkpointLocation", str(tmp_path / "checkpoint")))
    got = {(r.ts, r.value): (r.mean, r.zscore, r.reason) for r in spark.read.parquet(out).collect()}
    in_time = [r for b in batches for r in b if r not in (batches[0][2], batches[3][1], batches[4][0], batches[5][0])]
    wanted = {(r.ts, r.value): (r.mean, r.zscore, None) for r in anomaly.score_rows(readings(spark, in_time)).collect()}
    incomplete = (None, None, closing.INCOMPLETE)
    late = (None, None, closing.LATE)
    plain = {(k[0].replace(tzinfo=None), k[1]): v for k, v in got.items()}
    naive = lambda minutes: at(minutes).replace(tzinfo=None)
    assert plain.pop((naive(0.2), 5.0)) == incomplete
    assert plain.pop((naive(0.5), 100.0)) == late and plain.pop((naive(0.4), None)) == late
    assert plain == wanted


def test_a_hot_window_waits_under_several_state_keys(spark, tmp_path):
    hot = [reading(0.001 * i, float(i)) for i in range(300)]
    rows = feed(spark, str(tmp_path / "in"), [hot, [reading(30, 1.0)]])
    held = closing.closed_windows(rows, salts=8).withColumn("part", F.spark_partition_id())
    seen = run(held, tmp_path)
    assert len(seen) == 300 and len({r.part for _, r in seen}) > 1
    # whatever the salt, a window comes out in one micro-batch
    assert len({batch for batch, _ in seen}) == 1


def test_windows_are_of_whole_milliseconds(spark, tmp_path):
    rows = feed(spark, str(tmp_path / "in"), [[reading(0, 1.0)]])
    with pytest.raises(ValueError):
        closing.closed_windows(rows, "1500 microseconds")


def brute_as_of(rows, versions):
    found = []
    for key, t, name in rows:
        of = sorted(((v, limit) for k, v, limit in versions if k == key and k is not None and v is not None))
        i = bisect.bisect_right([v for v, _ in of], t) if t is not None else 0
        # of versions of one instant the largest
        found.append((key, t, name, of[i - 1][1] if i else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block", ["10 minutes", "1 day"])
def test_versions_as_of_a_time_equal_a_search(spark, block):
    draw = random.Random(3)
    keys = ["a", "b", "c", None]
    rows = [(draw.choice(keys), at(draw.randrange(600) / 4).replace(tzinfo=None), f"r{i}") for i in range(300)] + [("a", None, "no time")]
    versions = [(draw.choice(keys[:2] + [None]), at(draw.randrange(30, 140)).replace(tzinfo=None), float(i)) for i in range(40)]
    versions += [("a", at(50).replace(tzinfo=None), 1000.0), ("a", at(50).replace(tzinfo=None), 2000.0), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, name string")
    limits = spark.createDataFrame(versions, "k string, valid_from timestamp, upper double")
    got = asof.as_of(df, limits, ("k",), block=block)
    assert got.columns == ["k", "ts", "name", "valid_from", "upper"]
    assert sorted(((r.k, r.ts, r.name, r.upper) for r in got.collect()), key=repr) == brute_as_of(rows, versions)
    assert asof.as_of(df, limits.limit(0), ("k",)).filter("upper is not null").count() == 0
    assert asof.as_of(df.limit(0), limits, ("k",)).count() == 0


def test_a_hot_series_spans_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = skewed_rows(spark, 30_000).withColumn("ts", F.timestamp_seconds(F.col("value") * 1e6))
    limits = spark.createDataFrame([("hot", "t", at(-60 * 24 * 365 * 60), 0.0, 1.0, -3.0, 3.0)],
                                   "device_id string, metric string, valid_from timestamp, mean double, stddev double, lower double, upper double")
    found = offline.score_as_of(rows, limits).select("device_id", "mean", F.spark_partition_id().alias("task"))
    hot = [r for r in found.collect() if r.device_id == "hot"]
    assert len(hot) == 10_000 and len({r.task for r in hot}) > 1
    assert "NestedLoop" not in final_plan(found)


def test_limits_job_takes_versions_published_while_it_runs(spark, tmp_path):
    path, out = str(tmp_path / "limits"), str(tmp_path / "out")
    days = [("2026-01-0%d" % (d + 1), "d", "t", 10, 10.0 * (d + 1), 1.0) for d in range(2)]
    daily = spark.createDataFrame(days, "dt string, device_id string, metric string, n bigint, mean double, stddev double")
    folder = tmp_path / "topic"
    folder.mkdir()

    def step(number, day, minute):
        jobs.publish_thresholds(daily.filter(F.col("dt") == day), path, f"{at(minute):%Y-%m-%d %H:%M:%S}")
        body = f'{{"ts":"{at(minute + 1).isoformat()}","device_id":"d","location":"l","model":"m","metrics":{{"t":11.0}}}}'
        (folder / f"{number}.txt").write_text(body)
        raw = topics.file_stream(spark, str(folder), "value string", "text")
        sinks = [Sink("found", files.batch_writer(out))]
        runner.drain(jobs.speed_against_thresholds(raw, path, sinks, str(tmp_path / "checkpoint")))

    step(0, "2026-01-01", 0)
    step(1, "2026-01-02", 10)
    assert sorted((r.mean, r.zscore) for r in spark.read.parquet(out).collect()) == [(10.0, 1.0), (20.0, -9.0)]
    assert jobs.threshold_versions(spark, path).count() == 2


def test_a_sink_that_fails_once_gets_its_rows_and_others_do_not_get_them_twice(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "marks"))
    calls = []

    def sink(name, failures=0):
        left = [failures]

        def write(rows, batch_id):
            if left[0]:
                left[0] -= 1
                raise RuntimeError(name)
            calls.append((name, batch_id, rows.count()))

        return write

    optional = Sink("optional", sink("optional", 1), required=False)
    write = fan_out([Sink("first", sink("first")), Sink("flaky", sink("flaky", 1)), optional, Sink("last", sink("last"))], ledger)
    batch = readings(spark, [reading(0, 1.0), reading(1, 2.0)])
    with pytest.raises(RuntimeError, match="flaky"):
        write(batch, 4)
    assert calls == [("first", 4, 2), ("last", 4, 2)]
    write(batch, 4)
    assert calls[2:] == [("flaky", 4, 2), ("optional", 4, 2)]
    write(batch, 4)
    assert len(calls) == 4
    write(batch, 5)
    assert ledger.batches("first") == [4, 5] and ledger.batches("unknown") == []


def test_an_unmarked_batch_is_not_published(spark, tmp_path):
    ledger, path = Ledger(spark, str(tmp_path / "marks")), str(tmp_path / "out")
    write = files.batch_writer(path)
    batch = readings(spark, [reading(0, 1.0)])
    assert ledger.published("s", path, schemas.METRIC_ROW).count() == 0
    write(batch, 0)
    ledger.mark("s", 0)
    write(batch, 1)
    assert ledger.published("s", path, schemas.METRIC_ROW).count() == 1


def spooled(spark, inbox, out, checkpoint, limit=2):
    lines = spool.spooled_lines(spark, inbox, limit).select(F.upper("value").alias("value"))
    running = runner.start(spool.deliver_stream(lines, out, checkpoint), every="0 seconds")
    try:
        running.processAllAvailable()
        return [p["numInputRows"] for p in running.recentProgress if p["numInputRows"]]
    finally:
        running.stop()


def test_a_spool_is_read_at_its_rate_and_goes_on_after_a_restart(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    os.makedirs(inbox)

    def put(names):
        for n in names:
            with open(os.path.join(inbox, f"{n:03d}.txt"), "w") as f:
                f.write("".join(f"line {n} {i}\n" for i in range(3)))

    put(range(5))
    read = spooled(spark, inbox, out, checkpoint)
    assert max(read) <= 2 and sum(read) == 5
    put(range(5, 8))
    assert sum(spooled(spark, inbox, out, checkpoint)) == 3
    lines = [r.value for r in spark.read.text(os.path.join(out, "batch=*")).collect()]
    assert sorted(lines) == sorted(f"LINE {n} {i}" for n in range(8) for i in range(3))
    assert not os.listdir(os.path.join(out, "_staging"))


def test_lines_of_an_aborted_batch_are_removed_and_a_repeated_one_replaces(tmp_path):
    writer = spool.LineWriter(str(tmp_path))
    staged = writer.write(iter([("a",), ("b",)]))
    writer.abort([staged, None], 0)
    assert os.listdir(tmp_path / "_staging") == [] and not (tmp_path / "batch=0").exists()
    for _ in range(2):
        writer.commit([writer.write(iter([("a",), ("b",)])), writer.write(iter([]))], 0)
    (name,) = os.listdir(tmp_path / "batch=0")
    assert (tmp_path / "batch=0" / name).read_text() == "a\nb\n"
