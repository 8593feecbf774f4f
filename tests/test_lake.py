"""Upkeep of the lake: states by day, compaction, layout, keyed tables."""

import glob
import os
from datetime import date, timedelta

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import at
from tidegauge.operators import offline
from tidegauge.sinks import increments, layout, upserts
from tidegauge.sinks.compaction import CompactedLake
from tidegauge.sources import tables

MESSAGE = "ts string, device_id string, location string, model string, metrics map<string,double>, event_ts timestamp, dt date"


def messages(spark, rows):
    """(day, device, value) as archived messages; day None has no date."""
    first = date(2026, 1, 13)
    return spark.createDataFrame(
        [("t", d, "l", "m", {"t": float(v)}, at(1), None if day is None else first + timedelta(day)) for day, d, v in rows], MESSAGE
    )


def add(spark, path, rows):
    messages(spark, rows).repartition(2).write.mode("append").partitionBy("dt").parquet(path)


def stats(df):
    return {(r.dt, r.device_id): (r.n, round(r.mean, 9), r.stddev and round(r.stddev, 9)) for r in df.collect()}


def test_states_follow_new_and_late_rows(spark, tmp_path):
    path, root = str(tmp_path / "lake"), str(tmp_path / "states")
    steps = [
        [(0, "a", 1), (0, "a", 3), (1, "a", 5), (None, "a", 7)],
        [(2, "a", 8), (2, "b", 1e6)],
        [(0, "a", 100), (3, "c", 1), (None, "b", 2)],
    ]
    wanted = [{0, 1, None}, {2}, {0, 3, None}]
    for rows, days in zip(steps, wanted, strict=True):
        add(spark, path, rows)
        lake = tables.lake(spark, path)
        read = increments.refresh(lake, path, root)
        assert set(read) == {None if d is None else date(2026, 1, 13) + timedelta(d) for d in days}
        assert stats(increments.daily(spark, root)) == stats(offline.daily_stats(lake))
    assert increments.refresh(tables.lake(spark, path), path, root) == []
    merged = offline.thresholds(increments.daily(spark, root)).filter("device_id = 'a'").first()
    values = [1, 3, 5, 7, 8, 100]
    assert (merged.n, merged.mean) == (6, pytest.approx(np.mean(values)))
    assert merged.stddev == pytest.approx(np.std(values, ddof=1))


def test_only_touched_days_are_read(spark, tmp_path):
    path = str(tmp_path / "lake")
    add(spark, path, [(d, "a", d) for d in range(6)])
    rows = increments.touched_rows(tables.lake(spark, path), [date(2026, 1, 15), date(2026, 1, 16)])
    assert {os.path.basename(os.path.dirname(f)) for f in (r[0] for r in rows.select(F.input_file_name()).collect())} == {"dt=2026-01-15", "dt=2026-01-16"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dt" in plan


def test_a_run_that_ends_before_its_marks_is_repeated(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "lake"), str(tmp_path / "states")
    add(spark, path, [(0, "a", 1)])
    write = increments.day_files.overwrite_days

    def failing(rows, target, **options):
        if target.endswith("marks"):
            raise RuntimeError("lost")
        write(rows, target, **options)

    monkeypatch.setattr(increments.day_files, "overwrite_days", failing)
    with pytest.raises(RuntimeError):
        increments.refresh(tables.lake(spark, path), path, root)
    monkeypatch.undo()
    assert len(increments.refresh(tables.lake(spark, path), path, root)) == 1
    assert increments.daily(spark, root).count() == 1


def held(df):
    return sorted((str(r.dt), r.device_id, r.metrics["t"]) for r in df.collect())


def test_compaction_keeps_rows_and_leaves_few_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake = CompactedLake(spark, path, str(tmp_path / "store"))
    for batch in range(6):
        add(spark, path, [(d, f"d{batch}", i) for d in (0, 1, None) for i in range(4)])
    before = lake.live().groupBy("dt").count().collect()
    assert len(before) == 3 and all(r["count"] >= 6 for r in before)
    rows, reader = held(tables.lake(spark, path)), lake.read()
    assert lake.compact() > 0
    # whoever read before goes on reading the same files
    assert held(reader) == rows == held(lake.read())
    assert {r["count"] for r in lake.live().groupBy("dt").count().collect()} == {1}
    add(spark, path, [(0, "later", 1), (5, "later", 2)])
    both = sorted([*rows, ("2026-01-13", "later", 1.0), ("2026-01-18", "later", 2.0)])
    assert held(lake.read()) == both
    # a file made by a compaction is compacted again with what came later
    assert lake.compact() > 0 and held(lake.read()) == both
    assert lake.live().filter("dt = date'2026-01-13'").count() == 1
    assert lake.compact() == 0
    plan = lake.read().filter("dt = date'2026-01-13'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_bins_are_filled_up_to_the_target(spark, tmp_path):
    path = str(tmp_path / "lake")
    for batch in range(9):
        add(spark, path, [(0, f"d{batch}", i) for i in range(50)])
    lake = CompactedLake(spark, path, str(tmp_path / "store"))
    sizes = [r.length for r in lake.live().collect()]
    target = sum(sizes) // 3
    planned = lake.plan(target).groupBy("bin").agg(F.sum("length").alias("bytes"), F.count("*").alias("n")).collect()
    assert 3 <= len(planned) <= 4 and all(r.bytes <= target + max(sizes) and r.n > 1 for r in planned)
    large = lake.plan(min(sizes)).collect()
    assert large == []


def test_a_compaction_that_fails_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    lake = CompactedLake(spark, path, str(tmp_path / "store"))
    for batch in range(3):
        add(spark, path, [(0, f"d{batch}", 1)])
    rows = held(lake.read())
    listed = lake.live().count()
    monkeypatch.setattr(lake, "_changes", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        lake.compact()
    monkeypatch.undo()
    assert held(lake.read()) == rows and lake.live().count() == listed
    # half a snapshot: a folder without its mark
    os.makedirs(tmp_path / "store" / "snapshots" / "7")
    assert held(lake.read()) == rows


def test_a_range_of_one_device_reads_few_row_groups(spark, tmp_path, conf):
    conf("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "lake")
    n = 200_000
    rows = spark.range(0, n, 1, 4).selectExpr(
        "timestamp_micros(1768262400000000 + id * 1000000) as ts", "concat('d', id % 100) as device_id", "cast(id as double) as value"
    )
    layout.write_clustered(rows, path, row_group=16_384)
    until = F.lit("2026-01-14 18:00:00").cast("timestamp")
    since = until - F.expr("interval 1 hour")
    lake = layout.of_device(layout.between(spark.read.parquet(path), since, until), "d42")
    assert lake.count() == rows.filter((F.col("ts") >= since) & (F.col("ts") < until) & (F.col("device_id") == "d42")).count() > 0
    low, high, bucket = spark.range(1).select(since, until, layout.device_bucket(F.lit("d42"))).first()
    total = hit = 0
    for name in glob.glob(f"{path}/dt=*/*.parquet"):
        footer = pq.ParquetFile(name).metadata
        columns = {footer.schema.column(i).path: i for i in range(footer.num_columns)}
        for g in range(footer.num_row_groups):
            total += 1
            at_ts, at_bucket = (footer.row_group(g).column(columns[c]).statistics for c in ("ts", "device_bucket"))
            in_day = "dt=2026-01-14" in name
            hit += in_day and at_bucket.min <= bucket <= at_bucket.max and at_ts.min.replace(tzinfo=None) < high and at_ts.max.replace(tzinfo=None) >= low
    assert total >= 50 and hit <= total * 0.1
    plan = lake._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(device_bucket" in plan


def test_interleaved_bits_take_turns(spark):
    key = layout.interleaved(F.col("a"), F.col("b"), 3)
    found = {(r.a, r.b): r.k for r in spark.range(64).selectExpr("id div 8 as a", "id % 8 as b").withColumn("k", key).collect()}
    assert sorted(found.values()) == list(range(64))
    assert found[0b111, 0] == 0b101010 and found[0, 0b111] == 0b010101


def test_newest_batch_wins_and_folding_keeps_it(spark, tmp_path):
    table = upserts.KeyedTable(spark, str(tmp_path / "table"), "k string, j int, v double", ("k", "j"))
    assert table.read().count() == 0
    write = table.writer()

    def frame(rows):
        return spark.createDataFrame(rows, "k string, j int, v double")

    write(frame([("a", 1, 1.0), ("b", 1, 1.0), (None, None, 5.0)]), 0)
    write(frame([("a", 1, 2.0)]), 1)
    write(frame([("a", 1, 2.5)]), 1)
    write(frame([("c", 1, None), ("b", 1, None)]), 2)

    def rows():
        return sorted((tuple(r) for r in table.read().collect()), key=repr)

    wanted = sorted([("a", 1, 2.5), ("b", 1, None), ("c", 1, None), (None, None, 5.0)], key=repr)
    assert rows() == wanted
    table.fold(1)
    assert rows() == wanted
    assert table._versions().filter("batch_id <= 1").count() == 3
    table.fold(2)
    write(frame([("a", 1, 9.0)]), 3)
    assert ("a", 1, 9.0) in rows() and len(rows()) == 4
