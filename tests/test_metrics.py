import math

import pytest
from pyspark.sql import functions as F

from helpers import at, column, reading, readings
from tidegauge.functions.values import clamp, number_text, soil_percent
from tidegauge.operators import ewma, metrics


def test_points_do_not_depend_on_row_order(spark):
    rows = [reading(0, 1.0), reading(0, 3.0), reading(0, 2.0), reading(0, 7.0, metric="rpm"),
            reading(0, math.nan), reading(0, None, device="x"), reading(1, 5.0, location="")]
    points = {r["location"]: r for r in metrics.metric_points(readings(spark, rows)).collect()}
    assert {place: p["metrics"] for place, p in points.items()} == {
        "l": {"rpm": 7.0, "temperature": 3.0}, "unknown": {"temperature": 5.0},
    }


def test_explode_and_regroup(spark):
    rows = [reading(m, float(m), metric=n) for m in range(3) for n in ("a", "b")]
    points = metrics.metric_points(readings(spark, rows))
    again = metrics.explode_metrics(points).select("ts", "metric", "value")
    expected = readings(spark, rows).select("ts", "metric", "value")
    assert sorted(again.collect()) == sorted(expected.collect())


def test_window_features(spark):
    rows = [reading(0, 5.0), reading(0.25, 9.0), reading(0.5, 2.0), reading(0.5, 3.0)]
    (row,) = metrics.window_features(readings(spark, rows)).collect()
    assert (row["n"], row["min"], row["max"], row["delta"]) == (4, 2.0, 9.0, -2.0)
    assert row["rate"] == pytest.approx(-2.0 / 30)
    (single,) = metrics.window_features(readings(spark, [reading(0, 5.0)])).collect()
    assert single["delta"] == 0.0 and single["rate"] is None


def test_downsample(spark):
    rows = [reading(m, float(m)) for m in range(10)]
    got = metrics.downsample(readings(spark, rows), "5 minutes").orderBy("ts")
    assert [(r["value"], r["n"]) for r in got.collect()] == [(2.0, 5), (7.0, 5)]


def test_series_range_is_half_open(spark):
    rows = [reading(m, float(m)) for m in (0, 1, 15, 16)]
    got = metrics.series_range(readings(spark, rows), "2026-01-13 00:16:00")
    assert sorted(column(got, "value")) == [1.0, 15.0]
    assert metrics.series_range(
        readings(spark, rows), "2026-01-13 00:16:00", metric="rpm"
    ).count() == 0


def test_metric_pattern_is_unanchored(spark):
    rows = [reading(0, 1.0, metric=m) for m in ("temperature_c", "soil_moisture", "rpm")]
    got = metrics.metrics_matching(readings(spark, rows), "temperature|humidity|soil_moisture")
    assert sorted(column(got, "metric")) == ["soil_moisture", "temperature_c"]


def test_nan_readings_go_and_nulls_stay(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (math.nan, 1.0), (1.0, math.nan), (None, 1.0)],
        "temperature double, humidity double",
    )
    assert metrics.drop_nan_readings(df).count() == 2


def test_clamp_leaves_null(spark):
    df = spark.createDataFrame([(v,) for v in (130.0, -5.0, 40.0, None)], "v double")
    assert column(df.select(clamp(F.col("v"), 0.0, 100.0).alias("c")), "c") == [
        100.0, 0.0, 40.0, None,
    ]


def test_soil_percent(spark):
    df = spark.createDataFrame([(v,) for v in (3500, 2500, 1500, 4000, 1000, 3481)], "v int")
    assert column(df.select(soil_percent(F.col("v")).alias("p")), "p") == [0, 50, 100, 0, 100, 0]


def test_number_text(spark):
    numbers = [0.0005, 12345678.9, 1e15, 1500.0, -0.00012345, 1e16, 60.5, 0.0, 1.5e7]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    got = column(df.select(number_text(F.col("v")).alias("t")), "t")
    assert got[:5] == [repr(v) for v in numbers[:5]]
    assert [float(t) for t in got] == numbers


def test_ewma_matches_the_plain_recurrence(spark):
    values = [float(v * v % 23) for v in range(200)]
    rows = [(at(20 * i), "d", "t", v) for i, v in enumerate(values)]
    rows += [(at(20 * i), "e", "t", 5.0) for i in range(3)]
    df = spark.createDataFrame(
        rows, "window_start timestamp, device_id string, metric string, mean double"
    )
    got = ewma.ewma_scores(df, alpha=0.2).orderBy("device_id", "window_start").collect()
    average, variance, expected = None, 0.0, []
    for x in values:
        distance = None if average is None else x - average
        score = None if distance is None else distance / max(math.sqrt(variance), 0.05)
        average = x if average is None else 0.2 * x + 0.8 * average
        variance = 0.8 * (variance + 0.2 * (distance or 0.0) ** 2)
        expected.append((average, score))
    assert [r["ewma"] for r in got[:200]] == pytest.approx([e for e, _ in expected])
    assert got[0]["score"] is None
    assert [r["score"] for r in got[1:200]] == pytest.approx([s for _, s in expected[1:]])
    assert got[200]["score"] is None
    assert [r["score"] for r in got[201:]] == pytest.approx([0.0, 0.0], abs=1e-9)


def test_change_takes_the_smallest_first_and_the_largest_last(spark):
    values = {
        "ties": [(0, 5.0), (0, 3.0), (0.5, 9.0), (0.5, 11.0), (0.5, -2.0)],
        "large": [(0, 1e17), (0, -1e17), (0.5, 1e15), (0.5, 1.0000001e15)],
        "tiny": [(0, 1e-9), (0, -1e-9), (0.5, 2e-9)],
        "endless": [(0, float("-inf")), (0, 1.0), (0.5, 2.0), (0.5, float("inf"))],
    }
    rows = [reading(m, v, device=d) for d, of in values.items() for m, v in of]
    got = {r["device_id"]: r["delta"] for r in metrics.window_features(readings(spark, rows)).collect()}
    assert got == {"ties": 8.0, "large": 1.0000001e15 + 1e17, "tiny": pytest.approx(3e-9), "endless": float("inf")}
