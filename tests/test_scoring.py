import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import at, column, reading, readings
from tidegauge.functions.scores import severity
from tidegauge.operators import anomaly


def scored(spark, rows, **options):
    return anomaly.score_rows(readings(spark, rows), **options)


def test_statistics_of_a_minute(spark):
    rows = scored(spark, [reading(0.1 * i, v) for i, v in enumerate((1.0, 2.0, 9.0, 100.0))])
    assert set(column(rows, "mean")) == {28.0}
    assert column(rows, "std") == pytest.approx([41.68333000133266] * 4)


def test_typed_in_readings(spark):
    rows = [reading(i / 60, v) for i, v in enumerate((45.0, 46.0, 47.0))]
    rows += [reading(i / 60, 70.0, metric="humidity") for i in range(3)]
    by_metric = {r["metric"]: r for r in scored(spark, rows).collect()}
    assert by_metric["temperature"]["mean"] == 46.0
    assert by_metric["temperature"]["std"] == pytest.approx(0.816496580927726)
    assert by_metric["humidity"]["std"] == 0.0 and by_metric["humidity"]["zscore"] == 0.0


def test_far_reading_is_critical(spark):
    rows = [reading(i / 200, 0.0) for i in range(100)] + [reading(0.9, 100.0)]
    (found,) = anomaly.anomalies(scored(spark, rows)).collect()
    assert found["severity"] == "critical" and found["method"] == "zscore"
    assert found["score"] == pytest.approx(10.0)


def test_null_keys_never_match(spark):
    rows = [reading(i / 100, float(i == 50) * 100, model=None) for i in range(51)]
    result = scored(spark, rows)
    assert result.count() == 51
    assert set(column(result, "zscore")) == {None}
    assert anomaly.anomalies(result).count() == 0


def test_nan_policies(spark):
    rows = [reading(0.1, math.nan), reading(0.2, 1.0), reading(0.3, 2.0)]
    dropped = scored(spark, rows)
    assert dropped.count() == 2 and set(column(dropped, "mean")) == {1.5}
    kept = anomaly.anomalies(scored(spark, rows, nan_policy="propagate"))
    assert column(kept, "severity") == ["critical"] * 3
    with pytest.raises(ValueError):
        scored(spark, rows, nan_policy="ignore")


def test_null_values_stay_unscored(spark):
    result = scored(spark, [reading(0.1, None), reading(0.2, 5.0)])
    assert {r["value"]: r["zscore"] for r in result.collect()} == {None: None, 5.0: 0.0}


def test_severity_bands(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 2.9, 3.0, 5.0, 7.9, 8.0)], "z double")
    labels = column(df.select(severity(F.col("z")).alias("s")), "s")
    assert labels == ["low", "low", "low", "medium", "high", "high", "critical"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_scores_are_bounded_by_group_size(spark, values):
    result = scored(spark, [reading(i / 100, v) for i, v in enumerate(values)])
    limit = math.sqrt(max(len(values) - 1, 0))
    assert all(abs(z) <= limit + 1e-6 for z in column(result, "zscore"))


def test_window_rule(spark):
    df = spark.createDataFrame(
        [(at(0.1), "hot", 41.0, 1.0), (at(0.1), "wild", 10.0, 1.0), (at(0.2), "wild", 30.0, 1.0),
         (at(0.1), "calm", 20.0, None)],
        "event_ts timestamp, device_id string, temperature double, humidity double",
    )
    found = anomaly.window_rule_anomalies(anomaly.wide_window_stats(df)).collect()
    assert {r["device_id"] for r in found} == {"hot", "wild"}
    assert all(r["is_anomaly"] for r in found)
    assert (found[0]["window_end"] - found[0]["window_start"]).seconds == 60


def test_sliding_peak_uses_sample_deviation(spark):
    values = [10.0] * 29 + [40.0]
    df = spark.createDataFrame(
        [(at(0.001 * i), "d", v) for i, v in enumerate(values)],
        "event_ts timestamp, device_id string, temperature double",
    )
    found = anomaly.sliding_peak_anomalies(df).collect()
    mean = sum(values) / 30
    std = math.sqrt(sum((v - mean) ** 2 for v in values) / 29)
    assert len(found) == 6
    assert {round(r["score"], 9) for r in found} == {round((40 - mean) / std, 9)}
    assert {(r["severity"], r["method"]) for r in found} == {("high", "zscore_window_1m")}


def test_single_reading_has_no_peak(spark):
    df = spark.createDataFrame(
        [(at(0), "d", 1.0)], "event_ts timestamp, device_id string, temperature double"
    )
    assert anomaly.sliding_peak_anomalies(df, min_score=0.0).count() == 0
