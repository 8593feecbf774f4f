import pytest
from pyspark.sql import functions as F

from helpers import column, texts
from tidegauge.functions.times import parse_ts
from tidegauge.operators import parsing
from tidegauge.operators.metrics import explode_metrics

LITERALS = [
    # body, strict metrics, lenient metrics
    ('{"device_id":"d","metrics":{"b":1,"raw":"x"}}', None, {"b": 1.0}),
    ('{"device_id":"d","metrics":{"a":"2.5"}}', None, {"a": 2.5}),
    ('{"device_id":"d","metrics":{"a":true}}', None, {}),
    ('{"device_id":"d","metrics":{"a":null}}', {"a": None}, {}),
    ('{"device_id":"d","metrics":{"a":1,"a":2}}', {"a": 2.0}, {"a": 2.0}),
    ('{"device_id":"d","metrics":[1]}', None, None),
    ('{"device_id":5,"metrics":{}}', {}, {}),
    ('{"device_id":"d","metrics":{"a":1}} trailing', {"a": 1.0}, {"a": 1.0}),
    ('{"device_id":"d","metrics":{"a":" 4 ","b":{"c":1},"e":"1d"}}', None, {"a": 4.0}),
    ("not json", None, None),
    ("[1]", None, None),
    ("", None, None),
    ('{"device_id":"d","metrics":{"a":1', None, None),
]


@pytest.mark.parametrize("mode,wanted", [("strict", 1), ("lenient", 2)])
def test_metric_maps(spark, mode, wanted):
    rows = texts(spark, [body for body, *_ in LITERALS])
    assert column(parsing.parse_messages(rows, mode=mode), "metrics") == [
        row[wanted] for row in LITERALS
    ]


def test_strict_keeps_nan_and_lenient_loses_the_bare_one(spark):
    rows = texts(spark, ['{"metrics":{"a":NaN}}'])
    (strict,) = column(parsing.parse_messages(rows), "metrics")
    assert strict["a"] != strict["a"]
    assert column(parsing.parse_messages(rows, mode="lenient"), "metrics") == [{}]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parsing.parse_messages(texts(spark, ["{}"]), mode="loose")


def test_unreadable_messages_are_rows_of_nulls(spark):
    (row,) = parsing.parse_messages(texts(spark, ["not json"])).collect()
    assert set(row.asDict().values()) == {None}


def test_timestamps(spark):
    shown = {
        "2026-01-13T00:00:00Z": "2026-01-13 00:00:00",
        "2026-01-13T00:00:00.123456+00:00": "2026-01-13 00:00:00.123456",
        "2026-01-13T07:00:00+07:00": "2026-01-13 00:00:00",
        "2026-01-13T00:00:00.123456789Z": "2026-01-13 00:00:00.123456",
        "2026-01-13": "2026-01-13 00:00:00",
        "bad": None,
        "": None,
        "1736726400": None,
    }
    df = texts(spark, list(shown)).select(parse_ts(F.col("value")).cast("string").alias("ts"))
    assert column(df, "ts") == list(shown.values())


def test_validity_and_archive_keep_different_rows(spark):
    bodies = [
        '{"ts":"2026-01-13T00:00:00Z","device_id":"sim-001","metrics":{"temperature":42.5}}',
        '{"ts":"bad","device_id":"sim-001","metrics":{"temperature":1}}',
        '{"ts":"2026-01-13T00:00:00Z","device_id":"sim-001","temperature":120.0}',
        '{"ts":"2026-01-13T00:00:00Z","metrics":{"temperature":1}}',
    ]
    parsed = parsing.parse_messages(texts(spark, bodies))
    assert parsing.valid_messages(parsed).count() == 1
    archived = parsing.archive_rows(parsed).collect()
    assert [str(r["dt"]) for r in archived] == ["2026-01-13", "None", "2026-01-13"]
    assert archived[1]["ts"] == "bad" and archived[2]["metrics"] is None


def test_explode_skips_messages_without_metrics(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1.0, "b": None}), (2, {}), (3, None)], "id int, metrics map<string,double>"
    )
    assert explode_metrics(df, carry=("id",)).count() == 2
    assert explode_metrics(df, carry=("id",), drop_null_values=True).count() == 1


def test_metric_columns(spark):
    df = spark.createDataFrame([({"temperature": 1.0},)], "metrics map<string,double>")
    (row,) = parsing.metric_columns(df, ("temperature", "humidity")).collect()
    assert row.asDict() == {"temperature": 1.0, "humidity": None}
