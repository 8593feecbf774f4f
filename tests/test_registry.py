from datetime import date

import pytest

from helpers import at, column
from tidegauge import schemas
from tidegauge.operators import registry
from tidegauge.sinks import files
from tidegauge.sources import tables

FOUND = "ts timestamp, device_id string, metric string, value double, score double, method string, severity string"


def found(spark, *rows):
    return spark.createDataFrame([(t, d, "t", v, 3.0, "zscore", "low") for t, d, v in rows], FOUND)


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([("a", "old")], "device_id string, model string")
    incoming = spark.createDataFrame(
        [("a", "new", 1), ("b", "second", 3), ("b", "first", 2), (None, "none", 4)],
        "device_id string, model string, position int",
    )
    got = registry.insert_if_absent(existing, incoming, "device_id", "position")
    assert [tuple(r) for r in got.collect()] == [("b", "first")]


def test_a_key_without_positions_keeps_a_row(spark):
    existing = spark.createDataFrame([], "device_id string, model string")
    incoming = spark.createDataFrame(
        [("a", "unplaced", None), ("b", "unplaced", None), ("b", "placed", 7)],
        "device_id string, model string, position int",
    )
    got = registry.insert_if_absent(existing, incoming, "device_id", "position")
    assert sorted(tuple(r) for r in got.collect()) == [("a", "unplaced"), ("b", "placed")]


def test_orphans_and_valid_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("x", 2), ("x", 3), (None, 4)], "device_id string, v int")
    parents = spark.createDataFrame([("a",), ("b",)], "device_id string")
    assert sorted(column(registry.orphan_rows(rows, parents, "device_id"), "v")) == [2, 3, 4]
    assert column(registry.valid_references(rows, parents, "device_id"), "v") == [1]
    report = registry.orphan_report(rows, parents, "device_id").collect()
    assert {(r["device_id"], r["n"]) for r in report} == {("x", 2), (None, 1)}


def test_latest_and_top_are_deterministic(spark):
    df = found(spark, (at(0), "b", 1.0), (at(0), "a", 2.0), (at(0), "a", 1.0), (at(1), "c", 1.0))
    got = registry.latest_anomalies(df, 3)
    assert [(r["device_id"], r["value"]) for r in got.collect()] == [("c", 1.0), ("a", 1.0), ("a", 2.0)]
    top = registry.top_devices(df, "2026-01-13 00:01:00", n=2).collect()
    assert [(r["device_id"], r["n"]) for r in top] == [("a", 2), ("b", 1)]


def test_counts_by_attribute_include_unknown_devices(spark):
    df = found(spark, (at(0), "a", 1.0), (at(0), "a", 1.0), (at(0), "b", 1.0), (at(0), "x", 1.0))
    known = spark.createDataFrame([("a", "M"), ("b", "M")], "device_id string, model string")
    got = registry.anomalies_by(df, known, "model").collect()
    assert {(r["model"], r["n"]) for r in got} == {("M", 3), (None, 1)}


def test_before_and_after_maintenance(spark):
    days = [date(2026, 1, d) for d in (7, 8, 12, 13, 17, 18)]
    df = spark.createDataFrame([(str(d), "a") for d in days], "ts string, device_id string")
    df = df.selectExpr("cast(ts as timestamp) as ts", "device_id")
    plan = spark.createDataFrame(
        [(1, "a", date(2026, 1, 13)), (2, "a", date(2026, 1, 8)), (3, "b", date(2026, 1, 8))],
        "schedule_id int, device_id string, last_maintained date",
    )
    got = registry.before_after_maintenance(df, plan, days=5).collect()
    assert {(r["schedule_id"], r["n_before"], r["n_after"]) for r in got} == {
        (1, 2, 2), (2, 1, 2), (3, 0, 0),
    }


def test_declared_against_observed(spark):
    devices = spark.createDataFrame([("a", "t, h"), ("b", " t ,t")], "device_id string, metrics string")
    rows = spark.createDataFrame(
        [("a", "t"), ("a", "t"), ("a", "q"), ("b", "t")], "device_id string, metric string"
    )
    got = registry.declared_vs_observed(devices, rows).collect()
    assert {(r["device_id"], r["metric"], r["n"], r["status"]) for r in got} == {
        ("a", "t", 2, "ok"), ("a", "h", 0, "silent"), ("a", "q", 1, "undeclared"), ("b", "t", 1, "ok"),
    }


def test_registry_tables(spark, tmp_path):
    root = str(tmp_path)
    files.recreate_registry(spark, root)
    assert tables.registry_table(spark, "zones", root).count() == 0
    zones = spark.createDataFrame(
        [(1, "zone1", "Production Floor", "REST"), (2, "zone2", "Storage Area", "MQTT")],
        schemas.ZONES,
    )
    files.append_table(zones, "zones", root)
    files.append_table(found(spark, (at(0), "a", 1.0)), "anomalies", root)
    files.append_table(found(spark, (at(1), "a", 1.0)), "anomalies", root)
    stored = tables.registry_table(spark, "anomalies", root)
    assert stored.count() == 2 and set(column(stored, "id")) == {None}
    files.clear_table(spark, "anomalies", root)
    assert tables.registry_table(spark, "anomalies", root).count() == 0
    assert tables.registry_table(spark, "zones", root).count() == 2
    devices = spark.createDataFrame([("d1", "zone2"), ("d2", "zone9")], "device_id string, zone_code string")
    looked = registry.lookup(devices, tables.registry_table(spark, "zones", root), "zone_code", "zone_id")
    assert {r["device_id"]: r["zone_id"] for r in looked.collect()} == {"d1": 2, "d2": None}


def test_first_rows_by_time_and_of_equal_rows_one(spark):
    rows = spark.createDataFrame(
        [("a", at(2), "x"), ("a", at(1), "y"), ("a", at(1), "y"), ("b", None, "z"), ("b", None, "z"), ("c", at(-9e6), "old"), ("c", at(0), "new")],
        "device_id string, ts timestamp, model string",
    )
    got = registry.first_per_key(rows, "device_id", "ts")
    assert got.columns == rows.columns
    assert sorted((r["device_id"], r["model"]) for r in got.collect()) == [("a", "y"), ("b", "z"), ("c", "old")]
    with pytest.raises(TypeError):
        registry.first_per_key(rows, "device_id", "model")


def test_rows_of_one_position_give_one_row_whatever_their_order(spark):
    rows = [("a", f"m{i}", -5) for i in range(20)]
    frames = [spark.createDataFrame(r, "k string, m string, p long") for r in (rows, rows[::-1])]
    first, second = (registry.first_per_key(df, "k", "p").collect() for df in frames)
    assert first == second and len(first) == 1
