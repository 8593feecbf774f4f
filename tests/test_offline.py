import random
import statistics
from datetime import date, timedelta

import pytest

from helpers import readings, reading
from tidegauge.operators import offline

LAKE = "dt date, device_id string, metrics map<string,double>"


def lake(spark, rows):
    return spark.createDataFrame(rows, LAKE)


def test_daily_stats(spark):
    day = date(2026, 1, 13)
    rows = [(day, "d", {"t": 1.0}), (day, "d", {"t": 3.0, "h": 5.0}), (day, "d", {"t": None}),
            (day, "d", None)]
    got = {r["metric"]: r for r in offline.daily_stats(lake(spark, rows)).collect()}
    assert (got["t"]["n"], got["t"]["mean"]) == (2, 2.0)
    assert got["t"]["stddev"] == pytest.approx(statistics.stdev([1, 3]))
    assert got["h"]["n"] == 1 and got["h"]["stddev"] is None


def test_day_range_is_inclusive(spark):
    rows = [(date(2026, 1, d), "d", {"t": 1.0}) for d in range(1, 11)]
    assert offline.daily_stats(lake(spark, rows), "2026-01-03", "2026-01-05").count() == 3


def test_gathered_statistics_equal_those_aggregated_where_they_are_read(spark, conf):
    conf("spark.sql.shuffle.partitions", "3")
    rng = random.Random(8)
    rows = [(None, "d0", {"t": 1.0}), (None, "d0", {"t": 3.0}), (date(2026, 1, 1), None, {"t": 2.0, "h": None}),
            (date(2026, 1, 1), "d0", None), (date(2026, 1, 1), "d0", {}), (date(2026, 1, 1), "d0", {"n": float("nan")})]
    for _ in range(400):
        day = date(2026, 1, 1) + timedelta(days=rng.randrange(70))
        rows += 2 * [(day, f"d{rng.randrange(4)}", {"t": rng.gauss(1e6, 1), "h": float(rng.randrange(3))})]
    table = lake(spark, rows)

    def found(df):
        return sorted(tuple("" if v is None else f"{v:.5f}" if isinstance(v, float) else str(v) for v in r)
                      for r in df.collect())

    plain = offline.daily_stats(table)
    for unit in ("week", "month"):
        gathered = offline.daily_stats(table, gather=unit)
        assert gathered.schema.simpleString() == plain.schema.simpleString()
        assert found(gathered) == found(plain)
        assert found(offline.trend(gathered, unit)) == found(offline.trend(plain, unit))
        assert found(offline.thresholds(gathered)) == found(offline.thresholds(plain))
    some = offline.daily_stats(table, "2026-01-03", "2026-02-05", gather="month")
    assert found(some) == found(offline.daily_stats(table, "2026-01-03", "2026-02-05"))


def test_thresholds_equal_statistics_over_all_days(spark):
    rng = random.Random(5)
    rows, values = [], []
    for d in range(12):
        for _ in range(d + 1):
            values.append(1e6 + rng.gauss(0, 1))
            rows.append((date(2026, 1, 1) + timedelta(days=d), "d", {"t": values[-1]}))
    (row,) = offline.thresholds(offline.daily_stats(lake(spark, rows)), k=2.0).collect()
    assert row["n"] == len(values)
    assert row["mean"] == pytest.approx(statistics.mean(values), rel=1e-12)
    assert row["stddev"] == pytest.approx(statistics.stdev(values), rel=1e-6)
    assert row["upper"] - row["lower"] == pytest.approx(4 * row["stddev"])


def test_trend_weeks_start_on_monday(spark):
    rows = [(date(2026, 1, 11), "d", {"t": 1.0}), (date(2026, 1, 12), "d", {"t": 2.0}),
            (date(2026, 1, 13), "d", {"t": 4.0})]
    got = offline.trend(offline.daily_stats(lake(spark, rows)), "week").orderBy("period")
    assert [(str(r["period"]), r["n"], r["mean"]) for r in got.collect()] == [
        ("2026-01-05", 1, 1.0), ("2026-01-12", 2, 3.0),
    ]


def test_scoring_against_thresholds(spark):
    days = [(date(2026, 1, d), "d", {"temperature": float(d)}) for d in range(1, 10)]
    limits = offline.thresholds(offline.daily_stats(lake(spark, days)), k=1.0)
    live = readings(spark, [reading(0, 50.0), reading(0, 5.0), reading(0, 5.0, device="new")])
    got = offline.score_against_thresholds(live, limits).collect()
    shown = {(r["device_id"], r["value"]): (r["zscore"], r["out_of_range"]) for r in got}
    assert shown[("d", 5.0)] == (0.0, False)
    assert shown[("d", 50.0)][1] is True
    assert shown[("new", 5.0)] == (None, None)
