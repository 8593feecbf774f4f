"""Sliding windows by panes and moving averages by parallel prefixes, against plain loops."""

import math
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at
from tidegauge.functions import recurrences
from tidegauge.functions.times import micros
from tidegauge.operators import anomaly, ewma

WIDE = "event_ts timestamp, device_id string, temperature double"
MEANS = "device_id string, metric string, window_start timestamp, mean double"


def test_spans_in_microseconds():
    assert micros("90 seconds") == 90_000_000
    assert micros("1 day 6 hours") == 30 * 3600 * 10**6
    for wrong in ("1 month", "", "soon"):
        with pytest.raises(ValueError):
            micros(wrong)


def brute_peaks(rows, window, slide, least):
    """(end in seconds, device, peak, score) of every sliding window."""
    found = set()
    for device in {d for _, d, _ in rows}:
        times = [(t, v) for t, d, v in rows if d == device and v is not None]
        starts = {slide * k for t, _ in times for k in range((t - window) // slide + 1, t // slide + 1)}
        for start in starts:
            inside = [v for t, v in times if start <= t < start + window]
            if len(inside) > 1 and (std := statistics.stdev(inside)) > 0:
                score = (max(inside) - statistics.fmean(inside)) / std
                if score >= least:
                    found.add((start + window, device, max(inside), round(score, 6)))
    return found


@pytest.mark.parametrize(("window", "slide"), [(60, 10), (60, 25), (40, 40), (120, 1)])
def test_panes_equal_every_window_on_its_own(spark, window, slide):
    draw = np.random.default_rng(window + slide)
    rows = [(int(t), f"d{t % 3}", float(draw.normal(1e6, 0.5))) for t in draw.integers(0, 500, 300)]
    rows += [(int(t), "quiet", 3.0) for t in range(0, 100, 7)] + [(5, "null", None), (6, "null", 1.0), (9, "null", 2.0)]
    df = spark.createDataFrame([(at(t / 60), d, v) for t, d, v in rows], WIDE)
    got = anomaly.sliding_peak_anomalies(df, window=f"{window} seconds", slide=f"{slide} seconds", min_score=1.0)
    start = at(0).timestamp()
    offset = int(start) % slide
    shifted = [(t + offset, d, v) for t, d, v in rows]
    seconds = F.unix_seconds("ts").alias("t")
    found = {(r.t - int(start) + offset, r.device_id, r.value, round(r.score, 6)) for r in got.select(seconds, "device_id", "value", "score").collect()}
    wanted = brute_peaks(shifted, window, slide, 1.0)
    assert {x[:3] for x in found} == {x[:3] for x in wanted}
    assert sorted(x[3] for x in found) == pytest.approx(sorted(x[3] for x in wanted), rel=1e-6)


def test_readings_are_not_copied_per_window(spark):
    df = spark.createDataFrame([(at(0), "d", 1.0)], WIDE)
    plan = anomaly.sliding_peak_anomalies(df)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    expand = min(i for i, x in enumerate(lines) if "Expand" in x)
    below = [x for x in lines[expand:] if "HashAggregate" in x]
    # both steps of the pane aggregate are below the copies
    assert len(below) == 2 and all("partial_" in below[1] for _ in below)
    assert not re.search("SortAggregate|ObjectHashAggregate", plan)


def test_decayed_sums_and_affine_steps_equal_loops():
    draw = np.random.default_rng(1)
    place = recurrences.places(np.repeat(np.arange(40), draw.integers(1, 90, 40)))
    x = draw.normal(size=len(place))
    y = []
    for p, v in zip(place, x, strict=True):
        y.append(v + (0.9 * y[-1] if p else 0.0))
    assert recurrences.decayed_sums(x, place, 0.9) == pytest.approx(y)
    a, b = draw.uniform(0.1, 1, 77), draw.normal(size=77)
    now, before = 3.0, []
    for i in range(77):
        before.append(now)
        now = a[i] * now + b[i]
    assert recurrences.affine_steps(a, b, 3.0) == pytest.approx(before)
    assert len(recurrences.affine_steps(a[:0], b[:0], 1.0)) == 0 and len(recurrences.places(x[:0])) == 0


def plain(means, alpha, min_std):
    average, variance, found = means[0], 0.0, []
    for i, x in enumerate(means):
        score = None if not i else (x - average) / max(math.sqrt(variance), min_std)
        apart = x - average
        average, variance = alpha * x + (1 - alpha) * average, (1 - alpha) * (variance + alpha * apart * apart)
        found.append((average, score))
    return found


@pytest.mark.parametrize("block", ["7 minutes", "1 day", "1 minute"])
def test_blocks_of_a_series_equal_the_plain_recurrence(spark, block, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    draw = np.random.default_rng(4)
    series = {("a", "t"): draw.normal(1e5, 1, 500), ("b", "t"): draw.normal(0, 1, 90), ("c", None): np.array([4.0])}
    rows = [(d, m, at(i * 2), float(v)) for (d, m), means in series.items() for i, v in enumerate(means)]
    rows += [("b", "t", at(1), None), ("b", "t", None, 5.0)]
    got = ewma.ewma_scores(spark.createDataFrame(rows, MEANS), 0.2, 0.01, block=block).collect()
    for key, means in series.items():
        of = sorted(((r.window_start, r.ewma, r.score) for r in got if (r.device_id, r.metric) == key))
        wanted = plain(means.tolist(), 0.2, 0.01)
        assert [x[1] for x in of] == pytest.approx([x[0] for x in wanted])
        assert of[0][2] is None and [x[2] for x in of[1:]] == pytest.approx([x[1] for x in wanted[1:]], rel=1e-6, abs=1e-6)
    assert len(got) == 591


def test_one_series_is_worked_out_in_several_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.createDataFrame([("a", "t", at(i), float(i % 7)) for i in range(2000)], MEANS)
    tasks = ewma.ewma_scores(rows, block="1 hour").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 2000
