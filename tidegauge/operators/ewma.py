"""Exponentially weighted moving average of a series and the score built on it.

The average runs over window means, not single readings: however many readings a
series has, what is left of it is one row per window, aggregated on the map side.

Average and variance follow e = alpha * x + (1 - alpha) * e and
v = (1 - alpha) * (v + alpha * (x - e)^2). The score is the distance of x from the average
before it in standard deviations before it, at least ``min_std``. The first window of a
series starts the average and has no score.

Both are affine: a stretch of a series maps the average before it to the one after it by
e -> a * e + b, and the variance by v -> a * v + q(e) with a quadratic q. So a series is
cut into blocks of time, every block is summed up by its map in a task of its own, the
maps, one small row a block, are composed along the series, and each block is then worked
out from the values that enter it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.recurrences import affine_steps, decayed_sums, places
from tidegauge.functions.times import micros
from tidegauge.settings import MIN_STD

SERIES = ("device_id", "metric")
MAPS = "device_id string, metric string, block bigint, a double, b double, origin double, q0 double, q1 double, q2 double"


def walk(
    x: np.ndarray, place: np.ndarray, average: np.ndarray, variance: np.ndarray, alpha: float, min_std: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(average after, variance after, score) of each value; ``average`` and ``variance`` enter its run."""
    keep = 1 - alpha
    power = keep ** (place + 1)
    after = power * average + decayed_sums(alpha * x, place, keep)
    first = place == 0
    before = np.where(first, average, np.roll(after, 1))
    spread = power * variance + decayed_sums(keep * alpha * (x - before) ** 2, place, keep)
    spread_before = np.where(first, variance, np.roll(spread, 1))
    return after, spread, (x - before) / np.maximum(np.sqrt(spread_before), min_std)


def _summed_up(x: np.ndarray, place: np.ndarray, alpha: float) -> tuple[np.ndarray, ...]:
    """(first row, a, b, origin, q0, q1, q2) of each run.

    The quadratic is taken around the run's first value, so that nothing large cancels
    where a series lies far from zero.
    """
    keep = 1 - alpha
    begins = np.flatnonzero(place == 0)
    last = np.append(begins[1:], len(x)) - 1
    origin = np.repeat(x[begins], last - begins + 1)
    # averages and their distances for an average of origin before the run
    after = keep ** (place + 1) * origin + decayed_sums(alpha * x, place, keep)
    before = np.where(place == 0, origin, np.roll(after, 1))
    apart, slope = x - before, keep**place
    q = [decayed_sums(keep * alpha * part, place, keep)[last] for part in (apart**2, -2 * apart * slope, slope**2)]
    a = keep ** (place[last] + 1)
    return begins, a, after[last] - a * x[begins], x[begins], *q


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in pieces that end where a block of a series does."""
    held: list[pa.RecordBatch] = []

    def key(batch, i):
        return tuple(batch.column(c)[i].as_py() for c in (*SERIES, "block"))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if key(held[0], 0) == key(batch, batch.num_rows - 1):
            continue
        table = pa.Table.from_batches(held)
        codes = _codes(table)
        cut = int(np.flatnonzero(codes != codes[-1])[-1]) + 1
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _codes(table: pa.Table) -> np.ndarray:
    """A number for each block of a series in sorted rows."""
    new = np.zeros(table.num_rows, bool)
    for c in (*SERIES, "block"):
        column = table.column(c)
        if c != "block":
            column = column.combine_chunks().dictionary_encode().indices.fill_null(-1)
        column = column.to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _maps(alpha: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            begins, *rest = _summed_up(table.column("mean").to_numpy(), places(_codes(table)), alpha)
            found = table.select([*SERIES, "block"]).take(pa.array(begins)).combine_chunks()
            for name, column in zip(("a", "b", "origin", "q0", "q1", "q2"), rest, strict=True):
                found = found.append_column(name, pa.array(column))
            yield from found.to_batches()

    return summed


def _entering(table: pa.Table) -> pa.Table:
    """(series, block, average, variance): what enters each block of one series."""
    table = table.sort_by("block")
    a, b, origin, q0, q1, q2 = (table.column(c).to_numpy() for c in ("a", "b", "origin", "q0", "q1", "q2"))
    # the first window starts the average
    average = affine_steps(a, b, origin[0])
    apart = average - origin
    variance = affine_steps(a, q0 + q1 * apart + q2 * apart**2, 0.0)
    found = table.select([*SERIES, "block"])
    # rounding may leave a variance a hair below zero
    found = found.append_column("average", pa.array(average))
    found = found.append_column("variance", pa.array(np.maximum(variance, 0.0)))
    return found.append_column("opens", pa.array(np.arange(len(a)) == 0))


def ewma_scores(
    means: DataFrame,
    alpha: float = 0.3,
    min_std: float = MIN_STD,
    order: str = "window_start",
    block: str = "1 day",
) -> DataFrame:
    """Score each window mean against the moving average that precedes it.

    ``block`` is the stretch of time that one task works out at once; windows without a
    mean or a time are left out. Static input; ``streaming.ewma`` is the form for streams.
    """
    width = micros(block)
    points = (
        means.filter(F.col("mean").isNotNull() & F.col(order).isNotNull())
        .select(*SERIES, order, "mean", F.unix_micros(order).alias("at"))
        .withColumn("block", F.expr(f"(at - pmod(at, {width})) div {width}"))
        .drop("at")
    )
    sorted_points = points.repartition(*SERIES, "block").sortWithinPartitions(*SERIES, "block", order)
    maps = sorted_points.mapInArrow(_maps(alpha), MAPS)
    entering = maps.groupBy(*SERIES).applyInArrow(
        _entering, "device_id string, metric string, block bigint, average double, variance double, opens boolean"
    )
    known = [points[c].eqNullSafe(entering[c]) for c in (*SERIES, "block")]
    placed = (
        points.join(entering, known)
        .select(*(points[c] for c in points.columns), "average", "variance", "opens")
        .repartition(*SERIES, "block")
        .sortWithinPartitions(*SERIES, "block", order)
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            x, average, variance, opens = (table.column(c).to_numpy() for c in ("mean", "average", "variance", "opens"))
            place = places(_codes(table))
            after, _, score = walk(x, place, average, variance, alpha, min_std)
            found = table.select([*SERIES, order, "mean"])
            found = found.append_column("ewma", pa.array(after))
            yield from found.append_column("score", pa.array(score, mask=opens & (place == 0))).to_batches()

    return placed.mapInArrow(
        scored, f"device_id string, metric string, {order} timestamp, mean double, ewma double, score double"
    )
