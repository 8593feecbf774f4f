"""Readings held until their window closes, by one stateful operator.

A reading waits in the list state of its window, series and salt; an event-time timer at
the end of the window hands all of them on in the micro-batch in which the watermark
passes it. Whatever its salt, every reading of a window comes out in the same micro-batch,
so that the micro-batch can be scored like a table (``score_closed``): statistics are
aggregated on the map side and a hot series is split by measured size.

What cannot be scored comes out at once, with the reason: a reading whose window has
closed, or one without time or with an incomplete key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge import schemas
from tidegauge.functions.times import micros
from tidegauge.operators.anomaly import score_rows
from tidegauge.operators.metrics import drop_non_finite
from tidegauge.settings import MIN_STD, WINDOW

LATE = "window has closed"
INCOMPLETE = "no time or incomplete key"
#: State keys the readings of one window and series are spread over.
SALTS = 16

#: In place of the end of a window for readings that belong to none.
NEVER = -(2**62)

COLUMNS = ("at", *schemas.TAGS, "metric", "value")
HELD = "at bigint, device_id string, location string, model string, metric string, value double"


def _holder() -> StatefulProcessor:
    # a local class travels to the executors with the query
    class HeldReadings(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.readings = handle.getListState("readings", HELD)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            closes = int(key[0])
            late = closes <= timerValues.getCurrentWatermarkInMs()
            for part in rows:
                part = part[list(COLUMNS)].astype({"at": "Int64"})
                if closes == NEVER or late:
                    yield part.assign(reason=INCOMPLETE if closes == NEVER else LATE)
                else:
                    plain = part.astype(object).where(part.notna(), None)
                    self.readings.appendList(list(plain.itertuples(index=False, name=None)))
                    self.handle.registerTimer(closes)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            held: list[tuple] = []
            for reading in self.readings.get():
                held.append(tuple(reading))
                if len(held) == 10_000:
                    yield pd.DataFrame(held, columns=COLUMNS).assign(reason=None)
                    held.clear()
            if held:
                yield pd.DataFrame(held, columns=COLUMNS).assign(reason=None)
            self.readings.clear()

        def close(self) -> None:
            pass

    return HeldReadings()


def closed_windows(
    rows: DataFrame, window: str = WINDOW, watermark: str = "2 minutes", salts: int = SALTS, nan_policy: str = "drop"
) -> DataFrame:
    """(readings, reason): the readings of each window when it closes, and at once what belongs to none.

    ``window`` is of whole milliseconds. Readings without time do not move the watermark.
    """
    if micros(window) % 1000:
        raise ValueError(f"a window closes at a whole millisecond, not after {window!r}")
    if nan_policy == "drop":
        rows = drop_non_finite(rows)
    whole = F.lit(True)
    for name in ("at", *schemas.SCORING_KEYS):
        whole = whole & F.col(name).isNotNull()
    ends = F.when(whole, F.unix_millis(F.window("ts", window)["end"])).otherwise(NEVER)
    keyed = (
        rows.withWatermark("ts", watermark)
        # a window groups rows with a time only, so the others get any time here and no end
        .withColumn("at", F.unix_micros("ts"))
        .withColumn("ts", F.coalesce("ts", F.lit(0).cast("timestamp")))
        .withColumn("closes", ends)
        # draws the same state key when a task is repeated
        .withColumn("salt", F.pmod(F.xxhash64("at", "value"), F.lit(salts)).cast("int"))
        .select("closes", "salt", *(F.col(c).alias(c, metadata={}) for c in COLUMNS))
    )
    held = keyed.groupBy("closes", *schemas.SCORING_KEYS, "salt").transformWithStateInPandas(
        _holder(), outputStructType=f"{HELD}, reason string", outputMode="Append", timeMode="EventTime"
    )
    return held.select(F.timestamp_micros("at").alias("ts"), *schemas.TAGS, "metric", "value", "reason")


def score_closed(batch: DataFrame, window: str = WINDOW, min_std: float = MIN_STD, nan_policy: str = "drop") -> DataFrame:
    """A micro-batch of ``closed_windows`` scored; readings with a reason have null scores."""
    scored = score_rows(batch.filter("reason is null"), window, min_std=min_std, nan_policy=nan_policy)
    rest = batch.filter("reason is not null")
    return scored.unionByName(rest, allowMissingColumns=True)
