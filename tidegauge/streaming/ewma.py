"""Moving-average scores on a stream.

The same score as ``operators.ewma``, kept up window by window: the state of a
series is two numbers, however long it runs. The windows of a series that close in one
micro-batch are worked out together, as two columns of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.ewma import SERIES, walk
from tidegauge.settings import MIN_STD


def processor(alpha: float, min_std: float) -> StatefulProcessor:
    # a local class travels to the executors with the query
    class MovingAverage(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("average", "ewma double, variance double")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            columns = [(part["window_start"].to_numpy(), part["mean"].to_numpy(np.float64)) for part in rows]
            times, means = (np.concatenate(c) for c in zip(*columns, strict=True))
            order = np.argsort(times, kind="stable")
            times, means = times[order], means[order]
            opens = not self.state.exists()
            average, variance = (means[0], 0.0) if opens else self.state.get()
            averages, variances, scores = walk(means, np.arange(len(means)), average, variance, alpha, min_std)
            self.state.update((float(averages[-1]), float(variances[-1])))
            if opens:
                scores[0] = np.nan
            found = {"window_start": times, "mean": means, "ewma": averages, "score": scores}
            yield pd.DataFrame({**dict(zip(SERIES, key, strict=True)), **found})

        def close(self) -> None:
            pass

    return MovingAverage()


def ewma_scores(means: DataFrame, alpha: float = 0.3, min_std: float = MIN_STD) -> DataFrame:
    """Scores of window means as their windows close.

    ``means`` is a stream of closed windows (``window_features`` with a watermark):
    those of a series arrive in time order over the micro-batches and are sorted
    within one.
    """
    scored = (
        means.select(*SERIES, "window_start", "mean")
        .filter(F.col("mean").isNotNull())
        .groupBy(*SERIES)
        .transformWithStateInPandas(
            processor(alpha, min_std),
            outputStructType="device_id string, metric string, window_start timestamp, "
            "mean double, ewma double, score double",
            outputMode="Append",
            timeMode="None",
        )
    )
    return scored.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
