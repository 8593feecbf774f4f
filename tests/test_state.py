"""Streams whose micro-batches reach no sink keep their state all the same."""

import json
import os

from helpers import at
from tidegauge.operators import anomaly
from tidegauge import schemas
from tidegauge.sources import topics
from tidegauge.streaming import runner
from tidegauge.streaming.fanout import Sink, fan_out


def body(minute, value):
    return json.dumps({"ts": at(minute).isoformat(), "device_id": "d", "location": "l",
                       "model": "m", "metric": "t", "value": value})


def test_state_survives_batches_without_sinks(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    os.makedirs(folder)
    rows = topics.file_stream(spark, folder, schemas.METRIC_ROW, "json")
    scored = anomaly.score_rows(rows, watermark="2 minutes")

    def go(name, lines, sinks):
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(lines))
        writer = scored.writeStream.foreachBatch(fan_out(sinks))
        runner.drain(writer.option("checkpointLocation", checkpoint))

    go("0.json", [body(0.1, 1.0), body(0.2, 3.0)], [])
    go("1.json", [body(0.3, 5.0)], [])
    seen = []
    go("2.json", [body(9, 7.0)], [Sink("seen", lambda batch, _: seen.extend(batch.collect()))])
    assert {r["value"]: r["mean"] for r in seen} == {1.0: 3.0, 3.0: 3.0, 5.0: 3.0}
