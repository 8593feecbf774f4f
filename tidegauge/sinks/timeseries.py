"""Delivery of line-protocol rows, from the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.settings import TimeSeriesSettings


class DeliveryError(RuntimeError):
    """The endpoint refused a batch of lines."""


@dataclass(frozen=True)
class HttpTransport:
    """Sends text to a write endpoint."""

    url: str
    token: str = field(repr=False)
    timeout: float = 10.0

    @classmethod
    def of(cls, target: TimeSeriesSettings) -> HttpTransport:
        query = urlencode(
            {"org": target.org, "bucket": target.bucket, "precision": target.precision}
        )
        return cls(f"{target.url.rstrip('/')}/api/v2/write?{query}", target.token)

    def __call__(self, text: str) -> None:
        headers = {
            "Authorization": f"Token {self.token}",
            "Content-Type": "text/plain; charset=utf-8",
        }
        request = Request(self.url, data=text.encode(), headers=headers, method="POST")
        try:
            with urlopen(request, timeout=self.timeout) as answer:
                status, detail = answer.status, ""
        except HTTPError as error:
            status, detail = error.code, error.read(500).decode(errors="replace")
        if status >= 300:
            raise DeliveryError(f"write refused with status {status}: {detail}")


def deliver_lines(
    lines: DataFrame, send: Callable[[str], None], lines_per_request: int = 5000
) -> int:
    """Send column ``value`` in requests of at most ``lines_per_request`` lines.

    Every task sends its own rows, so nothing passes through the driver but the
    number of lines. A repeated task sends the same points again, which a
    time-series store keyed by (tags, time) overwrites with themselves.
    """

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), lines_per_request):
                send("\n".join(batch["value"].iloc[start : start + lines_per_request]))
            yield pd.DataFrame({"sent": [len(batch)]})

    sent = lines.select("value").mapInPandas(post, "sent bigint").agg(F.sum("sent"))
    return sent.first()[0] or 0
