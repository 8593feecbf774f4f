"""Timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6}
UNITS |= {"day": 24 * UNITS["hour"], "week": 7 * 24 * UNITS["hour"]}


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to timestamp, null where it cannot be read.

    Accepts ``Z`` and numeric offsets, any number of fraction digits (cut to
    microseconds) and dates without a time.
    """
    return F.try_to_timestamp(text)


def epoch_ns(ts: Column) -> Column:
    """Nanoseconds since the epoch, exact to the stored microsecond.

    A decimal, since a device clock in a far century would overflow a bigint.
    """
    return F.unix_micros(ts).cast("decimal(20,0)") * F.lit(1000)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def before(as_of: str | Column, span: str) -> Column:
    """The instant ``span`` (for example ``'15 minutes'``) before ``as_of``."""
    return instant(as_of) - F.expr(f"interval {span}")


def instant(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def micros(span: str) -> int:
    """Microseconds of a span such as ``'90 seconds'`` or ``'1 day 6 hours'``."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", span.lower())
    if not parts or any(unit not in UNITS for _, unit in parts):
        raise ValueError(f"not a span of fixed length: {span!r}")
    return sum(int(n) * UNITS[unit] for n, unit in parts)
