"""Time-series line protocol text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.times import epoch_ns
from tidegauge.functions.values import is_finite, number_text, text_or


def escape(text: Column) -> Column:
    """Backslash before backslash, space, comma and equals sign."""
    return F.regexp_replace(text, r"([\\ ,=])", r"\\$1")


def tag_text(names: tuple[str, ...]) -> Column:
    parts = [
        F.concat(F.lit(f"{name}="), escape(text_or(F.col(name), "unknown"))) for name in names
    ]
    return F.concat_ws(",", *parts)


def field_text(name: Column, value: Column) -> Column:
    """``name=value``, or null where there is no finite value to write."""
    return F.when(
        value.isNotNull() & is_finite(value),
        F.concat(escape(name), F.lit("="), number_text(value)),
    )


def line(measurement: str, tags: Column, fields: Column, ts: Column) -> Column:
    head = F.concat(F.lit(f"{measurement},"), tags)
    return F.concat_ws(" ", head, fields, epoch_ns(ts).cast("string"))
