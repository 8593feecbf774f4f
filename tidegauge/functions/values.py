"""Numbers and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    """Text to double, null where it is no number.

    A cast alone would read a trailing ``d`` or ``f`` as a type suffix and turn
    ``"1d"`` into 1.0.
    """
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~suffixed, text.try_cast("double"))


def number_text(value: Column) -> Column:
    """Shortest text of a double, without exponent from 0.0001 up to 10^16."""
    size = F.abs(value)
    short = value.cast("string")
    # 20 decimals hold all 17 digits of the smallest such number
    long = F.regexp_replace(value.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0*$", "$1")
    return F.when(short.contains("E") & (size >= 1e-4) & (size < 1e16), long).otherwise(short)


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null and NaN becomes ``high``."""
    # greatest/least skip nulls, so an unguarded call would invent a reading
    limited = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.when(value.isNotNull(), limited)


def is_finite(value: Column) -> Column:
    return ~(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))))


def text_or(value: Column, default: Column | str) -> Column:
    """``value``, or the default where it is null or empty."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def soil_percent(raw: Column, dry: int = 3500, wet: int = 1500) -> Column:
    """Probe reading to percent moisture: dry is 0, wet is 100, whole percents."""
    scaled = (raw.cast("double") - F.lit(dry)) * 100 / F.lit(wet - dry)
    return clamp(scaled, 0.0, 100.0).cast("int")
