"""Anomaly scores and their severity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.settings import MIN_STD

# Lowest |z| of each severity.
SEVERITY_BANDS = (("critical", 8.0), ("high", 5.0), ("medium", 3.0))
LOWEST_SEVERITY = "low"


def floored_std(std: Column, min_std: float = MIN_STD) -> Column:
    """Standard deviation, at least ``min_std``; a missing one counts as ``min_std``."""
    return F.greatest(F.coalesce(std, F.lit(min_std)), F.lit(min_std))


def zscore(value: Column, mean: Column, std: Column, min_std: float = MIN_STD) -> Column:
    return (value - mean) / floored_std(std, min_std)


def severity(abs_z: Column) -> Column:
    return reduce(
        lambda label, band: F.when(abs_z >= band[1], F.lit(band[0])).otherwise(label),
        reversed(SEVERITY_BANDS),
        F.lit(LOWEST_SEVERITY),
    )
