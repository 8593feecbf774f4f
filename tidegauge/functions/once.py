"""Expressions that must be evaluated once per row.

Spark moves a filter below the projection it follows and replaces each column it
mentions by that column's expression. A filter on three fields of a parsed JSON
message then parses the message three times, and the projection once more. Filters
do not cross a generator, so these helpers produce their columns through one that
yields exactly one row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_json(df: DataFrame, text: Column, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns, then the fields of a JSON text (nulls if unreadable)."""
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def with_computed(df: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    """The ``keep`` columns, then the given expressions."""
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(fields)))
