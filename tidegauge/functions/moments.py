"""Moments that can be merged: count, mean and squared deviations from the mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("n", "mean", "squares")

#: Up to so many states have a column each while they are gathered, which hashes; more make a list, which sorts.
IN_COLUMNS = 32


def moments(value: str) -> dict[str, Column]:
    """Aggregates: the state of a group of readings, null readings left out."""
    return {"n": F.count(value), "mean": F.avg(value), "squares": F.var_pop(value) * F.count(value)}


def gathered(place: str, number: int) -> Column:
    """Aggregate: the states of a group as an array, where each of ``number`` places has one at most.

    The rows have the fields of a state as columns.
    """
    if number > IN_COLUMNS:
        return F.collect_list(F.struct(*FIELDS))
    at = [F.struct(*(F.max(F.when(F.col(place) == i, F.col(c))).alias(c) for c in FIELDS)) for i in range(number)]
    return F.filter(F.array(*at), lambda s: s["n"].isNotNull())


def _merge(a: Column, b: Column) -> Column:
    """Chan's formula: no large sums of squares are ever subtracted."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"),
        (a["mean"] + apart * b["n"] / n).alias("mean"),
        (a["squares"] + b["squares"] + apart * apart * a["n"] * b["n"] / n).alias("squares"),
    )


def merged(states: Column) -> Column:
    """The state of all readings behind an array of states, none of which is of no readings."""
    rest = F.slice(states, 2, F.greatest(F.size(states) - 1, F.lit(0)))
    return F.aggregate(rest, F.element_at(states, 1), _merge)
