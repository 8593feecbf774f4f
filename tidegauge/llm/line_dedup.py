"""Boilerplate lines by their frequency within a site.

A line is boilerplate on a host if more than ``ratio`` of the host's pages contain
it, and at least ``min_pages`` of them. Exact copies of a page count as one page, so
that a page is not boilerplate for having been crawled often.

Defined results: lines are compared without surrounding white space; blank lines are
never boilerplate; a page without host belongs to no site and stays as it is, as does
a null text; a page of nothing but boilerplate keeps its blank lines or becomes empty.
Texts of any length are split whole; a line at the ratio stays. Other columns are kept
whatever their names, ``lines_dropped`` is replaced. An empty table gives no rows.
Everything here is built from Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace, named

RATIO = 0.1
MIN_PAGES = 5


def _line_key(line: Column) -> Column:
    """A line's identity, 0 if it is blank.

    64 bits suffice: a line is dropped only for meeting one of the few boilerplate
    lines of its own host, and a chance meeting of two rare lines makes neither frequent.
    """
    bare = F.trim(line, F.lit(" \t\r\x0b\x0c"))
    return F.when(bare == "", F.lit(0).cast("long")).otherwise(F.xxhash64(bare))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the keys of the boilerplate lines of each host.

    ``pages`` has host and text. A host has at most average lines per page / ratio of
    them, so the array stays small however many pages the host has.
    """
    known = pages.filter("host is not null and text is not null")
    lines = F.array_distinct(F.transform(F.split("text", "\n"), _line_key))
    # copies meet as (host, text key) with the line keys only, combined before the shuffle
    distinct = (
        known.select("host", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"), lines.alias("lines"))
        .groupBy("host", "a", "b")
        .agg(F.any_value("lines").alias("lines"))
    )
    # a page is counted by the line key 0, put in front of its lines whether or not it has blank ones
    counted = (
        distinct.select(
            "host", F.explode(F.array_union(F.array(F.lit(0).cast("long")), "lines")).alias("line")
        )
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
    )
    totals = counted.filter("line = 0").select("host", F.col("n").alias("total"))
    return (
        counted.filter((F.col("line") != 0) & (F.col("n") >= min_pages))
        .join(totals, "host")
        .filter(F.col("n") > ratio * F.col("total"))
        .groupBy("host")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host: Column | str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with the boilerplate lines of each host taken out of ``text``.

    Other columns are kept; the number of lines taken out is put in ``lines_dropped``.
    """
    of = F.col(host) if isinstance(host, str) else host
    whole = docs.select(F.struct(*named(docs.columns)).alias("row"), of.alias("host"), F.col(text).alias("text"))
    # kept first, as its size then tells whether the texts have to be shuffled at all
    space = Workspace(docs.sparkSession, "line-dedup")
    found = space.keep(boilerplate(whole.select("host", "text"), ratio, min_pages), "boilerplate")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains("lines", _line_key(x)))
    marked = (
        whole.join(found, "host", "left")
        .withColumn("kept", F.when(F.col("lines").isNotNull() & F.col("text").isNotNull(), kept))
        .withColumn("n", F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)))
    )
    columns = [
        F.when(F.col("n") > 0, F.array_join("kept", "\n")).otherwise(F.col("text")).alias(c)
        if c == text
        else F.col("row").getField(c).alias(c)
        for c in docs.columns
        if c != "lines_dropped"
    ]
    return marked.select(*columns, F.col("n").alias("lines_dropped"))
