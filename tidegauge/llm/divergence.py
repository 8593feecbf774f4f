"""How differently the sources of a language use its vocabulary.

A group is a (language, source). Every group, and the language as a whole, gives each kept
term a share of a billion, p = 1 + floor(10^9 * (count + 2) / (N + 2 V)), where N counts
the group's kept terms and V the language's kept terms: those in at least ``min_docs`` of
its documents. Two shares diverge by floor((p - q)^2 / (p + q)). All arithmetic is in
whole numbers.

Terms are counted ahead of the shuffle, kept ones get ids, and the vocabulary of a
language is cut into blocks by hash. In a block each group is a sorted array of (term id,
count). Two groups' arrays are merged by looking up the shorter in the longer, which
prices the terms both have; a term of only one group, and a term of neither, is priced
with the share of a count of zero, for both at once as the price is symmetric. Groups are
dealt to tiles, and a task holds two tiles of one block, so its memory is bounded by
2 * TILE * BLOCK entries, whatever the number of sources or the size of a vocabulary.

Defined results: null text, language or source is empty; a row is a document, so rows that
repeat an id count as often; a group without kept terms still has the share of a zero for
each of them; a language without kept terms has divergence 0 between its sources and no
term rows; equal values are ranked by the UTF-8 order of their items. Long texts are
counted whole. Other columns are ignored. An empty table gives no rows. Counts are whole
64-bit numbers, as are 1,000 times the sum N + 2 V.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.tables import Workspace
from tidegauge.llm.terms import LETTERS, splitter
from tidegauge.llm.workers import portions, slim

MIN_DOCS = 10
TOP_TERMS = 10
#: Terms of a vocabulary block on average, and groups of a tile.
BLOCK = 8_192
TILE = 32
#: (group, term) pairs a task counts before it hands them on.
COUNTED = 300_000

terms = splitter(LETTERS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), counted ahead of the shuffle; an empty term names each group."""
    groups: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    held = 0

    def counted():
        for (lang, source), (n, docs) in groups.items():
            rows = [b"", *n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(rows), pa.string()),
                    pa.array([source] * len(rows), pa.string()),
                    pa.array(rows, pa.binary()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        groups.clear()

    for batch in batches:
        for part in portions(batch, "text", batch.num_rows):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                n, docs = groups[lang, source]
                found = terms(text)
                held -= len(n)
                n.update(found)
                docs.update(set(found))
                held += len(n)
                if held > COUNTED:
                    yield from counted()
                    held = 0
    yield from counted()


def shares(n: np.ndarray, of: int) -> np.ndarray:
    """1 + floor(10^9 * (n + 2) / of), by long division in three steps of a thousand."""
    left = n + 2
    share = left // of
    for _ in range(3):
        left = left % of * 1000
        share = share * 1000 + left // of
    return share + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _merge(a: tuple, b: tuple, size: int) -> int:
    """The divergence of two groups, (ids, shares, share of zero) each, over a block of ``size`` terms."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, p, none_p), (other_ids, q, none_q) = a, b
    at = np.searchsorted(other_ids, ids)
    both = np.zeros(len(ids), bool)
    inside = at < len(other_ids)
    both[inside] = other_ids[at[inside]] == ids[inside]
    only_q = np.ones(len(other_ids), bool)
    only_q[at[both]] = False
    neither = size - len(ids) - int(only_q.sum())
    return int(
        divergence(p[both], q[at[both]]).sum()
        + divergence(p[~both], none_q).sum()
        + divergence(none_p, q[only_q]).sum()
        + neither * divergence(none_p, none_q)
    )


def _price(table: pa.Table) -> pa.Table:
    """For ``applyInArrow``: (lang, a, b, value) of the pairs of groups of two tiles, over one block."""
    table = table.sort_by("source")
    rows = table.drop_columns(["ids", "counts"]).to_pydict()
    size, lo, hi = rows["size"][0], rows["lo"][0], rows["hi"][0]
    groups = []
    for i, (tile, source, n, v) in enumerate(zip(*(rows[c] for c in ("tile", "source", "total", "v")), strict=True)):
        ids, counts = (table.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("ids", "counts"))
        # without kept terms nothing is divided
        of = max(n + 2 * v, 1)
        groups.append((tile, source, (ids, shares(counts, of), shares(np.int64(0), of))))
    a, b, values = [], [], []
    for k, (tile, source, first) in enumerate(groups):
        for other_tile, other, second in groups[k + 1 :]:
            if {tile, other_tile} == {lo, hi}:
                a.append(source)
                b.append(other)
                values.append(_merge(first, second, size) if size else 0)
    return pa.table(
        {
            "lang": pa.array([rows["lang"][0]] * len(a), pa.string()),
            "a": pa.array(a, pa.string()),
            "b": pa.array(b, pa.string()),
            "value": pa.array(values, pa.int64()),
        }
    )


def _share(n: str, of: str) -> Column:
    """``shares`` as a column; a decimal holds 10^9 times any count."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(20, 0)) * 1000000000) div cast({of} as decimal(20, 0))")


class Counts:
    """What the audit rests on, as written tables.

    ``entries`` (lang, source, id, n, term, block, lang_n) has the kept terms of each group,
    ``groups`` (lang, source, total, v, lang_total, blocks, tiles) all groups, and ``sizes``
    (lang, block, size) the blocks of a vocabulary.
    """

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        space = Workspace(docs.sparkSession, "divergence")
        texts = docs.select(
            F.coalesce("lang", F.lit("")).alias("lang"),
            F.coalesce("source", F.lit("")).alias("source"),
            F.col("text").cast("binary").alias("text"),
        )
        partial = space.keep(
            texts.mapInArrow(lambda b: slim(_count(b)), "lang string, source string, term binary, n long, docs long"),
            "partial",
        )
        known = (
            partial.filter("length(term) > 0")
            .groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs)
        )
        # ids are fixed by being written
        kept = space.keep(known.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("id")), "kept")
        langs = space.keep(
            kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "langs"
        ).withColumn("blocks", F.ceil(F.col("v") / BLOCK))
        in_block = kept.join(langs.select("lang", "blocks"), "lang").withColumn(
            "block", F.pmod(F.xxhash64("term"), F.col("blocks"))
        )
        self.sizes = in_block.groupBy("lang", "block").agg(F.count("*").alias("size"))
        # hashed and not sorted: a vocabulary has one row a key, so no partition of it is hot
        self.entries = space.keep(
            partial.join(in_block.drop("blocks").hint("shuffle_hash"), ["lang", "term"])
            .groupBy("lang", "source", "id", "term", "block", "lang_n")
            .agg(F.sum("n").alias("n")),
            "entries",
        )
        totals = self.entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        every = partial.select("lang", "source").distinct()
        tiles = every.groupBy("lang").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
        self.groups = space.keep(
            every.join(totals, ["lang", "source"], "left")
            .join(langs, "lang", "left")
            .join(tiles, "lang")
            .select(
                "lang",
                "source",
                *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "lang_total")),
                F.greatest("blocks", F.lit(1)).alias("blocks"),
                "tiles",
            ),
            "groups",
        )


def source_pairs(counts: Counts) -> DataFrame:
    """(lang, source, item, value) for each source of a language and each other source of it."""
    arrays = counts.entries.groupBy("lang", "source", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries")
    )
    places = counts.groups.select(
        "lang",
        "source",
        "total",
        "v",
        "tiles",
        F.pmod(F.xxhash64("source"), F.col("tiles")).alias("tile"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    empty = F.array().cast("array<long>")
    dealt = (
        places.join(arrays, ["lang", "source", "block"], "left")
        .join(counts.sizes, ["lang", "block"], "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select(
            "lang",
            "source",
            "block",
            "tile",
            "total",
            "v",
            F.coalesce("size", F.lit(0).cast("long")).alias("size"),
            F.coalesce("entries.id", empty).alias("ids"),
            F.coalesce("entries.n", empty).alias("counts"),
            F.least("tile", "other").alias("lo"),
            F.greatest("tile", "other").alias("hi"),
        )
    )
    pairs = (
        dealt.groupBy("lang", "block", "lo", "hi")
        .applyInArrow(_price, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    ways = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    return pairs.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.*", "value")


def source_terms(counts: Counts) -> DataFrame:
    """(lang, source, item, value) for the terms a source has and uses more than its language."""
    p, q = _share("n", "total + 2 * v"), _share("lang_n", "lang_total + 2 * v")
    return (
        counts.entries.join(counts.groups.select("lang", "source", "total", "v", "lang_total"), ["lang", "source"])
        .select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): every pair of sources, and each source's most telling terms."""
    counts = Counts(docs, min_docs)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(part, rows):
        return rows.select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")
        )

    return ranked("pair", source_pairs(counts)).unionByName(
        ranked("term", source_terms(counts)).filter(F.col("rank") <= top_terms)
    )
