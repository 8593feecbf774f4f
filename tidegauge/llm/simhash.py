"""SimHash near-duplicates by deletion-variant signatures.

Two fingerprints within four bits, cut into three segments, differ by at most one
bit in some segment. Each fingerprint is indexed under all its segments with one
bit wiped out, fingerprints that share such an entry meet by equality, and every
meeting is verified on the whole 64 bits.

Defined results: a null or blank text has fingerprint zero and is linked like any
other; rows of one doc_id count as one document; a row without doc_id keeps its
fingerprint and gets the smallest id it is linked to, or null. Texts of any length
are hashed block by block. Bits set in exactly half of the shingles are zero; of the rows of
one id that stays any one does. Other columns are kept whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import linking
from tidegauge.llm.tables import Workspace, named

WORDS = 4
DISTANCE = 4
#: Shingles hashed at a time, so that memory does not grow with the text.
SHINGLES = 65_536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits, one where more than half of the shingles' hashes have a one."""
    # bytes: lower() and split() touch ASCII letters and ASCII white space only
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), SHINGLES):
        hashes = np.array(
            [xxhash.xxh64_intdigest(joined[a : b - 1], 42) for a, b in zip(starts[at:], ends[at : at + SHINGLES])],
            dtype="<u8",
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(ends), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x, words) for x in texts.to_pylist()], pa.int64())

    return hashed(text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by at most one bit."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _entries(parts: list[tuple[int, int]]):
    """For ``mapInArrow``: every fingerprint under every segment with one bit wiped out."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            for s, (low, width) in enumerate(parts):
                piece = (nodes.view(np.uint64) >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1)
                for bit in range(width):
                    key = (((s << 6) | bit) << 32) | (piece & ~(1 << bit))
                    yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("node")], names=["key", "node"])

    return index


def _large_keys(nodes: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """(key, blocks) of index entries that may hold more than one block of fingerprints.

    A wiped bit joins two values of a segment, so counting the values bounds the entries.
    """
    values = [
        F.struct(
            F.lit(s).alias("s"),
            F.shiftrightunsigned("node", low).bitwiseAND((1 << width) - 1).alias("value"),
        )
        for s, (low, width) in enumerate(parts)
    ]
    counts = nodes.select(F.explode(F.array(*values)).alias("x")).groupBy("x.s", "x.value").count()
    bits = F.element_at(F.array(*[F.lit(width) for _, width in parts]), F.col("s") + 1)
    wiped = F.expr("value & ~shiftleft(1L, bit)")
    key = ((F.col("s") * 64 + F.col("bit")).cast("long") * F.lit(1 << 32) + wiped).alias("key")
    return (
        counts.filter(F.col("count") > linking.BLOCK // 2)
        .withColumn("bit", F.explode(F.sequence(F.lit(0), bits - 1)))
        .select(key, "count")
        .groupBy("key")
        .agg((F.ceil(2 * F.max("count") / linking.BLOCK)).cast("int").alias("blocks"))
    )


def links(nodes: DataFrame, distance: int, space: Workspace) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (``node``) within ``distance`` bits."""
    parts = segments(distance)
    if any(width > 32 for _, width in parts):
        raise ValueError("distances from 2 on are indexed")
    low = np.array([a for a, _ in parts], np.uint64)

    def near(others, node):
        return np.bitwise_count(others ^ node) <= distance

    def once(keys, a, b):
        differ = (a ^ b).view(np.uint64)
        s, bit = keys >> 38, (keys >> 32) & 63
        width = np.array([w for _, w in parts], np.uint64)[s]
        inside = (differ >> low[s]) & ((np.uint64(1) << width) - np.uint64(1))
        here = (inside == np.uint64(1) << bit.astype(np.uint64)) | ((inside == 0) & (bit == 0))
        return here & (np.bitwise_count(differ) <= distance)

    entries = nodes.mapInArrow(_entries(parts), "key long, node long")
    large = space.keep(_large_keys(nodes, parts), "large-keys")
    if large.isEmpty():
        pieces = entries.withColumn("piece", F.lit(0))
    else:
        pieces = linking.split_large_keys(entries, large)
    return linking.linked(pieces, near, once)


def classes(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id): the class of every row of ``docs`` (doc_id, text).

    fingerprint is 16 hex digits, component_id the smallest doc_id reachable over links
    of at most ``distance`` bits. Copies share a fingerprint and are never paired.
    """
    space = Workspace(docs.sparkSession, "simhash")
    rows = space.keep(docs.select("doc_id", fingerprints(F.col("text"), words).alias("node")), "rows")
    nodes = space.keep(rows.groupBy("node").agg(F.min("doc_id").alias("least")), "nodes")
    # rows of one id with several fingerprints are one document
    same = (
        rows.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("node").alias("a"), F.max("node").alias("z"))
        .filter("a <> z")
        .join(rows, "doc_id")
        .select("a", F.col("node").alias("b"))
    )
    roots = space.keep(
        linking.components(links(nodes.select("node"), distance, space).unionByName(same), space), "roots"
    )
    # written, so that the join with the one root of a large class can be split
    least = space.keep(
        roots.join(nodes, "node").groupBy("root").agg(F.min("least").alias("component_id")), "least"
    )
    joined = roots.join(least, "root").select("node", "component_id")
    named = space.keep(
        nodes.join(joined, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id")),
        "named",
    )
    digits = F.lower(F.lpad(F.hex("node"), 16, "0"))
    return rows.join(named, "node").select("doc_id", digits.alias("fingerprint"), "component_id")


def one_per_class(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The document with the smallest id of every class, with all its columns.

    Repeated rows of one id become one row; rows without id stay as they are.
    """
    space = Workspace(docs.sparkSession, "simhash-kept")
    found = space.keep(classes(docs.select("doc_id", "text"), words, distance), "classes")
    surplus = found.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(surplus, "doc_id", "left_anti").select(*named(docs.columns))
    repeated = space.keep(
        found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated"
    )
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, "doc_id", "left_anti").unionByName(
        kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    )
