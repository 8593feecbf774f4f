"""Links between nodes that share a key, and the connected components they form.

Used by operators that find similar documents: nodes are distinct fingerprints,
keys are index entries under which similar fingerprints meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace

#: Nodes of one key compared in one piece; larger keys are split into pairs of blocks.
BLOCK = 16_384
#: Keys up to this size are compared by shifting whole batches against themselves.
SMALL = 32

EDGES = "a long, b long"


def split_large_keys(entries: DataFrame, large: DataFrame) -> DataFrame:
    """Deal the entries of large keys to pairs of blocks.

    ``large`` has (key, blocks). Every entry of such a key goes to one block and to
    each pair of blocks that contains it, so any two entries meet in one piece of
    about two blocks.
    """
    home = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int")
    return (
        entries.join(large, "key", "left")
        .withColumn("home", home)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .select(
            "key",
            "node",
            (F.least("home", "other") * F.lit(1 << 16) + F.greatest("home", "other")).cast("int").alias("piece"),
        )
    )


def _stars(nodes: np.ndarray, near: Callable) -> tuple[np.ndarray, np.ndarray]:
    """One edge per node that is linked to an earlier one, directly or through others.

    Breadth first over nodes not yet reached, so a dense group costs about its size
    and a sparse one all its pairs; the edges never outnumber the nodes.
    """
    left, a, b = nodes, [], []
    while len(left) > 1:
        root, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            hit = near(left, front.pop())
            if hit.any():
                found, left = left[hit], left[~hit]
                front.extend(found)
                a.append(found)
                b.append(np.full(len(found), root))
    if not a:
        return nodes[:0], nodes[:0]
    return np.concatenate(a), np.concatenate(b)


def linker(near: Callable, once: Callable) -> Callable:
    """A function for ``mapInArrow`` over (key, node, piece), sorted by key and piece.

    ``near(nodes, node)`` tells which nodes are linked. ``once(keys, a, b)`` tells of
    pairs under small keys whether they are linked and this key is the one to report it.
    """

    def small_runs(key, node, run):
        for shift in range(1, SMALL):
            i = np.flatnonzero(run[shift:] == run[:-shift])
            if not len(i):
                return
            i = i[once(key[i], node[i], node[i + shift])]
            if len(i):
                yield node[i + shift], node[i]

    def runs(key, piece, node):
        order = np.flatnonzero((key[1:] != key[:-1]) | (piece[1:] != piece[:-1])) + 1
        bounds = np.concatenate(([0], order, [len(key)]))
        sizes = np.diff(bounds)
        number = np.repeat(np.arange(len(sizes)), sizes)
        small = (sizes > 1) & (sizes <= SMALL)
        pick = small[number]
        yield from small_runs(key[pick], node[pick], number[pick])
        for r in np.flatnonzero(sizes > SMALL):
            yield _stars(np.unique(node[bounds[r] : bounds[r + 1]]), near)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def edges(parts):
            columns = (np.concatenate(x) for x in zip(*parts, strict=True))
            for a, b in runs(*columns):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "piece", "node"))
            # the last key of a batch may go on in the next one
            new = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
            cut = new[-1] + 1 if len(new) else 0
            if held and (held[-1][0][-1], held[-1][1][-1]) != (part[0][0], part[1][0]):
                yield from edges(held)
                held = []
            if cut:
                yield from edges([*held, tuple(x[:cut] for x in part)])
                held = []
            held.append(tuple(x[cut:] for x in part))
        if held:
            yield from edges(held)

    return link


def linked(entries: DataFrame, near: Callable, once: Callable) -> DataFrame:
    """Edges (a, b) between the nodes of equal (key, piece)."""
    return (
        entries.repartition("key", "piece")
        .sortWithinPartitions("key", "piece")
        .mapInArrow(linker(near, once), EDGES)
    )


def components(edges: DataFrame, space: Workspace) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours, then its smaller ones, to its smallest neighbour. Minima are
    aggregated before the shuffle and no neighbourhood is gathered anywhere; the
    rounds grow with the logarithm of the longest path. Minima are written before they
    are joined: a join with an aggregate is never split, and the root of a large class is
    one key of it.
    """
    current = space.keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges-0",
    )
    before, number = _state(current), 0
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = space.keep(least, f"least-{number}")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = space.keep(large, f"large-{number}")
        least = space.keep(large.groupBy("u").agg(F.min("v").alias("m")), f"next-{number}")
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        number += 1
        following = space.keep(following, f"edges-{number}")
        after = _state(following)
        for name in ("edges", "least", "large", "next"):
            space.drop(f"{name}-{number - 1}")
        current = following
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row.n, row.h
