"""Document fingerprints from a randomised edit embedding.

All texts take the same random walk: at every step the embedding repeats the character
under the walker, and a bit shared by all texts, chosen by step and character, says
whether the walker goes on to the next one. After an edit two walks soon meet again, so
texts a few edits apart agree on most steps. A fingerprint samples the steps: one from
each stretch of 2**level steps, chosen such that the sample of one level is part of that
of the level below and texts of different length can be compared. Each sample is one hex
digit, a hash of the three characters there. The likeness of two fingerprints is the
share of equal digits.

Bands of samples give candidates for similar documents, which are verified by likeness.
The members of a band are first compared with one of them; where that does not settle
the band, its members are compared in blocks. Pairs within a band are never listed.

Defined results: a null text is an empty one, whose fingerprint has level 0 and no
samples; two empty texts have likeness 1, an empty and another one 0; equal texts have
equal fingerprints and one class; walks read a whole text, whatever its length. Classes
are of rows: rows of one doc_id may be in several, and rows without doc_id have a
class but do not name it (null if there is no other). Distinct fingerprints are told apart by
64 bits of a hash. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import linking
from tidegauge.llm.tables import Workspace

#: Steps after which the shared bits repeat, and classes of characters that share them.
PERIOD, CLASSES = 256, 64
#: Fewest samples of a text that has so many steps; the most are twice as many.
SAMPLES = 128
#: Bands and samples of each, for candidates.
BANDS, BAND = 16, 6
#: Characters walked at a time.
PORTION = 1 << 20
#: Characters behind one digit.
WINDOW = 3

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _walk() -> list[bytes]:
    """For each class and step within the period, the step at which the next character begins."""
    bits = (_hash(np.arange(CLASSES * PERIOD)) & np.uint64(1)).astype(bool).reshape(CLASSES, PERIOD)
    tables = []
    for own in bits:
        following, table = None, [0] * PERIOD
        for step in range(2 * PERIOD - 1, -1, -1):
            if own[step % PERIOD]:
                following = (step + 1) % PERIOD
            if step < PERIOD:
                table[step] = following
        tables.append(bytes(table))
    return tables


@lru_cache(maxsize=64)
def _sampled(level: int, stretches: int) -> np.ndarray:
    """The sampled step of each stretch of 2**level steps."""
    at = np.arange(stretches, dtype=np.int64)
    for upper in range(level, 0, -1):
        at = 2 * at + (_hash(at * 64 + upper) & np.uint64(1)).astype(np.int64)
    return at


def fingerprint(text: str | None) -> str:
    """Two hex digits of the level, then one digit a sample."""
    if not text:
        return "00"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = (_hash(points) % np.uint64(CLASSES)).astype(np.uint8).tobytes()
    walk, step, walked = _walk(), 0, []
    for at in range(0, len(kinds), PORTION):
        walked.append(bytes([step := walk[kind][step] for kind in kinds[at : at + PORTION]]))
    ends = np.frombuffer(b"".join(walked), np.uint8).astype(np.int64)
    # a character takes 1 to PERIOD steps; bytes only tell them modulo PERIOD
    taken = (np.diff(ends, prepend=0) - 1) % PERIOD + 1
    ends = np.cumsum(taken)
    steps = int(ends[-1])
    level = max(0, (steps // SAMPLES).bit_length() - 1)
    stretches = -(-steps >> level)
    at = _sampled(level, 2 * SAMPLES)[:stretches] if stretches <= 2 * SAMPLES else _sampled(level, stretches)
    where = np.searchsorted(ends, at, side="right")
    inside = where < len(points)
    where = where[inside]
    seen = np.zeros(len(where), np.uint64)
    for i in range(WINDOW):
        seen = _hash(seen * np.uint64(31) + points[np.minimum(where + i, len(points) - 1)])
    digits = np.zeros(stretches, np.uint8)
    digits[inside] = seen % np.uint64(15) + np.uint64(1)
    return f"{level:02x}" + "".join(map("0123456789abcdef".__getitem__, digits.tolist()))


def _coarser(level: int, digits: bytes) -> bytes:
    """The samples of the next level."""
    n = (len(digits) + 1) // 2
    at = 2 * np.arange(n) + (_hash(np.arange(n) * 64 + level + 1) & np.uint64(1)).astype(np.int64)
    values = np.frombuffer(digits + b"0", np.uint8)
    return values[at].tobytes()


def likeness(a: str, b: str) -> float:
    """Share of equal samples of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    (x, p), (y, q) = ((int(f[:2], 16), f[2:].encode()) for f in (a, b))
    if not p or not q:
        return 0.0
    while x < y:
        x, p = x + 1, _coarser(x, p)
    while y < x:
        y, q = y + 1, _coarser(y, q)
    n = min(len(p), len(q))
    left, right = (np.frombuffer(f[:n], np.uint8) for f in (p, q))
    return float((left == right).sum() / max(len(p), len(q)))


def fingerprints(text: Column) -> Column:
    @F.arrow_udf("string")
    def printed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x) for x in texts.to_pylist()], pa.string())

    return printed(text)


def likenesses(a: Column, b: Column) -> Column:
    @F.arrow_udf("double")
    def liked(a: pa.Array, b: pa.Array) -> pa.Array:
        both = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([None if x is None or y is None else likeness(x, y) for x, y in both], pa.float64())

    return liked(a, b)


@lru_cache(maxsize=64)
def _orders(level: int) -> np.ndarray:
    """For each band an order of the places that samples of a level may have, the same for all texts."""
    places = 2 * SAMPLES
    return np.argsort(_hash(np.arange(BANDS * places) + 1000003 * level).reshape(BANDS, places), axis=1)


def bands(print_: str) -> list[int]:
    """Keys of the bands of a fingerprint, on its own level and the next one.

    A band has the first places of its order that a text has samples for, so texts of
    different numbers of samples mostly choose the same ones, also where one's own level
    is the next one of the other.
    """
    level, digits = int(print_[:2], 16), print_[2:].encode()
    keys = []
    for up in (level, level + 1):
        if not digits:
            break
        values = np.frombuffer(digits, np.uint8)
        for n, order in enumerate(_orders(up)):
            band = values[order[order < len(values)][:BAND]]
            key = hashlib.blake2b(bytes((up, n)) + band.tobytes(), digest_size=8).digest()
            keys.append(int.from_bytes(key, "little", signed=True))
        digits = _coarser(up, digits)
    return keys


def _compare_members(least: float):
    """For ``mapInArrow`` over (key, piece, node, fingerprint) sorted by key and piece: edges of verified stars."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, run in groupby(rows, key=lambda row: row[:2]):
            prints = {node: print_ for _, _, node, print_ in run}

            def near(others: np.ndarray, node: int) -> np.ndarray:
                own = prints[int(node)]
                return np.fromiter((likeness(prints[x], own) >= least for x in others.tolist()), bool, len(others))

            a, b = linking._stars(np.array(sorted(prints), np.int64), near)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return link


def links(nodes: DataFrame, space: Workspace, least: float = 0.8) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints at least ``least`` alike that share a band.

    ``nodes`` is a written table (node, fingerprint). Only short keys are shuffled to find bands. Every
    member of a band is compared with the smallest one, and a band whose members are all near it is done,
    at a row a member. All members of any other band are compared by blocks, a task holding two of them.
    """

    @F.arrow_udf("array<long>")
    def keys(values: pa.Array) -> pa.Array:
        return pa.array([bands(x) for x in values.to_pylist()], pa.list_(pa.int64()))

    entries = space.keep(nodes.select(F.explode(keys("fingerprint")).alias("key"), "node"), "entries")
    # written, so that a hot band is split over the tasks of the join
    hubs = space.keep(
        entries.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).filter("members > 1"), "hubs"
    )
    spokes = entries.join(hubs, "key").filter("node <> hub")
    prints = nodes.select("node", "fingerprint")
    pairs = (
        spokes.select("node", "hub")
        .distinct()
        .join(prints, "node")
        .join(prints.select(F.col("node").alias("hub"), F.col("fingerprint").alias("other")), "hub")
        .select("node", "hub", (likenesses(F.col("fingerprint"), F.col("other")) >= least).alias("near"))
    )
    pairs = space.keep(pairs, "pairs")
    edges = pairs.filter("near").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    apart = spokes.join(pairs.filter("not near"), ["node", "hub"], "left_semi").select("key").distinct()
    blocks = F.ceil(F.col("members") / linking.BLOCK).cast("int").alias("blocks")
    open_bands = space.keep(hubs.join(apart, "key", "left_semi").select("key", blocks), "open-bands")
    if open_bands.isEmpty():
        return edges
    members = entries.join(open_bands, "key", "left_semi")
    pieces = linking.split_large_keys(members, open_bands.filter("blocks > 1"))
    compared = (
        pieces.join(prints, "node")
        .select("key", "piece", "node", "fingerprint")
        .repartition("key", "piece")
        .sortWithinPartitions("key", "piece")
        .mapInArrow(_compare_members(least), linking.EDGES)
    )
    return edges.unionByName(compared)


def classes(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, fingerprint, class_id) of every row: texts reachable over likenesses of at least ``least``.

    class_id is the smallest doc_id of the class. Copies share a fingerprint and are never paired.
    """
    space = Workspace(docs.sparkSession, "edit-classes")
    rows = space.keep(docs.select(F.col("doc_id").cast("long"), fingerprints(F.col("text")).alias("fingerprint")), "rows")
    distinct = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    nodes = space.keep(distinct.select(F.xxhash64("fingerprint").alias("node"), "fingerprint", "least"), "nodes")
    roots = space.keep(linking.components(links(nodes, space, least), space), "roots")
    # written, so that joins with the one root of a large class or one repeated text can be split
    named = space.keep(roots.join(nodes, "node").groupBy("root").agg(F.min("least").alias("class_id")), "named")
    joined = roots.join(named, "root").select("node", "class_id")
    of_nodes = space.keep(
        nodes.join(joined, "node", "left").select("node", F.coalesce("class_id", "least").alias("class_id")), "classes"
    )
    return (
        rows.withColumn("node", F.xxhash64("fingerprint"))
        .join(of_nodes, "node")
        .select("doc_id", "fingerprint", "class_id")
    )


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over stretches of documents in order, each closed by a copy of the next one's first."""
    before = None
    for batch in batches:
        rows = []
        for part, borrowed, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            if before and before[0] == part and not before[1]:
                _, _, own_id, own, own_print = before
                own_print = own_print or fingerprint(own)
                k = len(own) // 3
                edited = own[: len(own) - k] + text[:k]
                following = own_print if text == own else fingerprint(text)
                changed = own_print if edited == own else fingerprint(edited)
                sha = hashlib.sha256(edited.encode()).hexdigest()
                rows.append(
                    (own_id, len(own), sha, own_print, changed, likeness(own_print, changed), likeness(own_print, following))
                )
                before = part, borrowed, doc_id, text, following
            else:
                before = part, borrowed, doc_id, text, None
        if rows:
            kinds = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=[c.split()[0] for c in COMPARED.split(", ")],
            )


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit by the next document, and their likeness.

    The next document is the one with the next smaller doc_id (ties: the next text), after
    the last one the first; rows without doc_id come last. The edit replaces the last third
    of a text by the beginning of the next one. Documents are cut into stretches of ids,
    each with a copy of the row that follows it, so no task sees more than a few stretches.
    """
    spark = docs.sparkSession
    last = -(2**63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    stretches = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("double").alias("at")).filter("at is not null")
    cuts = ids.approxQuantile("at", [i / stretches for i in range(1, stretches)], 0.2 / stretches)
    # doubles may merge neighbouring ids but keep their order, which is all that is needed
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="at", outputCol="stretch").transform

    def parted(df: DataFrame) -> DataFrame:
        at = F.col("key").cast("double").alias("at")
        return cut(df.select("*", at)).withColumn("stretch", F.col("stretch").cast("int")).drop("at")

    # one row a stretch: its first document, which the stretch above needs as well
    firsts = parted(rows.select("key")).groupBy("stretch").agg(F.max("key").alias("key")).orderBy("stretch").collect()
    above = {r.key: firsts[(i + 1) % len(firsts)].stretch for i, r in enumerate(firsts)}
    borrow = spark.createDataFrame(list(above.items()), "key long, borrower int")
    own = F.struct("stretch", F.lit(False).alias("borrowed"))
    lent = F.struct(F.col("borrower").alias("stretch"), F.lit(True).alias("borrowed"))
    # the table has one row a stretch
    dealt = (
        parted(rows)
        .join(F.broadcast(borrow), "key", "left")
        .withColumn("to", F.explode(F.when(F.col("borrower").isNull(), F.array(own)).otherwise(F.array(own, lent))))
        .select("to.stretch", "to.borrowed", "key", "text")
    )
    found = (
        dealt.repartition("stretch")
        .sortWithinPartitions("stretch", "borrowed", F.desc("key"), "text")
        .mapInArrow(_compare, COMPARED)
    )
    return found.withColumn("doc_id", F.when(F.col("doc_id") != last, F.col("doc_id")))
