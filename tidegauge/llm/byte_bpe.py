"""Byte-level BPE over whole texts, long ones in overlapping chunks.

A long text is cut into chunks that overlap. Every chunk is split into pre-tokens on
its own; the pattern looks only ahead, so two scans that once agree on a boundary
agree from there on. Neighbouring chunks are stitched at the first boundary both have
in their overlap, and each chunk then encodes the pieces between its two stitches. A
text whose chunks do not agree within some overlap (a run longer than it) is encoded
as one chunk. Decoding concatenates the bytes of the ids.

Defined results: a null or empty text has no ids; equal texts have equal ids; special
tokens are ordinary text; ids outside the vocabulary cannot be decoded and raise; repeated
rows each get their ids. Other columns are kept, ``ids`` is replaced. An empty table gives
no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace, named
from tidegauge.llm.workers import once_per_worker, slim

#: Code points of a chunk, and of what it shares with the next one.
CHUNK = 32_768
OVERLAP = 512
#: Fixed value: the usual pattern of byte-level BPE, which the standard library can express for plain texts.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
USUAL_PLAIN = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
#: A character on which the two might differ: anything but ASCII, Latin letters and their punctuation.
NOT_PLAIN = re.compile(r"[^\t\n\r -~\u00a1-\u00ac\u00ae\u00af\u00b0\u00b4\u00b6-\u00b8\u00bb\u00bf-\u024f]")
#: Pieces a worker remembers; beyond that it starts anew.
REMEMBERED = 120_000
#: Texts whose ids a worker holds at a time.
TOGETHER = 512


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks and pattern, shared with all workers; bounded by the rank file's size."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.key, self.pattern = (path, pattern), pattern
        self.shared = spark.sparkContext.broadcast(read_ranks(path))

    def pieces(self) -> _Pieces:
        return once_per_worker("byte_bpe pieces", self.key, lambda: _Pieces(self.shared.value, self.pattern))

    def tokens(self) -> dict[int, bytes]:
        return once_per_worker(
            "byte_bpe tokens", self.key, lambda: {rank: token for token, rank in self.shared.value.items()}
        )


class _Pieces(dict):
    """Ids of pieces as packed 32-bit integers, remembered up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = np.array(self.encoding._encode_single_piece(piece), np.int32).tobytes()
        self[piece] = ids
        return ids


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a whole text. The standard library's matcher is twice as fast where it gives the same."""
    split = regex.compile(pattern).findall
    if pattern != USUAL:
        return split
    plain, odd = USUAL_PLAIN.findall, NOT_PLAIN.search
    return lambda text: split(text) if odd(text) else plain(text)


def _id_lists(packed: list[bytes]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed], dtype=np.int64)))
    values = pa.array(np.frombuffer(b"".join(packed), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _encode_texts(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split = splitter(vocabulary.pattern)
        ids = vocabulary.pieces().__getitem__
        for texts in slim(batches):
            for at in range(0, len(texts), TOGETHER):
                some = texts.slice(at, TOGETHER).to_pylist()
                yield _id_lists([b"".join(map(ids, split(x))) if x else b"" for x in some])

    return encode


def _chunks(size: int, overlap: int) -> Callable:
    """For ``mapInArrow``: (key, text) to (key, number, chunks, text) of every chunk."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                starts = range(0, len(text), size)
                for some in range(0, len(starts), 64):
                    part = starts[some : some + 64]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": [key] * len(part),
                            "number": pa.array(range(some, some + len(part)), pa.int32()),
                            "chunks": pa.array([len(starts)] * len(part), pa.int32()),
                            "text": [text[a : a + size + overlap] for a in part],
                        }
                    )

    return cut


def boundaries(pattern: regex.Pattern, text: str, size: int, overlap: int, last: bool) -> tuple[list[int], list[int]]:
    """(head, tail): where pre-tokens begin in the first and the last overlap of a chunk.

    Offsets count from the beginning of the overlap. A match that touches the end of a
    chunk where the text goes on might have been another one in the whole text, so
    neither it nor what follows counts.
    """
    goes_on = not last and len(text) == size + overlap
    head, tail = [0], []
    for match in pattern.finditer(text):
        end = match.end()
        if end == len(text) and goes_on:
            break
        if end <= overlap:
            head.append(end)
        if end >= size:
            tail.append(end - size)
    return head, tail


def _pretokenise(vocabulary: Vocabulary, size: int, overlap: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(vocabulary.pattern)
        for batch in slim(batches):
            number, chunks = batch.column("number").to_pylist(), batch.column("chunks").to_pylist()
            found = [
                boundaries(pattern, text, size, overlap, n + 1 == of)
                for text, n, of in zip(batch.column("text").to_pylist(), number, chunks, strict=True)
            ]
            head, tail = zip(*found, strict=True) if found else ((), ())
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("number"), pa.array(head, kind), pa.array(tail, kind)],
                names=["key", "number", "head", "tail"],
            )

    return scan


def _encode_chunks(vocabulary: Vocabulary, size: int) -> Callable:
    """Pieces of a chunk from its own stitch on to that of the next one."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(vocabulary.pattern)
        ids = vocabulary.pieces().__getitem__
        for batch in slim(batches):
            packed = []
            columns = (batch.column(c).to_pylist() for c in ("text", "begin", "until"))
            for text, begin, until in zip(*columns, strict=True):
                stop = len(text) if until is None else size + until
                own = []
                for match in pattern.finditer(text, begin):
                    if match.start() >= stop:
                        break
                    own.append(match.group())
                packed.append(b"".join(map(ids, own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("number"), _id_lists(packed)], names=["key", "number", "ids"]
            )

    return encode


def _long_texts(texts: DataFrame, vocabulary: Vocabulary, size: int, overlap: int) -> DataFrame:
    """(key, ids) of the distinct ``texts`` (key, text) whose chunks could be stitched."""
    # chunks of one text are dealt to different tasks; equal texts are cut once
    distinct = texts.groupBy("key").agg(F.any_value("text").alias("text"))
    chunks = distinct.mapInArrow(
        _chunks(size, overlap), "key string, number int, chunks int, text string"
    ).repartition("key", "number")
    scanned = chunks.mapInArrow(
        _pretokenise(vocabulary, size, overlap), "key string, number int, head array<int>, tail array<int>"
    )
    ordered = Window.partitionBy("key").orderBy("number")
    meets = F.array_min(F.array_intersect("head", F.lag("tail").over(ordered)))
    stitched = (
        scanned.withColumn("begin", F.when(F.col("number") == 0, 0).otherwise(meets))
        .withColumn("until", F.lead("begin").over(ordered))
        .withColumn("whole", F.min(F.col("begin").isNotNull()).over(Window.partitionBy("key")))
        .filter("whole")
        .select("key", "number", "begin", "until")
    )
    encoded = (
        chunks.join(stitched, ["key", "number"])
        .select("key", "number", "text", "begin", "until")
        .mapInArrow(_encode_chunks(vocabulary, size), "key string, number int, ids array<int>")
    )
    parts = F.array_sort(F.collect_list(F.struct("number", "ids")))
    return encoded.groupBy("key").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def encode(
    docs: DataFrame, vocabulary: Vocabulary, size: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``docs`` with the ids of ``text`` in a column ``ids``."""
    whole = _encode_texts(vocabulary)
    columns = named([c for c in docs.columns if c != "ids"])
    is_long = F.coalesce(F.char_length("text") > size, F.lit(False))
    short = docs.filter(~is_long).select(*columns, whole(F.col("text")).alias("ids"))
    long = docs.filter(is_long).select(
        F.struct(*columns).alias("row"), "text", F.sha2(F.col("text").cast("binary"), 256).alias("key")
    )
    # written, so that the join with the one key of a text that has many copies can be split
    space = Workspace(docs.sparkSession, "byte-bpe")
    stitched = space.keep(_long_texts(long.select("key", "text"), vocabulary, size, overlap), "long-texts")
    joined = long.join(stitched, "key", "left").select(
        "row.*", F.coalesce("ids", whole(F.when(F.col("ids").isNull(), F.col("text")))).alias("ids")
    )
    return short.unionByName(joined)


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of a list of ids; null for null."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = vocabulary.tokens().__getitem__
        for lists in slim(batches):
            ids = lists.values.to_numpy(zero_copy_only=False)
            ends, known = lists.offsets.to_pylist(), lists.is_valid().to_pylist()
            for at in range(0, len(known), TOGETHER):
                some = slice(at, at + TOGETHER)
                yield pa.array(
                    [
                        b"".join(map(token, ids[a:b].tolist())) if valid else None
                        for a, b, valid in zip(ends[some], ends[at + 1 :], known[some], strict=False)
                    ],
                    pa.binary(),
                )

    return decoded(ids)
