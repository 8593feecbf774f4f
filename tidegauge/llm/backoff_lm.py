"""Stupid-backoff scores of documents, computed from count tables.

Every word has a count of its own. The most frequent words have ids, whose counts are
broadcast; any other word is known by a 64-bit hash, and its count stays in a table that
grows with the corpus. Every document's bigrams are dealt to buckets by a hash; a bucket
holds all occurrences of its bigrams, so its count table and the join with the documents'
bigrams take one shuffle. The sums go back packed, a portion of documents at a time, and
are added up there; where a score needs the count of a word without id, the document's
(word, times) is joined to the table of counts. Bigrams of two very frequent words, and any
other one that stands ``HOT`` times or more, are counted ahead in small tables that are
broadcast and come to no bucket, so a bucket's size does not grow with the corpus.
With a ``vocabulary_size`` the model is closed: words without id are one unknown word.

The score of a word w after c is others(c w) / count(c), where ``others`` leaves out
the document's own occurrences, so that a text is judged by all the others; where no
other document has the bigram it is ``BACKOFF`` * count(w) / words. The first word
follows a marker that begins every document.

Defined results: words are lower-cased runs of non-white-space; a document without
words has 0 words and a null score; rows of one doc_id are added up, each leaving out
its own occurrences; rows without doc_id are counted and not scored. Long texts are read whole,
though the bigrams of one text are found together. Equally frequent words all have ids or
none. Other columns are ignored. An empty table gives no rows.

``backoff_relational`` has the same scores, and those of orders 1 and 3, from count tables
that Spark joins to exploded n-grams, a row for each document and n-gram.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace
from tidegauge.llm.workers import portions

BACKOFF = 0.4
#: Words with an id, whose counts are broadcast; with their counts this is about a megabyte.
VOCABULARY = 65_535
#: The most frequent ids, whose bigrams are counted ahead: any other bigram makes up less than 1 in 512.
FREQUENT = 512
#: Bigrams a bucket holds on average.
BUCKET = 2_000_000
#: Occurrences from which any bigram is counted ahead; there are at most words / ``HOT`` such bigrams.
HOT = 8_000_000
#: Distinct words a task counts before it hands them on.
COUNTED = 500_000
#: Documents whose bigrams travel together.
TOGETHER = 2_048
#: What stands for the number of documents among the word counts; no word is empty.
DOCUMENTS = ""
MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n), counted ahead of the shuffle."""
    counts: Counter[str] = Counter()

    def counted():
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if found := words(text):
                counts[DOCUMENTS] += 1
                counts.update(found)
            if len(counts) > COUNTED:
                yield counted()
                counts.clear()
    if counts:
        yield counted()


def vocabulary(counts: DataFrame, size: int) -> dict[str, tuple[int, int]]:
    """word to (id, count) of all words at least as frequent as some threshold, at most ``size``.

    The threshold comes from a histogram of counts, so that the driver only sees that
    and the vocabulary. Ids begin at 1; 0 is the unknown word.
    """
    counts = counts.filter(F.col("word") != DOCUMENTS)
    step = F.floor(F.log2("n") * 32).cast("int")
    histogram = counts.groupBy(step.alias("step")).count().collect()
    steps = sorted(((r["step"], r["count"]) for r in histogram), reverse=True)
    least, room = None, size
    for s, n in steps:
        if n > room:
            break
        least, room = s, room - n
    if least is None:
        return {}
    rows = counts.filter(step >= least).collect()
    return {r.word: (i, r.n) for i, r in enumerate(sorted(rows, key=lambda r: (-r.n, r.word)), 1)}



def hashed(word: str) -> int:
    """What stands for a word without id: 63 bits of a hash, and always negative."""
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little") % 2**63 - 2**63


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: (word, n) with the word's hash in its place."""
    for batch in batches:
        found = pa.array([hashed(w) for w in batch.column(0).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([found, batch.column(1)], names=["word", "n"])


class Model:
    """What all tasks share of the counts: the vocabulary and the frequent bigrams."""

    def __init__(self, ids: dict[str, int], counts: np.ndarray, closed: bool):
        self.key = uuid.uuid4().hex
        self.ids = ids
        #: whether words without id are one unknown word
        self.closed = closed
        #: count of each id; 0 is the unknown word, the last one begins documents
        self.counts = counts
        self.start = len(counts) - 1
        self.words = int(counts[:-1].sum())
        self.size = FREQUENT
        self.frequent: np.ndarray | None = None
        self.often = HOT
        #: other bigrams that are counted ahead, sorted, and their counts
        self.hot = self.hot_counts = np.zeros(0, np.int64)

    def is_frequent(self, numbers: np.ndarray) -> np.ndarray:
        """Ids follow the frequency of words, so the frequent ones are the smallest; hashes are negative."""
        return ((numbers >= 0) & (numbers < self.size - 1)) | (numbers == self.start)

    def dense(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Place of a bigram of two frequent ids in the table, -1 for others."""
        both = self.is_frequent(first) & self.is_frequent(second)
        return np.where(both, np.minimum(first, self.size - 1) * self.size + np.minimum(second, self.size - 1), -1)

    def pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first * len(self.counts) + second

    def may_be_hot(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """A bigram stands no more often than either word."""
        often = self.counts >= self.often
        both = (first >= 0) & (second >= 0) & (self.dense(first, second) < 0)
        return both & often[np.maximum(first, 0)] & often[np.maximum(second, 0)]

    def ahead(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of the bigrams that are counted ahead, -1 for others."""
        place = self.dense(first, second)
        n = np.where(place >= 0, self.frequent[place], -1)
        if len(self.hot):
            pair = self.pair(first, second)
            at = np.minimum(np.searchsorted(self.hot, pair), len(self.hot) - 1)
            n = np.where((self.hot[at] == pair) & (first >= 0) & (second >= 0), self.hot_counts[at], n)
        return n

    def number(self, word: str) -> int:
        found = self.ids.get(word)
        return found if found is not None else 0 if self.closed else hashed(word)

    def bigrams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first, second, times) of some texts, each bigram of a row once, by row."""
        found = [words(x) for x in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        # words are told apart by their place among those of these texts, 0 begins a document
        places: dict[str, int] = defaultdict(count(1).__next__)
        ids = np.fromiter(map(places.__getitem__, chain.from_iterable(found)), np.int64, int(lengths.sum()))
        numbers = np.fromiter((self.start, *map(self.number, places)), np.int64, len(places) + 1)
        row = np.repeat(np.arange(len(found)), lengths)
        before = np.concatenate(([0], ids[:-1])) if len(ids) else ids
        before[np.flatnonzero(np.diff(row, prepend=-1))] = 0
        if self.closed:  # several words may be the unknown one
            merged, at = np.unique(numbers, return_inverse=True)
            numbers, ids, before = merged, at[ids], at[before]
        # a single long text may have many words, so row and both places must not be packed blindly
        bits = len(numbers).bit_length()
        if len(found).bit_length() + 2 * bits < 64:
            both, times = np.unique(row << 2 * bits | before << bits | ids, return_counts=True)
            which = (1 << bits) - 1
            return both >> 2 * bits, numbers[both >> bits & which], numbers[both & which], times
        both, times = np.unique(np.stack((row, before, ids)), axis=1, return_counts=True)
        return both[0], numbers[both[1]], numbers[both[2]], times

    def frequent_bigrams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(first, second) of every bigram in turn; words without id are the unknown word or -1."""
        found = [words(x) for x in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = map(self.ids.get, chain.from_iterable(found), repeat(0 if self.closed else -1))
        second = np.fromiter(ids, np.int64, int(lengths.sum()))
        first = np.concatenate(([self.start], second[:-1])) if len(second) else second
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = self.start
        return first, second

    def log_scores(self, first: np.ndarray, second: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logarithms of the scores, the word whose count they need and the sign of its logarithm.

        They lack the logarithm of that count if the word is a hash.
        """
        seen = others > 0
        needed, sign = np.where(seen, first, second), np.where(seen, -1, 1)
        counts = np.where(needed >= 0, self.counts[np.maximum(needed, 0)], 1)
        return np.log(np.where(seen, others, BACKOFF / self.words)) + sign * np.log(counts), needed, sign


def packed(numbers: np.ndarray) -> bytes:
    """Compressed: the first bytes of all numbers, then their second ones, and so on, as most numbers are small."""
    turned = np.ascontiguousarray(numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(turned.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    turned = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(turned.T).view(np.int64).ravel()


def _count_frequent(shared) -> Callable:
    """For ``mapInArrow``: (pair, n) of bigrams of frequent words, one table a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = np.zeros(model.size**2, np.int64)
        for batch in batches:
            for some in portions(batch, "text", TOGETHER):
                place = model.dense(*model.frequent_bigrams(some.column("text").to_pylist()))
                table += np.bincount(place[place >= 0], minlength=len(table))
        pair = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(table[pair])], names=["pair", "n"])

    return count


def _count_hot(shared) -> Callable:
    """For ``mapInArrow``: (pair, n) of bigrams of words that are frequent enough, by portions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for some in portions(batch, "text", TOGETHER):
                first, second = model.frequent_bigrams(some.column("text").to_pylist())
                hot = model.may_be_hot(first, second)
                pair, n = np.unique(model.pair(first[hot], second[hot]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return count


def _deal(shared, buckets: int) -> Callable:
    """For ``mapInArrow``: (doc_id, text) to rows of many documents' bigrams of one bucket.

    Such a row has the documents, the number of bigrams of each, and the two words of the
    bigrams and their number of times. Frequent bigrams are scored at once; their sums
    travel in rows of their own.
    """

    def rows(model: Model, docs: list, texts: list) -> Iterator[tuple]:
        ids = np.array(docs, np.int64)
        row, first, second, times = model.bigrams(texts)
        ahead = model.ahead(first, second)
        ready = ahead >= 0
        if ready.any():
            own = times[ready]
            logs = own * model.log_scores(first[ready], second[ready], ahead[ready] - own)[0]
            sums, n = (np.bincount(row[ready], x, len(docs)) for x in (logs, own))
            some = np.flatnonzero(n)
            yield int(ids[some[0]] % buckets), ids[some], n[some].astype(np.int32), None, None, None, sums[some]
        row, first, second, times = (x[~ready] for x in (row, first, second, times))
        mixed = (first.astype(np.uint64) * MIX ^ second.astype(np.uint64)) * MIX >> np.uint64(33)
        bucket = (mixed % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by])) + 1
        for part in np.split(by, cuts) if len(by) else []:
            which, sizes = np.unique(row[part], return_counts=True)
            entries = packed(first[part]), packed(second[part]), packed(times[part])
            yield int(bucket[part[0]]), ids[which], sizes.astype(np.int32), *entries, None

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        # a repeated task reads the same rows and numbers its portions alike
        portion = TaskContext.get().partitionId() << 32
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 3, pa.list_(pa.float64()))
        for batch in batches:
            for some in portions(batch, "text", TOGETHER):
                found = rows(model, some.column(0).to_pylist(), some.column(1).to_pylist())
                dealt = [(bucket, portion, *rest) for bucket, *rest in found]
                portion += 1
                if dealt:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, kind) for x, kind in zip(zip(*dealt, strict=True), kinds, strict=True)],
                        names=["bucket", "portion", "docs", "sizes", "first", "second", "times", "sums"],
                    )

    return deal


DEALT = "bucket int, portion long, docs array<long>, sizes array<int>, first binary, second binary, times binary, sums array<double>"
#: ``of`` has the documents that need the logarithm of the count of ``word`` so many ``signed`` times.
SCORED = (
    "portion long, docs array<long>, times array<long>, sums array<double>, "
    "of array<long>, word array<long>, signed array<long>"
)
SUMS = "doc_id long, log_score double, n_words long"


def _score(shared) -> Callable:
    """For ``mapInArrow`` over dealt rows sorted by bucket: sums per document, for each dealt row."""

    def scored(model: Model, held: list) -> Iterator[tuple]:
        lengths = [int(sizes.sum()) for _, _, sizes, _ in held]
        first, second, times = (
            np.concatenate([unpacked(entries[i], n) for (*_, entries), n in zip(held, lengths, strict=True)]) for i in range(3)
        )
        order = np.lexsort((second, first))
        new = np.ones(len(order), bool)
        new[1:] = np.diff(first[order]) != 0
        new[1:] |= np.diff(second[order]) != 0
        others = np.empty(len(order), np.int64)
        others[order] = np.add.reduceat(times[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        del order, new
        others -= times
        begin = 0
        for (portion, docs, sizes, _), n in zip(held, lengths, strict=True):
            # the bigrams of a document stand together
            some = slice(begin, begin + n)
            begin += n
            own = times[some]
            logs, needed, sign = model.log_scores(first[some], second[some], others[some])
            starts = np.cumsum(sizes, dtype=np.int64) - sizes
            lacks = needed < 0
            lacking = np.repeat(docs, sizes)[lacks], needed[lacks], (sign * own)[lacks]
            yield portion, docs, np.add.reduceat(own, starts), np.add.reduceat(own * logs, starts), *lacking

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bucket, held = shared.value, None, []
        for batch in batches:
            for row in range(batch.num_rows):
                number, portion, docs, sizes, *entries, sums = (batch.column(c)[row] for c in range(8))
                docs, sizes = (x.values.to_numpy(zero_copy_only=False) for x in (docs, sizes))
                if entries[0].as_py() is None:
                    ready = sums.values.to_numpy(zero_copy_only=False)
                    yield _rows([(portion.as_py(), docs, sizes, ready, [], [], [])])
                    continue
                if number.as_py() != bucket and held:
                    yield _rows(list(scored(model, held)))
                    held = []
                bucket = number.as_py()
                held.append((portion.as_py(), docs, sizes, [x.as_py() for x in entries]))
        if held:
            yield _rows(list(scored(model, held)))

    return score


def _rows(scored: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), *[pa.list_(pa.int64())] * 2, pa.list_(pa.float64()), *[pa.list_(pa.int64())] * 3)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(zip(*scored, strict=True), kinds, strict=True)],
        names=["portion", "docs", "times", "sums", "of", "word", "signed"],
    )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over scored rows sorted by portion: one row per document of a portion.

    A portion gathers no more numbers than its documents have bigrams.
    """
    portion, held = None, []

    def added():
        docs, times, sums = (np.concatenate(x) for x in zip(*held, strict=True))
        which, at = np.unique(docs, return_inverse=True)
        found = np.bincount(at, sums, len(which)), np.bincount(at, times, len(which)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(which), *map(pa.array, found)], names=["doc_id", "log_score", "n_words"])

    for batch in batches:
        for row in range(batch.num_rows):
            number = batch.column(0)[row].as_py()
            if number != portion and held:
                yield added()
                held = []
            portion = number
            held.append(tuple(batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (1, 2, 3)))
    if held:
        yield added()


def scores(docs: DataFrame, vocabulary_size: int | None = None) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every document, by the counts of all of them.

    Every word counts for itself, unless a ``vocabulary_size`` closes the vocabulary.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "backoff-lm")
    texts = docs.select("text")
    counts = space.keep(
        texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    known = vocabulary(counts, VOCABULARY if vocabulary_size is None else vocabulary_size)
    sums = counts.groupBy((F.col("word") == DOCUMENTS).alias("is_documents")).agg(F.sum("n").alias("n")).collect()
    total = {r.is_documents: r.n for r in sums}
    table = np.zeros(len(known) + 2, np.int64)
    for number, n in known.values():
        table[number] = n
    table[0] = total.get(False, 0) - table.sum()
    table[-1] = total.get(True, 0)
    model = Model({word: number for word, (number, _) in known.items()}, table, vocabulary_size is not None)

    frequent = texts.mapInArrow(
        _count_frequent(spark.sparkContext.broadcast(model)), "pair long, n long"
    ).groupBy("pair").agg(F.sum("n").alias("n"))
    # at most FREQUENT squared rows
    model.frequent = np.zeros(FREQUENT * FREQUENT, np.int64)
    for pair, n in frequent.collect():
        model.frequent[pair] = n
    often = np.flatnonzero(table >= HOT)
    if not model.is_frequent(often).all():
        hot = texts.mapInArrow(_count_hot(spark.sparkContext.broadcast(model)), "pair long, n long")
        # at most words / HOT rows
        found = sorted(map(tuple, hot.groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT).collect()))
        model.hot, model.hot_counts = np.array(found, np.int64).reshape(-1, 2).T.copy()
    shared = spark.sparkContext.broadcast(model)

    missing = -(2**63)
    buckets = max(1, model.words // BUCKET)
    dealt = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(missing)).alias("doc_id"), "text").mapInArrow(
        _deal(shared, buckets), DEALT
    )
    scored = space.keep(
        dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_score(shared), SCORED), "scored"
    )
    sums = scored.select("portion", "docs", "times", "sums")
    summed = sums.repartition("portion").sortWithinPartitions("portion").mapInArrow(_add, SUMS)
    # scores that lack the logarithm of a count, and the counts of all words
    lacking = scored.select(F.explode(F.arrays_zip("of", "word", "signed")).alias("x")).select("x.*")
    others = counts.filter(F.col("word") != DOCUMENTS).mapInArrow(_hash_words, "word long, n long")
    added = lacking.join(others, "word").select(
        F.col("of").alias("doc_id"), (F.col("signed") * F.log("n")).alias("log_score"), F.lit(0).cast("long").alias("n_words")
    )
    per_document = summed.unionByName(added).groupBy("doc_id").agg(F.sum("log_score").alias("log_score"), F.sum("n_words").alias("n_words"))
    return (
        docs.filter("doc_id is not null")
        .select(F.col("doc_id").cast("long"))
        .distinct()
        .join(per_document, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("n_words", F.lit(0).cast("long")).alias("n_words"),
            "log_score",
            (F.col("log_score") / F.col("n_words")).alias("mean_log_score"),
        )
    )
