"""The best documents for each query, by Block-Max MaxScore over a sharded index.

The index is built where the documents are: a portion of them is a shard, numbered from 0,
with a list of postings (document, times) per term. A list is cut into blocks of 128
postings, packed as variable-length numbers; outside the packing stand the last document
and the largest impact of each block, and the largest of the list.

    impact = (10^9 * times) div (1000 * times + 20 * m),  m = 50 + (50 * n * N) div L

N counts the documents with a term, L all terms, n those of the document. A term weighs
w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and a document's score sums w * impact over a
query's terms, all in 64-bit whole numbers but the logarithm.

Queries meet the lists of their terms by an equality join, and a task goes through its
shards one after the other with a heap for each query. The lists whose bounds together
stay below the heap's least score cannot lift a document into it: they are non-essential.
Candidates come from the essential lists alone; in the others a candidate is looked up,
largest bound first, and refused by the block's maximum before the block is unpacked.
The heaps of all tasks are merged at the end. Queries go in blocks, which bound what a
task holds besides a shard.

Defined results: terms are those of ``terms.WORDS``; a null or empty text has none and its
document is not counted; a query without terms finds nothing; rows of one query id are one
query with the terms of all of them; queries without id are left out; documents without
id are counted and not returned; rows that repeat a doc_id are documents of their own.
Equal scores are ranked by doc_id. Texts of any length are whole; one that is larger than
a portion is a shard. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.tables import Workspace
from tidegauge.llm.terms import WORDS, splitter
from tidegauge.llm.workers import portions, slim

#: Postings of a block.
BLOCK = 128
#: Queries that are searched together.
TOGETHER = 4_096
#: Documents of a shard, unless ``workers.PORTION`` bytes of text are fewer.
SHARD = 8_192

terms = splitter(WORDS)

#: One row a list; the empty term holds a shard's documents, as doc_ids and m, in its two blocks.
LISTS = "shard string, term binary, df long, best long, lasts array<int>, bests array<long>, packed array<binary>"


def impacts(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 20 * m)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in groups of seven bits, the last byte of each below 128; and where each begins."""
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= 1 << 7 * k if 7 * k < 63 else 0
    ends = np.cumsum(sizes)
    begins = ends - sizes
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        more = sizes > k
        out[begins[more] + k] = (values[more] >> 7 * k & 127) | np.where(sizes[more] > k + 1, 128, 0)
    return out, np.append(begins, len(out))


def unpack(data: bytes) -> np.ndarray:
    found = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(found < 128)
    begins = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(found)) - np.repeat(begins, ends - begins + 1)
    return np.add.reduceat((found & 127).astype(np.int64) << 7 * place, begins)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: its documents with terms, and their terms."""
    n_docs = n_terms = 0
    for batch in batches:
        for part in portions(batch, "text", batch.num_rows):
            lengths = [len(terms(t)) for t in part.column("text").to_pylist()]
            n_docs += sum(n > 0 for n in lengths)
            n_terms += sum(lengths)
    yield pa.RecordBatch.from_arrays([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names=["n_docs", "n_terms"])


def _shard(part: pa.RecordBatch, name: str, n_docs: int, n_terms: int) -> pa.RecordBatch:
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    found, lengths = [], []
    for text in part.column("text").to_pylist():
        words = terms(text)
        found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        lengths.append(len(words))
    lengths = np.array(lengths, np.int64)
    m = 50 + 50 * lengths * n_docs // max(n_terms, 1)
    size = max(len(lengths), 1)
    keys = np.concatenate(found) * size + np.repeat(np.arange(len(lengths)), lengths)
    keys, times = np.unique(keys, return_counts=True)
    term, doc = keys // size, keys % size
    impact = impacts(times, m[doc])

    first = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(first, len(term)))
    place = np.arange(len(term)) - np.repeat(first, df)
    begin = np.flatnonzero(place % BLOCK == 0)
    last = np.append(begin, len(term))[1:] - 1
    # a document as its distance from the one before it in the list, the first one from -1
    step = np.diff(doc, prepend=0)
    step[first] = doc[first] + 1
    data, at = pack(np.column_stack((step, times)).ravel())

    # the shard's documents come first, as a list of two blocks
    ids = part.column("doc_id").cast(pa.int64())
    valid = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    named = [ids.fill_null(0).to_numpy().tobytes() + valid.tobytes(), m.tobytes()]
    head = [len(x) for x in named]
    offsets = np.concatenate(([0], np.cumsum(head), sum(head) + at[2 * (last + 1)])).astype(np.int32)
    blocks = np.concatenate(([0, 2], 2 + np.cumsum(-(-df // BLOCK)))).astype(np.int32)
    packed = pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(named) + data.tobytes())]
    )
    rows = len(blocks) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * rows, pa.string()),
            pa.array([b"", *numbers], pa.binary()),
            pa.array(np.concatenate(([0], df))),
            pa.array(np.concatenate(([0], np.maximum.reduceat(impact, first) if len(first) else []))).cast(pa.int64()),
            pa.ListArray.from_arrays(blocks, pa.array(np.concatenate(([0, 0], doc[last])), pa.int32())),
            pa.ListArray.from_arrays(
                blocks, pa.array(np.concatenate(([0, 0], np.maximum.reduceat(impact, begin) if len(begin) else [])), pa.int64())
            ),
            pa.ListArray.from_arrays(blocks, packed),
        ],
        names=["shard", "term", "df", "best", "lasts", "bests", "packed"],
    )


class Index:
    """An index over all documents: ``lists``, a written table, and the corpus numbers."""

    def __init__(self, docs: DataFrame):
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        counted = texts.select("text").mapInArrow(_count, "n_docs long, n_terms long")
        row = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns)).first()
        n_docs, n_terms = self.n_docs, self.n_terms = row.n_docs, row.n_terms

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            number = 0
            for batch in batches:
                for part in portions(batch, "text", SHARD):
                    yield _shard(part, f"{TaskContext.get().partitionId()}-{number}", n_docs, n_terms)
                    number += 1

        space = Workspace(docs.sparkSession, "ranked-search")
        self.lists = space.keep(texts.mapInArrow(lambda b: slim(build(b)), LISTS), "lists")
        self.space = space


class _List:
    """A list of postings, unpacked block by block; what is not unpacked is filled with last documents."""

    def __init__(self, best: int, lasts: np.ndarray, bests: np.ndarray, packed: list[bytes], df: int):
        self.best, self.lasts, self.bests, self.packed = best, lasts, bests, packed
        self.open = np.zeros(len(lasts), bool)
        self.docs = np.repeat(lasts, BLOCK)[:df].astype(np.int64)
        self.impacts = np.zeros(df, np.int64)

    def read(self, blocks: np.ndarray, m: np.ndarray) -> None:
        """Unpack those of the blocks that are still packed."""
        for k in blocks[~self.open[blocks]]:
            pairs = unpack(self.packed[k])
            docs = np.cumsum(pairs[::2]) + (self.lasts[k - 1] if k else -1)
            at = slice(k * BLOCK, k * BLOCK + len(docs))
            self.docs[at], self.impacts[at] = docs, impacts(pairs[1::2], m[docs])
            self.open[k] = True


class _Heap:
    """The best documents of a query so far, in order."""

    __slots__ = ("scores", "docs", "size")

    def __init__(self, size: int):
        self.size = size
        self.scores, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """What a document has to reach, 0 while there is room."""
        return int(self.scores[-1]) if len(self.scores) == self.size else 0

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate((self.scores, scores)), np.concatenate((self.docs, docs))
        order = np.lexsort((docs, -scores))[: self.size]
        self.scores, self.docs = scores[order], docs[order]


def best_of_shard(lists: list[tuple[int, _List]], m: np.ndarray, named: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of all that reach ``least``; ``lists`` has (weight, list) for each term.

    ``named`` tells which documents may be returned.
    """
    lists = sorted(lists, key=lambda x: x[0] * x[1].best)
    bounds = np.cumsum([w * x.best for w, x in lists])
    cut = int(np.searchsorted(bounds, least))
    total = np.zeros(len(m), np.int64)
    for w, x in lists[cut:]:
        x.read(np.arange(len(x.lasts)), m)
        total[x.docs] += w * x.impacts
    docs = np.flatnonzero((total > 0) & named)
    scores = total[docs]
    for k in reversed(range(cut)):
        w, x = lists[k]
        below = int(bounds[k - 1]) if k else 0
        alive = scores + int(bounds[k]) >= least
        docs, scores = docs[alive], scores[alive]
        block = np.searchsorted(x.lasts, docs)
        inside = block < len(x.lasts)
        most = np.zeros(len(docs), np.int64)
        most[inside] = w * x.bests[block[inside]]
        alive = scores + most + below >= least
        docs, scores, block, inside = docs[alive], scores[alive], block[alive], inside[alive]
        if inside.any():
            x.read(np.unique(block[inside]), m)
            at = np.searchsorted(x.docs, docs[inside])
            scores[inside] += np.where(x.docs[at] == docs[inside], w * x.impacts[at], 0)
    alive = scores >= max(least, 1)
    return docs[alive], scores[alive]


def _search(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over lists with their queries, sorted by block of queries and shard."""
    heaps: dict[int, _Heap] = {}
    held: list[dict] = []
    at = None

    def search():
        documents = next(r for r in held if not r["term"])
        m = np.frombuffer(documents["packed"][1], np.int64)
        ids = np.frombuffer(documents["packed"][0], np.int64, len(m))
        named = np.frombuffer(documents["packed"][0], np.uint8, offset=8 * len(m)).astype(bool)
        wanted = defaultdict(list)
        for r in held:
            if r["term"]:
                lasts, bests = np.array(r["lasts"], np.int64), np.array(r["bests"], np.int64)
                one = r["w"], _List(r["best"], lasts, bests, r["packed"], r["df"])
                for query in r["queries"]:
                    wanted[query].append(one)
        for query, lists in wanted.items():
            heap = heaps.setdefault(query, _Heap(top))
            docs, scores = best_of_shard(lists, m, named, heap.least())
            heap.add(scores, ids[docs])

    def flushed():
        queries = np.repeat(np.fromiter(heaps, np.int64, len(heaps)), [len(h.docs) for h in heaps.values()])
        docs, scores = (np.concatenate([getattr(h, c) for h in heaps.values()] or [np.zeros(0, np.int64)]) for c in ("docs", "scores"))
        heaps.clear()
        return pa.RecordBatch.from_arrays([pa.array(queries), pa.array(docs), pa.array(scores)], names=["item_id", "doc_id", "score"])

    for batch in batches:
        for r in batch.to_pylist():
            if at is not None and at != (r["part"], r["shard"]):
                search()
                held.clear()
                if at[0] != r["part"]:
                    yield flushed()
            at = r["part"], r["shard"]
            held.append(r)
    if held:
        search()
        yield flushed()


def best_documents(index: Index, queries: DataFrame, top: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` documents of each query; ``queries`` has item_id and text."""
    spark = queries.sparkSession

    def split(batches):
        for batch in batches:
            for part in portions(batch, "text", 1024):
                found = [sorted(set(terms(t))) for t in part.column("text").to_pylist()]
                ids = np.repeat(part.column("item_id").to_numpy(zero_copy_only=False), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([t for f in found for t in f], pa.binary())], names=["item_id", "term"]
                )

    asked = index.space.keep(
        queries.filter("item_id is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(split, "item_id long, term binary")
        .distinct(),
        "asked",
    )
    parts = max(1, -(-asked.select("item_id").distinct().count() // TOGETHER))
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int")
    df = (
        index.lists.select("term", "df")
        .join(asked.select("term").distinct(), "term")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1)))
    by_term = (
        asked.join(df, "term")
        .groupBy("term", part.alias("part"))
        .agg(F.any_value(weight).alias("w"), F.sort_array(F.collect_list("item_id")).alias("queries"))
    )
    # the shards' documents go wherever their lists go
    documents = spark.range(parts).select(
        F.lit(b"").alias("term"), F.col("id").cast("int").alias("part"), F.lit(0).cast("long").alias("w"),
        F.array().cast("array<long>").alias("queries"),
    )
    wanted = index.space.keep(by_term.unionByName(documents), f"wanted-{top}")
    found = (
        index.lists.join(wanted, "term")
        .repartition("part", "shard")
        .sortWithinPartitions("part", "shard")
        .mapInArrow(lambda b: slim(_search(b, top)), "item_id long, doc_id long, score long")
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )
