"""Stupid-backoff scores of documents, computed relationally, for orders up to 3.

Documents are exploded to rows (document, n-gram, times). Summed by n-gram these are the
count tables, partitioned by hash; they are joined back to the exploded rows, and the
logarithms are summed per document. Every word has a count of its own: the most frequent
words have ids, whose counts are broadcast, any other word is known by a 64-bit hash, and
the counts of those are one more table to join. With a ``vocabulary_size`` the model is
closed: words without id are one unknown word.

Of order 2 every document first gets the score it has if none of its bigrams is seen
elsewhere, which takes counts of words only. The count table of bigrams keeps those that
stand in two documents or more, with what such a bigram adds to that score, so that
nothing is joined for the many others and a joined row has no more than a document, a
bigram and its times.

A frequent n-gram is split over join tasks by measured size. Bigrams of two very frequent
words, which would be most of the rows, are counted ahead in a small table that is
broadcast, and scored where the text is read.

The score of a word w after c is others(c w) / count(c), where ``others`` leaves out
the document's own occurrences, so that a text is judged by all the others; where no
other document has the bigram it is ``BACKOFF`` * count(w) / words. The first word
follows a marker that begins every document. With order 3 a word after two others is
others(b c w) / count(b c), or else ``BACKOFF`` times its score after c alone; with order 1
it is count(w) / words.

Defined results: words are lower-cased runs of non-white-space; a document without
words has 0 words and a null score; rows of one doc_id are added up, each leaving out
its own occurrences; rows without doc_id are counted and not scored. Long texts are read whole,
though n-grams of one text are found together. Equally frequent words all have ids or none.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import backoff_lm
from tidegauge.llm.backoff_lm import BACKOFF, DOCUMENTS, TOGETHER, Model, words
from tidegauge.llm.tables import Workspace
from tidegauge.llm.workers import portions, slim

EXPLODED = "doc_id long, first long, second long, third long, times long, log_score double"
EXPLODED_BIGRAMS = "doc_id long, first long, second long, times long, log_score double"
GAINS = "first long, second long, n long, gain double"
SCORED = "doc_id long, log_score double, n_words long, word long, signed long"


def trigrams(model: Model, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """(row, first, second, third, times) of the trigrams of some texts, each of a row once.

    The first one of a text begins with what begins documents.
    """
    found = [words(x) for x in texts]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    numbers = {w: model.number(w) for w in set(chain.from_iterable(found))}
    third = np.fromiter(map(numbers.__getitem__, chain.from_iterable(found)), np.int64, int(lengths.sum()))
    row = np.repeat(np.arange(len(found)), lengths)
    begins = np.flatnonzero(np.diff(row, prepend=-1))
    second = np.concatenate(([0], third[:-1])) if len(third) else third
    second[begins] = model.start
    first = np.concatenate(([0], second[:-1])) if len(second) else second
    whole = np.ones(len(row), bool)
    whole[begins] = False
    both, times = np.unique(np.stack((row, first, second, third))[:, whole], axis=1, return_counts=True)
    return (*both, times)


def _rows(**columns) -> pa.RecordBatch:
    kinds = [pa.float64() if name == "log_score" else pa.int64() for name in columns]
    found = [pa.array(x).cast(kind) for x, kind in zip(columns.values(), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(found, names=list(columns))


def _summed(docs: np.ndarray, sums: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, sum, times) of each document once."""
    which, at = np.unique(docs, return_inverse=True)
    return which, np.bincount(at, sums, len(which)), np.bincount(at, times, len(which)).astype(np.int64)


def _explode(shared, order: int) -> Callable:
    """For ``mapInArrow``: (doc_id, text) to a row for each n-gram of a document and its number of times.

    A word is ``first`` null and ``second``, a bigram has both, and order 3 adds trigrams
    with ``third``.
    """

    def rows(model: Model, ids: np.ndarray, texts: list) -> Iterator[pa.RecordBatch]:
        row, first, second, times = model.bigrams(texts)
        none = pa.nulls(len(row), pa.int64())
        sums = pa.nulls(len(row), pa.float64())
        yield _rows(doc_id=ids[row], first=none if order == 1 else first, second=second, third=none, times=times, log_score=sums)
        if order == 3:
            row, first, second, third, times = trigrams(model, texts)
            yield _rows(doc_id=ids[row], first=first, second=second, third=third, times=times, log_score=pa.nulls(len(row), pa.float64()))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slim(batches):
            for some in portions(batch, "text", TOGETHER):
                yield from rows(model, some.column(0).to_numpy(), some.column(1).to_pylist())

    return explode


def _explode_bigrams(shared) -> Callable:
    """For ``mapInArrow``: (doc_id, text) to rows of three kinds.

    A document is a row without words: its number of words and its score as if only bigrams
    of frequent words were seen elsewhere, but for words without id. Those are ``second``
    without ``first``. Every other bigram has both.
    """

    def rows(model: Model, ids: np.ndarray, texts: list) -> Iterator[pa.RecordBatch]:
        row, first, second, times = model.bigrams(texts)
        if not len(row):
            return
        place = model.dense(first, second)
        ready = place >= 0
        others = np.zeros(len(row), np.int64)
        others[ready] = model.frequent[place[ready]] - times[ready]
        sums = np.bincount(row, times * model.log_scores(first, second, others)[0], len(texts))
        n_words = np.bincount(row, times, len(texts)).astype(np.int64)
        some = np.flatnonzero(n_words)
        null = pa.nulls(len(some), pa.int64())
        yield _rows(doc_id=ids[some], first=null, second=null, times=n_words[some], log_score=sums[some])
        lacks = second < 0
        where, word, n = row[lacks], second[lacks], times[lacks]
        if len(word):
            by = np.lexsort((word, where))
            where, word, n = where[by], word[by], n[by]
            begins = np.flatnonzero((np.diff(where, prepend=-1) != 0) | (np.diff(word, prepend=0) != 0))
            null, none = pa.nulls(len(begins), pa.int64()), pa.nulls(len(begins), pa.float64())
            yield _rows(doc_id=ids[where[begins]], first=null, second=word[begins], times=np.add.reduceat(n, begins), log_score=none)
        row, first, second, times = (x[~ready] for x in (row, first, second, times))
        yield _rows(doc_id=ids[row], first=first, second=second, times=times, log_score=pa.nulls(len(row), pa.float64()))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slim(batches):
            for some in portions(batch, "text", TOGETHER):
                yield from rows(model, some.column(0).to_numpy(), some.column(1).to_pylist())

    return explode


def _gains(shared) -> Callable:
    """For ``mapInArrow`` over (first, second, n): what a bigram seen elsewhere adds, next to the logarithm of the others.

    That is the score of the bigram without that of its second word alone. It lacks the counts of words without id.
    """

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if batch.num_rows:
                first, second = (batch.column(c).to_numpy() for c in (0, 1))
                one, none = np.ones(len(first), np.int64), np.zeros(len(first), np.int64)
                gain = model.log_scores(first, second, one)[0] - model.log_scores(first, second, none)[0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(gain)], names=["first", "second", "n", "gain"])

    return gains


def _score(shared) -> Callable:
    """For ``mapInArrow`` over (doc_id, first, second, own, scored, context, n), bigrams with their count.

    ``scored`` of a document's ``own`` occurrences are scored as bigrams, and ``context`` are
    the context of a trigram. Gives sums by document and batch, and the words without id
    whose logarithm a document still needs.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slim(batches):
            if not batch.num_rows:
                continue
            docs, first, second, own, scored, context, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            logs, needed, sign = model.log_scores(first, second, n - own)
            docs_once, sums, times = _summed(docs, scored * logs - context * np.log(n), scored)
            null = pa.nulls(len(docs_once), pa.int64())
            yield _rows(doc_id=docs_once, log_score=sums, n_words=times, word=null, signed=null)
            lacks = (needed < 0) & (scored > 0)
            none = np.zeros(int(lacks.sum()))
            yield _rows(
                doc_id=docs[lacks], log_score=none, n_words=none.astype(np.int64), word=needed[lacks], signed=(sign * scored)[lacks]
            )

    return score


def _score_words(shared) -> Callable:
    """For ``mapInArrow`` over (doc_id, word, times) of order 1: sums, and words without id."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            docs, word, times = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            counts = np.where(word >= 0, model.counts[np.maximum(word, 0)], 1)
            docs_once, sums, n = _summed(docs, times * (np.log(counts) - np.log(model.words)), times)
            null = pa.nulls(len(docs_once), pa.int64())
            yield _rows(doc_id=docs_once, log_score=sums, n_words=n, word=null, signed=null)
            lacks = word < 0
            none = np.zeros(int(lacks.sum()))
            yield _rows(doc_id=docs[lacks], log_score=none, n_words=none.astype(np.int64), word=word[lacks], signed=times[lacks])

    return score


def _with_counts(grams: DataFrame, keys: list[str], space: Workspace, name: str) -> DataFrame:
    """N-grams of documents with ``n``, their count in all documents.

    The count table is summed up on the map side and written, and the join is one of two
    plain tables by hash of the n-gram: a frequent one is split over tasks by measured size.
    The table has a row an n-gram, so no partition that is hashed is hot.
    """
    counts = space.keep(grams.groupBy(*keys).agg(F.sum("times").alias("n")), name)
    return grams.join(counts.hint("shuffle_hash"), keys)


def scores(docs: DataFrame, vocabulary_size: int | None = None, order: int = 2) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every document, by the counts of all of them.

    ``order`` is the longest n-gram, up to 3. Every word counts for itself, unless a
    ``vocabulary_size`` closes the vocabulary.
    """
    if order not in (1, 2, 3):
        raise ValueError(f"an order is 1, 2 or 3, not {order!r}")
    spark = docs.sparkSession
    space = Workspace(spark, "backoff-lm")
    texts = docs.select("text")
    counts = space.keep(
        texts.mapInArrow(backoff_lm._count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    model = _model(counts, vocabulary_size)
    missing = -(2**63)
    by_id = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(missing)).alias("doc_id"), "text")
    others = counts.filter(F.col("word") != DOCUMENTS)
    if order == 2:
        return _by_document(docs, _bigram_parts(by_id, model, others, space))
    others = others.mapInArrow(backoff_lm._hash_words, "word long, n long")
    shared = spark.sparkContext.broadcast(model)
    exploded = space.keep(by_id.mapInArrow(_explode(shared, order), EXPLODED), "exploded")
    nothing = F.lit(None).cast("long")
    ready = exploded.filter("second is null").select(
        "doc_id", "log_score", F.col("times").alias("n_words"), nothing.alias("word"), nothing.alias("signed")
    )
    if order == 1:
        scored = exploded.select("doc_id", "second", "times").mapInArrow(_score_words(shared), SCORED)
    else:
        bigrams = exploded.filter("first is not null and third is null").select("doc_id", "first", "second", "times")
        trigrams = exploded.filter("third is not null").drop("log_score")
        trigrams = space.keep(_with_counts(trigrams, ["first", "second", "third"], space, "trigram-counts"), "trigrams")
        hit = F.col("n") > F.col("times")
        zero = F.lit(0).cast("long")
        # a bigram stands in its document as the context of trigrams seen elsewhere, or for one not seen
        opens = F.when(F.col("first") == model.start, F.col("times")).otherwise(zero)
        parts = (
            bigrams.select("*", opens.alias("scored"), zero.alias("context")),
            trigrams.filter(hit).select("doc_id", "first", "second", zero.alias("times"), zero.alias("scored"), F.col("times").alias("context")),
            trigrams.filter(~hit).select("doc_id", F.col("second").alias("first"), F.col("third").alias("second"), zero.alias("times"),
                                         F.col("times").alias("scored"), zero.alias("context")),
        )
        union = parts[0].unionByName(parts[1]).unionByName(parts[2])
        used = space.keep(
            union.groupBy("doc_id", "first", "second").agg(*(F.sum(c).alias(c) for c in ("times", "scored", "context"))), "used"
        )
        long = trigrams.select(
            "doc_id",
            (F.col("times") * F.when(hit, F.log(F.col("n") - F.col("times"))).otherwise(F.lit(float(np.log(BACKOFF))))).alias("log_score"),
            F.when(hit, F.col("times")).otherwise(zero).alias("n_words"),
            nothing.alias("word"),
            nothing.alias("signed"),
        )
        ready = ready.unionByName(long)
        counted = _with_counts(used, ["first", "second"], space, "bigram-counts")
        columns = ("doc_id", "first", "second", "times", "scored", "context", "n")
        scored = counted.select(*columns).mapInArrow(_score(shared), SCORED)
        scored = scored.unionByName(ready)
    # scores that lack the logarithm of a word's count join the counts of all words
    scored = space.keep(
        scored.groupBy("doc_id", "word").agg(*(F.sum(c).alias(c) for c in ("log_score", "n_words", "signed"))), "scored"
    )
    added = scored.filter("word is not null").join(others, "word").select(
        "doc_id", (F.col("signed") * F.log("n")).alias("log_score"), F.lit(0).cast("long").alias("n_words")
    )
    summed = scored.filter("word is null").select("doc_id", "log_score", "n_words")
    return _by_document(docs, summed.unionByName(added))


def _bigram_parts(by_id: DataFrame, model: Model, others: DataFrame, space: Workspace) -> DataFrame:
    """(doc_id, log_score, n_words) to be added up, of order 2; ``others`` has the counts of words."""
    context = by_id.sparkSession.sparkContext
    frequent = by_id.select("text").mapInArrow(
        backoff_lm._count_frequent(context.broadcast(model)), "pair long, n long"
    ).groupBy("pair").agg(F.sum("n").alias("n"))
    # at most backoff_lm.FREQUENT squared rows
    model.frequent = np.zeros(backoff_lm.FREQUENT * backoff_lm.FREQUENT, np.int64)
    for pair, n in frequent.collect():
        model.frequent[pair] = n
    shared = context.broadcast(model)

    exploded = space.keep(by_id.mapInArrow(_explode_bigrams(shared), EXPLODED_BIGRAMS), "exploded")
    zero = F.lit(0).cast("long").alias("n_words")
    documents = exploded.filter("second is null").select("doc_id", "log_score", F.col("times").alias("n_words"))
    # a word that stands once adds the logarithm of 1
    others = others.filter("n > 1").mapInArrow(backoff_lm._hash_words, "word long, n long")
    logs = others.select("word", F.log("n").alias("log_n"))
    words = exploded.filter("first is null").select("doc_id", F.col("second").alias("word"), "times")
    words = words.join(logs, "word").select("doc_id", (F.col("times") * F.col("log_n")).alias("log_score"), zero)

    bigrams = exploded.filter("first is not null").select("doc_id", "first", "second", "times")
    # what stands in one row only is not seen elsewhere
    shared_ones = bigrams.groupBy("first", "second").agg(F.sum("times").alias("n"), F.count("*").alias("rows")).filter("rows > 1")
    counted = space.keep(shared_ones.select("first", "second", "n").mapInArrow(_gains(shared), GAINS), "counted")
    rare = counted.filter("first < 0 or second < 0")
    for side in ("first", "second"):
        rare = rare.join(logs.withColumnRenamed("word", side), side, "left").withColumn(
            "gain", F.col("gain") - F.coalesce("log_n", F.lit(0.0))
        ).drop("log_n")
    # written, so that a frequent bigram is split over tasks; a partition that is hashed has a row a bigram
    table = space.keep(counted.filter("first >= 0 and second >= 0").unionByName(rare), "bigrams")
    seen = bigrams.join(table.hint("shuffle_hash"), ["first", "second"]).select(
        "doc_id", (F.col("times") * (F.log(F.col("n") - F.col("times")) + F.col("gain"))).alias("log_score"), zero
    )
    return documents.unionByName(words).unionByName(seen)


def _by_document(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Sums of ``parts`` for every doc_id of ``docs``."""
    per_document = parts.groupBy("doc_id").agg(F.sum("log_score").alias("log_score"), F.sum("n_words").alias("n_words"))
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


def _model(counts: DataFrame, vocabulary_size: int | None) -> Model:
    known = backoff_lm.vocabulary(counts, backoff_lm.VOCABULARY if vocabulary_size is None else vocabulary_size)
    sums = counts.groupBy((F.col("word") == DOCUMENTS).alias("is_documents")).agg(F.sum("n").alias("n")).collect()
    total = {r.is_documents: r.n for r in sums}
    table = np.zeros(len(known) + 2, np.int64)
    for number, n in known.values():
        table[number] = n
    table[0] = total.get(False, 0) - table.sum()
    table[-1] = total.get(True, 0)
    return Model({word: number for word, (number, _) in known.items()}, table, vocabulary_size is not None)
