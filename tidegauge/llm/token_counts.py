"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie whose nodes carry a failure link and the number of pieces
that longest-match-first has certainly cut off when the link is taken. A word is then
read once, left to right, and its pieces are counted without being built.

A word is a maximal run of non-white-space characters, read as UTF-8 bytes behind a
one-byte ``prefix`` that marks its beginning, so that pieces with the prefix begin
words. Every byte the vocabulary lacks as a piece makes the whole word one unknown piece.

Defined results: null, empty and blank texts have no words and no pieces; repeated
rows each get their counts; a text of any length is read word by word; where two pieces
begin alike the longer one is cut off. Other columns are kept whatever their names,
``n_words`` and ``n_tokens`` are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.tables import named, unused
from tidegauge.llm.workers import once_per_worker

PREFIX = b" "
#: Words a worker remembers; beyond that it starts anew.
REMEMBERED = 250_000


class Automaton:
    """Trie with failure links and popped-piece counts.

    Node 0 is the root. For a node that spells s, ``popped`` is how many pieces
    longest-match cuts off s before it must wait for more input, ``failure`` the node
    that spells what is left of s then, -1 if s cannot be cut.
    """

    def __init__(self, pieces: Iterable[bytes], prefix: bytes = PREFIX):
        self.prefix = prefix
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                following = children[node].get(byte)
                if following is None:
                    following = len(children)
                    children[node][byte] = following
                    children.append({})
                    final.append(False)
                node = following
            final[node] = node != 0
        self.children = children
        self.failure, self.popped = [-1] * len(children), [0] * len(children)
        queue = deque([0])
        while queue:
            above = queue.popleft()
            for byte, node in children[above].items():
                queue.append(node)
                if final[node]:
                    self.failure[node], self.popped[node] = 0, 1
                    continue
                link, n = self.failure[above], self.popped[above]
                while link >= 0 and byte not in children[link]:
                    n += self.popped[link]
                    link = self.failure[link]
                if link >= 0:
                    self.failure[node], self.popped[node] = children[link][byte], n

    def count(self, word: bytes) -> int:
        """Number of greedy pieces of one word, 1 if it cannot be cut."""
        children, failure, popped = self.children, self.failure, self.popped
        node = n = 0
        for byte in self.prefix + word:
            while (following := children[node].get(byte)) is None:
                if failure[node] < 0:
                    return 1
                n += popped[node]
                node = failure[node]
            node = following
        while node:
            if failure[node] < 0:
                return 1
            n += popped[node]
            node = failure[node]
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[word] = self.automaton.count(word.encode())
        return n


def token_counts(spark: SparkSession, text: Column, pieces: list[bytes], prefix: bytes = PREFIX) -> Column:
    """struct(n_words, n_tokens) of a text; the vocabulary is broadcast, its size is fixed."""
    shared = spark.sparkContext.broadcast(pieces)
    key = prefix, hashlib.sha256(b"\n".join(pieces)).digest()

    @F.arrow_udf("struct<n_words: bigint, n_tokens: bigint>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = once_per_worker("token counts", key, lambda: _Counts(Automaton(shared.value, prefix)))
        count = counts.__getitem__
        for texts in batches:
            words = [(x or "").split() for x in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array(map(len, words), pa.int64()), pa.array([sum(map(count, x)) for x in words], pa.int64())],
                names=["n_words", "n_tokens"],
            )

    return counted(text)


def with_token_counts(docs: DataFrame, pieces: list[bytes], prefix: bytes = PREFIX) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``; columns of these names are replaced."""
    counts = token_counts(docs.sparkSession, F.col("text"), pieces, prefix)
    kept = [c for c in docs.columns if c not in ("n_words", "n_tokens")]
    both = unused(docs.columns, "counted")
    return docs.withColumn(both, counts).select(*named(kept), f"{both}.n_words", f"{both}.n_tokens")
