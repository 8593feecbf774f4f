"""Benchmark passages in documents, with up to a share of edits.

An item of m characters may differ by k = floor(rate * m) edits. Of any k + 1 separate
pieces of it at least one stands in the text unchanged, so the pieces are taken where the
item differs from others: what many items share, such as a template's words, is left
between them. All pieces of a block of items form one automaton that runs over every
document; each hit fixes the place where the item can stand. There the item's pairs of
neighbouring characters are counted first, as k edits change at most 2 k of them, for all
items at once where a piece belongs to many; Myers' bit-parallel distance decides on the rest.

Defined results: case is ignored, all other characters count; null or empty texts and
items match nothing; an item of fewer characters than 1 / rate has no budget and is found
wherever it stands, within words as well; items of equal text are all reported; repeated
documents each get their rows; offsets are code points of the original text; of places of
equal distance the first counts. Texts of any length are searched whole. Other columns
are kept. Empty tables match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace

RATE = 0.07
#: Characters of benchmark items that are searched at a time; a larger benchmark takes several scans.
BLOCK_CHARS = 4_000_000

#: Characters of a stretch that is looked at for being shared, and items beyond which it is.
GRAM = 6
COMMON = 8
#: Items of one piece from which on they are compared by pairs of characters first.
MANY = 16
#: Classes that pairs of characters fall into.
PAIRS = 128
#: Characters around a piece beyond which its items are not compared by pairs but verified at once.
WINDOW = 1 << 16
#: Items of one piece compared at a time.
TOGETHER = 4_096
MIX = np.uint64(0x9E3779B97F4A7C15)

MATCHES = "doc_id long, item_id long, distance int, start long, end long"


def lower(text: str) -> str:
    """Lower case of unchanged length."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(x if len(x := c.lower()) == 1 else c for c in text)


def pieces(item: str, rate: float, shared: np.ndarray | None = None) -> list[tuple[int, str]]:
    """(offset, piece): error budget plus one separate pieces.

    ``shared`` tells which stretches of GRAM characters other items have too. The pieces
    begin at stretches that are the item's own, evenly many to a piece; an item without
    enough of them is cut evenly.
    """
    n = int(rate * len(item)) + 1
    own = np.flatnonzero(~shared) if shared is not None else []
    if len(own) >= n * GRAM:
        cuts = [int(own[len(own) * i // n]) for i in range(n)] + [len(item)]
    else:
        cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(text: str, size: int) -> np.ndarray:
    """A hash of each stretch of ``size`` characters."""
    codes = _codes(text).astype(np.uint64)
    found = np.zeros(max(len(codes) - size + 1, 0), np.uint64)
    for i in range(size):
        found = found * MIX + codes[i : i + len(found)]
    return found * MIX >> np.uint64(20)


class Commonness:
    """How many items have each stretch of GRAM characters, by a table of hashes.

    Hashes that meet make a stretch look more common than it is, which moves pieces and
    loses nothing.
    """

    def __init__(self, items: list[str]):
        self.table = np.zeros(1 << 22, np.uint32)
        for item in items:
            self.table[np.unique(_hashes(item, GRAM) % np.uint64(len(self.table)))] += 1

    def shared(self, item: str) -> np.ndarray:
        return self.table[_hashes(item, GRAM) % np.uint64(len(self.table))] > COMMON


def bit_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], length: int, text: str, free_start: bool = True) -> tuple[int, int]:
    """(distance, end) of the best match of a pattern in ``text``, the first of equals.

    Columns of the edit matrix are kept as differences in two integers of ``length``
    bits. With ``free_start`` the match may begin anywhere, otherwise at 0.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, at = length, 0
    for i, c in enumerate(text, 1):
        same = masks.get(c, 0)
        vertical = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        if not free_start:
            up |= 1
        plus = ((down << 1) & full) | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, at = score, i
    return best, at


def _classes(text: str) -> np.ndarray:
    """The class of each pair of neighbouring characters."""
    return (_hashes(text, 2) % np.uint64(PAIRS)).astype(np.int64)


class Matcher:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(key, low, int(rate * len(low))) for key, text in items if (low := lower(text))]
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        common = Commonness([low for _, low, _ in self.items])
        hits: dict[str, list[tuple[int, int]]] = {}
        for n, (_, low, _) in enumerate(self.items):
            for offset, piece in pieces(low, rate, common.shared(low)):
                hits.setdefault(piece, []).append((n, offset))
        for piece, places in hits.items():
            many = np.array(places) if len(places) >= MANY else None
            self.automaton.add_word(piece, (len(piece), places, many))
        if hits:
            self.automaton.make_automaton()
        self.empty = not hits
        self.lengths = np.array([len(low) for _, low, _ in self.items])
        self.budgets = np.array([budget for *_, budget in self.items])
        self.pairs = np.zeros((len(self.items), PAIRS), np.int32)
        for n, (_, low, _) in enumerate(self.items):
            self.pairs[n] = np.bincount(_classes(low), minlength=PAIRS)

    def alike(self, places: np.ndarray, text: np.ndarray, begin: int) -> np.ndarray:
        """Those of many (item, offset) whose item may stand where its piece does.

        ``text`` has the class of each pair of neighbouring characters. An item within its
        budget misses at most two of its pairs an edit in the window it can lie in.
        """
        item, offset = places.T
        budget = self.budgets[item]
        low = np.maximum(begin - offset - budget, 0)
        high = np.clip(begin - offset + self.lengths[item] + budget - 1, low, len(text))
        at = int(low.min())
        if int(high.max()) - at > WINDOW:
            return places
        marks = np.zeros((int(high.max()) - at + 1, PAIRS), np.int32)
        marks[np.arange(1, len(marks)), text[at : at + len(marks) - 1]] = 1
        sums = np.cumsum(marks, axis=0)
        kept = []
        for some in range(0, len(places), TOGETHER):
            part = slice(some, some + TOGETHER)
            inside = sums[high[part] - at] - sums[low[part] - at]
            missing = np.maximum(self.pairs[item[part]] - inside, 0).sum(axis=1)
            kept.append(places[part][missing <= 2 * budget[part]])
        return np.concatenate(kept)

    def verify(self, n: int, text: str, classes: np.ndarray, start: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of item ``n`` near ``start``, if within its budget."""
        _, low, budget = self.items[n]
        if text.startswith(low, max(start, 0)) and start >= 0:
            return 0, start, start + len(low)
        begin = max(0, start - budget)
        part = text[begin : start + len(low) + budget]
        inside = np.bincount(classes[begin : begin + len(part) - 1], minlength=PAIRS)
        if np.maximum(self.pairs[n] - inside, 0).sum() > 2 * budget:
            return None
        if n not in self.masks:
            self.masks[n] = bit_masks(low)
        distance, end = best_end(self.masks[n], len(low), part)
        if distance > budget:
            return None
        # backwards from the end: the shortest stretch of that distance
        _, back = best_end(bit_masks(low[::-1]), len(low), part[:end][::-1], free_start=False)
        return distance, begin + end - back, begin + end

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end): the best match of each item, the first of equals."""
        if not text or self.empty:
            return
        low = lower(text)
        best: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, set[int]] = {}
        classes = None
        for last, (size, places, many) in self.automaton.iter(low):
            classes = _classes(low) if classes is None else classes
            if many is not None:
                places = self.alike(many, classes, last - size + 1).tolist()
            for n, offset in places:
                start, budget = last - size + 1 - offset, self.items[n][2]
                if n in best and best[n][0] == 0:
                    continue
                # a window reaches one budget to both sides: places that close share it
                seen = tried.setdefault(n, set())
                if start in seen:
                    continue
                seen.add(start)
                found = self.verify(n, low, classes, start)
                if found and (n not in best or found < best[n]):
                    best[n] = found
        for n, (distance, start, end) in best.items():
            yield self.items[n][0], distance, start, end


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    usable = benchmark.filter(F.length("text") > 0).select(F.col("item_id").cast("long"), "text").distinct()
    for row in usable.toLocalIterator():
        if block and size + len(row.text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    yield block


def _search(shared, rate: float, docs: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = None
        for batch in batches:
            matcher = matcher or Matcher(shared.value, rate)
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for match in matcher.matches(text)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "distance", "start", "end"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, MATCHES)


def _in_turn(docs: DataFrame, benchmark: DataFrame, step) -> None:
    """Do ``step(shared block, number, whether it is the last)`` for each block of the benchmark.

    The driver and the workers hold one block at a time, unless there is only one.
    """
    blocks = _blocks(benchmark)
    block, number = next(blocks), 0
    while block is not None:
        following = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast(block)
        step(shared, number, following is None)
        if following is not None:
            shared.destroy()
        block, number = following, number + 1


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, start, end): items found in documents, the best place of each.

    The benchmark is broadcast in blocks of at most ``BLOCK_CHARS`` characters, or one item,
    each searched in all documents. What all but the last find is written.
    """
    space, found = Workspace(docs.sparkSession, "decontamination"), []

    def step(shared, number: int, last: bool) -> None:
        part = _search(shared, rate, docs)
        found.append(part if last else space.keep(part, f"block-{number}"))

    _in_turn(docs, benchmark, step)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns are kept.

    With several blocks of benchmark the rows that stay are written after each.
    """
    space, kept = Workspace(docs.sparkSession, "decontaminated"), [docs]

    def step(shared, number: int, last: bool) -> None:
        @F.arrow_udf("boolean")
        def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            matcher = Matcher(shared.value, rate)
            for texts in batches:
                yield pa.array([next(matcher.matches(x), None) is not None for x in texts.to_pylist()], pa.bool_())

        part = kept[0].filter(~leaks("text"))
        kept[0] = part if last else space.keep(part, f"block-{number}")

    _in_turn(docs, benchmark, step)
    return kept[0]
