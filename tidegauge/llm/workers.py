"""Things a Python worker builds once and keeps between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time, unless a single text is longer.
PORTION = 8_000_000

_kept: dict[str, tuple[Hashable, Any]] = {}


def once_per_worker(kind: str, key: Hashable, build: Callable[[], Any]) -> Any:
    """What ``build`` makes; the last one of each kind is kept.

    The first word of a kind names an operator. A worker that goes over to another operator
    drops what the one before has built.
    """
    if kind not in _kept or _kept[kind][0] != key:
        for other in [k for k in _kept if k.split()[0] != kind.split()[0]]:
            del _kept[other]
        _kept[kind] = key, build()
    return _kept[kind][1]


def _trim() -> None:
    """Give memory that is no longer used back to the system, as far as its library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def slim(batches: Iterator) -> Iterator:
    """The batches; gives memory that is no longer used back when they begin and end.

    A worker stays for later tasks, of other stages as well, and would keep it.
    """
    _trim()
    yield from batches
    _trim()


def portions(batch: pa.RecordBatch, column: str, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and about ``PORTION`` bytes of a text column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        until = int(np.searchsorted(ends, before + PORTION, side="right"))
        until = min(max(until, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, until - at)
        at = until
