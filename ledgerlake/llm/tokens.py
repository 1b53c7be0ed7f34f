"""Hashed words of texts, for the operators that count, shingle or score words inside Arrow batches.

A word is a maximal run of characters other than the six ASCII white-space ones; A-Z are lower-cased, nothing else.
Words are hashed to 64 bits straight from the bytes of a batch, by differences of one running sum, so that no Python
object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
_ODD = 0x9E3779B97F4A7C15
_MULTIPLIER = np.uint64(_ODD)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(np.uint64)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# All ASCII characters but letters and digits: what is between them are bare words, without punctuation.
PUNCTUATION = np.array([byte < 128 and not chr(byte).isalnum() for byte in range(256)])


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def trimmed(task: Task) -> Task:
    """The task; at its end the worker gives the memory it no longer needs back to the system. A worker lives on for the
    tasks of other stages, next to which it would hold the largest memory it ever took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim is not None:
            trim(0)

    return run


@dataclass
class Words:
    """Words of some texts, one after another. Text i owns ``starts[i]:starts[i + 1]``; word j is
    ``data[begin[j]:end[j]]``."""

    hashes: np.ndarray
    starts: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    out = []
    for base in (_ODD, pow(_ODD, -1, 2**64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text, or one row: working memory follows the
    longest text instead of the number of rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        edges = np.flatnonzero(np.diff(part, prepend=-1))
        for first, end in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows], strict=True):
            yield batch.slice(first, end - first)


def text_bytes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts in one array and the offsets of each; a null text is empty."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "").take(np.arange(len(texts)))  # a copy without offset
    if lower:
        filled = pc.ascii_lower(filled)
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, between: np.ndarray = SPACE) -> Words:
    """Words of each text; a null text has none. ``between`` tells which bytes separate words."""
    data, offsets = text_bytes(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), np.zeros(len(texts) + 1, np.int64), data, none, none)
    solid = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    size = 1 << max(20, int(len(data)).bit_length())
    power, inverse = _powers(size) if size <= 1 << 22 else _powers.__wrapped__(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:len(data)], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return Words(hashes, np.searchsorted(begin, offsets), data, begin, end)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; one to one."""
    values = (values ^ (values >> np.uint64(32))) * _MULTIPLIER
    values = (values ^ (values >> np.uint64(29))) * _MULTIPLIER
    return values ^ (values >> np.uint64(32))


def beginnings(found: Words, size: int) -> np.ndarray:
    """Hash of the first ``size`` bytes of each word, at most 8."""
    out = np.zeros(len(found.begin), np.uint64)
    for step in range(size):
        at = found.begin + step
        inside = at < found.end
        out = (out << np.uint64(8)) | np.where(inside, found.data[np.minimum(at, max(len(found.data) - 1, 0))], 0).astype(np.uint64) \
            if len(found.data) else out
    return mix(out + np.uint64(0x0B0E + size))


def gram(hashes: np.ndarray, gaps: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at i, i + gap, ... for each i that has them all, in the order of ``gaps`` (the first is 0)."""
    count = max(len(hashes) - max(gaps), 0)
    out = np.full(count, 0x51ED270B + 2 * len(gaps) + (max(gaps) << 8), np.uint64)
    power, _ = _powers(64)
    for place, gap in enumerate(gaps):
        out += hashes[gap:gap + count] * power[place + 3]
    return mix(out)


def gram_places(found: Words, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with at least ``reach`` words after them in the same text, and the edges of each text among these."""
    counts = np.maximum(found.lengths - reach, 0)
    edges = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=edges[1:])
    return np.arange(edges[-1]) + np.repeat(found.starts[:-1] - edges[:-1], counts), edges


def shingle_sets(found: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``size`` successive words, by text. A text of fewer words has one shingle of all of
    them, a text without words none."""
    rolled = gram(found.hashes, tuple(range(size)))
    out = []
    for first, last in zip(found.starts[:-1].tolist(), found.starts[1:].tolist(), strict=True):
        if last - first >= size:
            values = np.sort(rolled[first:last - size + 1])
            out.append(values[np.concatenate(([True], values[1:] != values[:-1]))])
        elif last > first:
            out.append(gram(found.hashes[first:last], tuple(range(last - first))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
