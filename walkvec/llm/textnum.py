"""Words, shingles and byte windows of many texts at once, as numpy arrays.

Texts arrive as Arrow columns. They are handled in chunks of half a MB or so that hold
whole texts (one text at least), so that memory does not follow the size of an
Arrow batch. A null text counts as an empty one.

Hashes are 64-bit polynomial hashes over a random byte table, so that the hash of
any span follows from two prefix sums; ``finish`` mixes the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_GRAM = U(0xD6E8FEB86659FD93)
_BYTE_VALUES = np.random.default_rng(20260101).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)

#: Space and the control characters tab to carriage return part words.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = np.ones(1, U)
_inverses = np.ones(1, U)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 20)
        _powers, _inverses = (
            np.cumprod(np.concatenate([np.ones(1, U), np.full(size - 1, b, U)]), dtype=U)
            for b in (_BASE, _BASE_INVERSE)
        )
    return _powers, _inverses


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash over all 64 places."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Chunk(NamedTuple):
    first: int  # number of its first text in the column
    data: np.ndarray  # the bytes of all its texts
    offsets: np.ndarray  # where each text starts, and the end


def chunks(column: pa.Array, most: int = 1 << 19) -> Iterator[Chunk]:
    """The texts of a column, in chunks of about ``most`` bytes of whole texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield Chunk(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span."""
    powers, _ = _tables(len(data) + 1)
    sums = np.empty(len(data) + 1, U)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unmixed hashes of the bytes from each start to its end."""
    _, inverses = _tables(len(sums))
    return (sums[ends] - sums[starts]) * inverses[starts]


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # number of the text within the chunk
    hashes: np.ndarray


def words(chunk: Chunk, data: np.ndarray | None = None, separators: np.ndarray = BLANKS) -> Words:
    """The words of a chunk: longest runs without a separator, within one text."""
    data = chunk.data if data is None else data
    if not len(data):
        return Words(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, U))
    inside = ~separators[data]
    edges = chunk.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    text = np.searchsorted(chunk.offsets, starts, "right") - 1
    return Words(starts, ends, text, finish(span_hashes(prefix_hashes(data), starts, ends)))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Mixed hashes of ``n`` consecutive entries, one per start that has them."""
    if len(hashes) < n:
        return np.zeros(0, U)
    count = len(hashes) - n + 1
    h = np.full(count, U(n))
    for i in range(n):
        h = h * _GRAM + hashes[i : i + count]
    return finish(h)


def shingle_sets(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct lower-cased shingles of each text: sorted hashes, and where each text's begin.

    A text with fewer words than ``size``, but not none, has its whole sequence as one shingle.
    """
    n = len(chunk.offsets) - 1
    w = words(chunk, LOWER[chunk.data])
    counts = np.bincount(w.text, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    h = grams(w.hashes, size)
    whole = w.text[size - 1 :] == w.text[: len(h)] if len(h) else np.zeros(0, bool)
    text, h = w.text[: len(h)][whole], h[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = [grams(w.hashes[first[i] : first[i + 1]], counts[i])[0] for i in short]
        text, h = np.concatenate([text, short]), np.concatenate([h, np.array(own, U)])
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[keep], np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=n))])
