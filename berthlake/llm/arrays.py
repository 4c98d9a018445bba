"""Words, hashes and slices of a batch of texts as numpy arrays.

A text column of an Arrow batch is one byte buffer with offsets. Everything here works on that buffer: words are
found by a byte table, hashes come from prefix sums of a polynomial modulo 2**64, so that no Python loop runs per word.
Texts are whole; a batch is worked off in slices of a few megabytes, and a slice never cuts a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# bytes that belong to a word: everything but blank, tab, line feed, vertical tab, form feed, carriage return
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# digits, lower-case letters and everything above ASCII
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Powers:
    """Powers of the base and of its inverse, grown on demand, one pair per Python worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


class Words(NamedTuple):
    starts: np.ndarray   # byte position of each word
    ends: np.ndarray     # exclusive
    bounds: np.ndarray   # words of text i: bounds[i] to bounds[i + 1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def one_chunk(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    data, offsets = buffer(column)
    first, n = 0, len(column)
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first]: offsets[end]], offsets[first: end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = Powers.to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """64-bit hashes of the byte spans. Slices, for spans of one size at all places, copy nothing."""
    _, down = Powers.to(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    return span_hashes(prefix_sums(data), found.starts, found.ends)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (the caller leaves out those that cross a text's end)."""
    n = max(len(hashes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += hashes[k: k + n] * np.uint64(pow(_BASE, k + 3, 1 << 64))
    return mix(out)


def window_mask(bounds: np.ndarray, size: int) -> np.ndarray:
    """True where ``size`` words from that position on belong to one text; as long as window_hashes gives."""
    mask = np.ones(max(int(bounds[-1]) - size + 1, 0), bool)
    for k in range(1, size):
        at = bounds[1:-1] - k
        mask[at[(at >= 0) & (at < len(mask))]] = False
    return mask


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the word windows of each text, ASCII letters lowered; a shorter text is one window."""
    data = LOWER[data]
    found = words(data, offsets, NOT_BLANK)
    hashes = word_hashes(data, found)
    grams = window_hashes(hashes, size)
    out = []
    bounds = found.bounds.tolist()
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= size:
            out.append(np.unique(grams[a: b - size + 1]))
        elif b > a:
            out.append(mix(window_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(members: np.ndarray) -> int:
    """64-bit key of a set of hashes, as a signed integer."""
    total = np.array([members.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(members)), len(members)], np.uint64)
    return int(window_hashes(mix(total), 3).view(np.int64)[0])
