"""Words, word hashes and window hashes of Arrow text columns, by numpy.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return.  All functions work on whole batches of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
# Texts are taken in slices of about this many bytes, to bound the arrays made from them.
SLICE_BYTES = 1 << 21

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_SEED, _STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(29))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(32))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets with one entry more than texts); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
        column = column.cast(pa.large_binary())
    column = pc.fill_null(column, b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def sliced(table, text: str = "text", budget: int = SLICE_BYTES) -> Iterator:
    """Row ranges of a table or batch whose texts have about ``budget`` bytes; a longer
    text is alone."""
    if table.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(table.column(text)), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    at, base = 0, 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, base + budget, side="right")))
        yield table.slice(at, to - at)
        at, base = to, int(ends[to - 1])


_ALONE = re.compile(r"\S (?=\S)")


def text_parts(text: str, size: int = SLICE_BYTES) -> Iterator[str]:
    """A long text in parts of about ``size`` characters that begin with a single space
    between other characters; a longer run without one is not parted."""
    at = 0
    while at < len(text):
        found = _ALONE.search(text, at + size)
        to = found.start() + 1 if found else len(text)
        yield text[at:to]
        at = to


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes as they are."""
    return _LOWER[buf]


def in_words(buf: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word."""
    return _IS_WORD[buf]


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end byte of every word, number of words of every text)."""
    n = len(buf)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = _IS_WORD[buf]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1] if n else begins[1:]
    edges = off[1:-1]
    edges = edges[edges < n]
    begins[edges] = inside[edges]
    ends = inside[:n] & ~inside[1:]
    ends[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    counts = np.diff(np.searchsorted(starts, off))
    return starts, stops, counts


def _scrambled(values: np.ndarray, places: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit value for every (value below 256, place)."""
    with np.errstate(over="ignore"):
        return mix((places.astype(np.uint64) << np.uint64(8) | values) + np.uint64(seed * _SEED & 2**64 - 1))


def word_hashes(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word, the same wherever the word stands; words do not overlap.

    It is a sum of scrambled (byte, place in the word), so that words of like structure have
    unlike hashes.  Hashes of different seeds are independent.
    """
    parts, i = [], 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, low + SLICE_BYTES)))
        some = buf[low : stops[j - 1]]
        begin, end = starts[i:j] - low, stops[i:j] - low
        first = np.zeros(len(some), np.int64)
        first[begin] = begin
        total = np.zeros(len(some) + 1, dtype=np.uint64)
        places = np.arange(len(some)) - np.maximum.accumulate(first)
        with np.errstate(over="ignore"):
            np.cumsum(_scrambled(some, places, seed), out=total[1:])
            parts.append(mix(total[end] - total[begin]))
        i = j
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def prefix_hashes(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of what stands before every value back to its first, not with itself."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(_scrambled(values, np.arange(len(values)) - firsts, 0), out=total[1:])
        return mix(total[:-1] - total[firsts])


def window_starts(counts: np.ndarray, k: int) -> np.ndarray:
    """Index of the first word of every window of ``k`` words inside one text."""
    firsts = np.cumsum(counts) - counts
    windows = np.maximum(counts - k + 1, 0)
    total = int(windows.sum())
    before = np.repeat(np.cumsum(windows) - windows, windows)
    return np.arange(total) - before + np.repeat(firsts, windows)


def _joined(hashes: np.ndarray, at: np.ndarray, n: int, step: int, salt: int) -> np.ndarray:
    """Sums of scramblings of ``n`` hashes from each place on, ``step`` apart; which of them
    a hash is counts."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(at), dtype=np.uint64)
        for j in range(n):
            total += mix(hashes[at + j * step] + np.uint64((j + 1) * _STEP + salt & 2**64 - 1))
        return mix(total)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``k`` words from each start; of long windows through the hashes
    of shorter ones."""
    part = next((d for d in (5, 4, 3, 2) if k > 6 and k % d == 0), 1)
    if part > 1 and len(hashes) >= part:
        hashes = _joined(hashes, np.arange(len(hashes) - part + 1), part, 1, salt)
    return _joined(hashes, starts, k // part, part, salt)
