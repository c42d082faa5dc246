"""Distinct word shingles of many texts at once, as 64-bit hashes, from Arrow buffers.

Words are what lies between white space (blank, tab to carriage return), with A-Z
in lower case.  A text's shingles are the hashes of ``width`` words in a row; a
text of fewer words has one, of all its words; one without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SLICE = 512_000  # bytes whose words are hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, at least."""
    if len(powers.table) < n:
        steps = np.full(max(n, 64), _BASE, np.uint64)
        steps[0] = 1
        powers.table = np.cumprod(steps, dtype=np.uint64)
    return powers.table


powers.table = np.ones(1, np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts) of a text column; nulls are empty."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    return raw, offsets - (offsets[0] if len(offsets) else 0)


def _word_hashes(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of ``raw``; ``cuts``: places where a text begins."""
    low = raw.copy()
    low[(low >= 65) & (low <= 90)] += 32
    blank = (low == 32) | ((low >= 9) & (low <= 13))
    begins = ~blank
    begins[1:] &= blank[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(raw))]
    begins[inner] = ~blank[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    place = np.arange(len(raw))
    first = np.where(begins, place, 0)
    np.maximum.accumulate(first, out=first)
    place -= first
    value = low.astype(np.uint64) + np.uint64(1)
    value *= powers(int(place.max()) + 1)[place]
    value[blank] = 0
    return mix(np.add.reduceat(value, starts)), starts


def slice_end(raw: np.ndarray, at: int) -> int:
    """Where a slice that begins at ``at`` ends: at a blank or at the end of all bytes."""
    end = min(len(raw), at + _SLICE)
    while end < len(raw):
        window = raw[end : end + 4096]
        blank = np.flatnonzero((window == 32) | ((window >= 9) & (window <= 13)))
        if len(blank):
            return end + int(blank[0])
        end += len(window)
    return end


def _sliced_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = slice_end(raw, at)
        h, s = _word_hashes(raw[at:end], offsets - at)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text of ``column`` its distinct shingles, sorted."""
    raw, offsets = text_bytes(column)
    words, starts = _sliced_words(raw, offsets)
    bounds = np.searchsorted(starts, offsets)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    windows = max(0, len(words) - width + 1)
    whole = np.full(windows, width, np.uint64)
    for k in range(width):
        whole += words[k : k + windows] * factors[k]
    whole = mix(whole)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(whole[a : b - width + 1])
        elif b > a:
            yield mix((words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
