"""Words and their hashes over many texts at once, as NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

GROUP_BYTES = 4 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(1024, np.uint64(0x100000001B3)), dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits and all bytes beyond ASCII make words; the other table cuts at white space only.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
VISIBLE = np.ones(256, bool)
VISIBLE[[9, 10, 11, 12, 13, 32]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of unsigned 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def groups(raws: Sequence[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes together; a longer text is a group of its own."""
    start, size = 0, 0
    for i, raw in enumerate(raws):
        if size and size + len(raw) > limit:
            yield start, i
            start, size = i, 0
        size += len(raw)
    if start < len(raws):
        yield start, len(raws)


def scan(raws: Sequence[bytes], word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, starts, ends, doc)``: lower-cased bytes of all texts in a row, and each word's place and text number.

    Lower case is meant for A-Z and the Latin-1 capitals (two bytes, the first 0xC3).
    """
    data = _LOWER[np.frombuffer(b" ".join(raws) + b" ", np.uint8)]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    data[1:][capital] += 32
    inside = word_bytes[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    first = np.cumsum([0, *(len(r) + 1 for r in raws)])
    return data, starts, ends, np.searchsorted(first, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, all of its bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    at = np.cumsum(size) - size
    inner = np.arange(int(size.sum())) - np.repeat(at, size)
    part = (data[np.repeat(starts, size) + inner].astype(np.uint64) + np.uint64(1)) * _POWERS[inner & 1023]
    part += (inner >> 10).astype(np.uint64) * part
    return mix(np.add.reduceat(part, at) + size.astype(np.uint64) * _P)


def stem_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """For each size, the hash of every word's first so many bytes; 0 for words that are shorter."""
    out, h, last = [], np.zeros(len(starts), np.uint64), len(data) - 1
    for k in range(max(sizes, default=0)):
        h = (h + data[np.minimum(starts + k, last)].astype(np.uint64) + np.uint64(1)) * np.uint64(0x100000001B3)
        if k + 1 in sizes:
            hashed = mix(h + np.uint64((k + 1) * int(_P) % 2**64))
            out.append(np.where(ends - starts > k, np.maximum(hashed, np.uint64(1)), np.uint64(0)))
    return out
