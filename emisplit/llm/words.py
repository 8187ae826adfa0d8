"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word's hash is a polynomial over its bytes, taken from prefix sums over the
whole buffer, so no Python code runs per word. Hashes depend on the bytes alone
and are the same in every process.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x5851F42D4C957F2D
_PIECE = 1 << 20

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return values ^ (values >> np.uint64(32))


def seeds(count: int, key: int) -> np.ndarray:
    """``count`` odd 64-bit constants."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * _ODD + np.uint64(key)) | np.uint64(1)


def byte_table(is_word, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(which bytes belong to words, a random value per byte; A-Z as a-z if ``lower``)."""
    member = np.array([bool(is_word(b)) for b in range(256)])
    values = seeds(256, 77)
    if lower:
        values[65:91] = values[97:123]
    return member, values


#: Words between ASCII white space, and runs of letters, digits and non-ASCII characters.
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def _geometric(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _grow(count: int) -> None:
    global _powers, _inverse
    if len(_powers) < count:
        size = 1 << (count - 1).bit_length()
        _powers = _geometric(_BASE, size)
        _inverse = _geometric(pow(_BASE, -1, 1 << 64), size)


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a word ends with its row."""
    inside = member[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of each word, worked out in pieces of bounded memory."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _PIECE, "right")))
        low, high = starts[first], ends[last - 1]
        _grow(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * _powers[: high - low], out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mixed((sums[b] - sums[a]) * _inverse[a] + (b - a).astype(np.uint64))
        first = last
    return out


def hashed_words(data: np.ndarray, offsets: np.ndarray, table=SPACED) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of the first word of each row and the total)."""
    starts, ends = spans(data, offsets, table[0])
    return hashes(data, starts, ends, table[1]), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on; empty if there are fewer."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, width, np.uint64)
    for i, factor in enumerate(seeds(width, 1000 + width)):
        total += words[i : i + count] * factor
    return mixed(total)
