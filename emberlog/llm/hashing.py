"""Polynomial hashes of all words or windows of a block of texts at once, in numpy.

Texts are laid out in one byte array. A running sum of bytes times powers of an odd base, modulo 2^64,
gives the hash of any piece by one subtraction and one multiplication with the inverse power.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1
_U = np.uint64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse from 0 to ``size``; kept per process."""
    known = _powers.get(base)
    if known is None or len(known[0]) <= size:
        length = max(size + 1, (1 << 20) + (1 << 16))
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(length, b, _U)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=_U))
        known = _powers[base] = tuple(pair)
    return known


def running(data: np.ndarray, base: int) -> np.ndarray:
    """Running sums: entry ``i`` covers the first ``i`` bytes."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(base, len(data))[0][:len(data)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits over the word."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def pieces(sums: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the pieces from ``starts`` to ``ends``; equal pieces of equal length have equal hashes."""
    return mixed((sums[ends] - sums[starts]) * powers(base, len(sums))[1][starts] + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))


def layout(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a block and their ``len + 1`` offsets; a null text is empty."""
    texts = [b"" if t is None else t.encode() for t in column.to_pylist()]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, A-Z in lower case, and the number of words up to each text: ``len + 1`` ends."""
    data, offsets = layout(column)
    data = _LOWER[data]
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]  # a word never runs on into the next text
    ends[edges - 1] = inside[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return pieces(running(data, BASES[0]), BASES[0], starts, stops), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text; of a shorter text its whole word sequence."""
    words, ends = word_hashes(column)
    weights = [_U(pow(BASES[1], i + 1, 1 << 64)) for i in range(k)]
    count = max(len(words) - k + 1, 0)
    rolled = np.zeros(count, _U)
    for i in range(k):
        rolled += words[i:i + count] * weights[i]
    rolled = mixed(rolled)
    out = []
    for start, end in zip(ends[:-1], ends[1:]):
        if end - start >= k:
            out.append(np.unique(rolled[start:end - k + 1]))
        elif end > start:
            total = sum(int(w) * int(weights[i]) for i, w in enumerate(words[start:end])) + int(end - start) * 0xD6E8FEB86659FD93
            out.append(mixed(np.array([total & _MASK], _U)))
        else:
            out.append(np.empty(0, _U))
    return out
