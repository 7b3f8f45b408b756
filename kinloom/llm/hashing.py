"""64-bit hashes of numbers, ranges and words, computed over whole arrays."""

from __future__ import annotations

import numpy as np

P1, P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def _powers_of(name: str, of: np.uint64, n: int) -> np.ndarray:
    """``of`` to the powers 0 to n - 1, modulo 2^64; kept for the next call."""
    if len(_powers[name]) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        _powers[name] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, of)], dtype=np.uint64)
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * P1
    x = (x ^ (x >> np.uint64(29))) * P2
    return x ^ (x >> np.uint64(32))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two columns of 64-bit numbers."""
    return mix(mix(a.astype(np.uint64) + P2) + b.astype(np.uint64) * P1)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of values[s:e] for each s and e: equal ranges have equal hashes, wherever they stand."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers_of("base", _BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers_of("inverse", _INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64) * P2)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    x = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    return range_hashes(_BYTE[x], ends - lengths, ends)
