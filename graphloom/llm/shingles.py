"""Vectorised word-shingle hashes over raw UTF-8 bytes (numpy, bounded memory)."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time; a longer text is cut between words, so its memory stays bounded too.
CHUNK = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_VALUE_LOWER = _VALUE[_LOWER]


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_STEP = np.uint64(_inverse(int(_BASE)))
_NEGATIVE_POWERS = np.ones(1, np.uint64)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base^i, base^-i) mod 2^64 for i < n."""
    global _POWERS, _NEGATIVE_POWERS
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, np.uint64)]), dtype=np.uint64)
        _NEGATIVE_POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _STEP, np.uint64)]), dtype=np.uint64)
    return _POWERS[:n], _NEGATIVE_POWERS[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunk_hashes(data: np.ndarray) -> np.ndarray:
    gap = _SEPARATOR[data]
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    if len(edge) == 0:
        return np.zeros(0, np.uint64)
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE_LOWER[data] * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: bytes | memoryview | np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word of a UTF-8 text with A-Z lowered; words are runs of non-white-space."""
    data = np.frombuffer(data, np.uint8) if not isinstance(data, np.ndarray) else data
    if len(data) <= CHUNK:
        return _chunk_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data):  # on to the next white space, so that no word is cut
            ahead = np.flatnonzero(_SEPARATOR[data[end : end + CHUNK]])
            if len(ahead):
                end += int(ahead[0])
                break
            end = min(end + CHUNK, len(data))
        parts.append(_chunk_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes (so signed order is hash order) of all ``n``-word shingles; with fewer words the whole sequence is one."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = mix(h + words[k : len(words) - n + 1 + k] + np.uint64(k + 1))
    return np.unique(h >> np.uint64(1))
