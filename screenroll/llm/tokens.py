"""Word and n-gram hashes of texts with numpy: no Python object per word.

Words are runs of bytes other than ASCII white space. A word's hash is a polynomial over random
byte values modulo 2**64, so it depends on the word alone and all words of a text come out of one
running sum. Hashes serve to find candidates and to name sets; where a result rests on equality,
two independent hashes (128 bits) or the words themselves are compared.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a text that are hashed at a time; bounds what a worker holds of very long texts.
CHUNK = 1 << 20
_RNG = np.random.default_rng(20240517)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base modulo 2**64, remembered up to the chunk size."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        if n <= CHUNK:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunk_words(data: np.ndarray, lower: bool, gap: np.ndarray) -> tuple[np.ndarray, ...]:
    word = ~gap[data]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _VALUE)[data] * powers(_BASE, len(data)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data))[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts, ends


def prefix_hashes(text: bytes, starts: np.ndarray, k: int, lower: bool = False) -> np.ndarray:
    """Hashes of the ``k`` bytes from each position on."""
    data = np.frombuffer(text, np.uint8)
    out = np.full(len(starts), k, np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + (_LOWER if lower else _VALUE)[data[starts + i]]
    return mix(out)


def words_at(text: bytes, lower: bool = False, plain: bool = False) -> tuple[np.ndarray, ...]:
    """Hashes, first and end bytes of the words of a text, in order.

    ``lower`` folds A-Z; with ``plain`` all ASCII other than letters and digits separates words.
    """
    gap = _PLAIN if plain else _SPACE
    data, parts, start = np.frombuffer(text, np.uint8), [], 0
    while start < len(data) or not parts:
        stop = start + CHUNK
        while stop < len(data):
            gaps = np.flatnonzero(gap[data[stop:stop + CHUNK]])
            if len(gaps):
                stop += int(gaps[0])
                break
            stop += CHUNK
        hashes, first, end = _chunk_words(data[start:min(stop, len(data))], lower, gap)
        parts.append((hashes, first + start, end + start))
        start = stop
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def word_hashes(text: bytes, lower: bool = False, plain: bool = False) -> np.ndarray:
    """Hashes of the words of a text in order."""
    return words_at(text, lower, plain)[0]


def ngram_hashes(words: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order."""
    count = len(words) - n + 1
    if count <= 0:
        return words[:0]
    out = np.full(count, seed, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[i:i + count]
    return mix(out)


def window_hashes(words: np.ndarray, n: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """Hashes of all runs of ``n`` words by a running sum, for long runs."""
    count = len(words) - n + 1
    if count <= 0:
        return words[:0]
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(inverse, len(words))[:count])
