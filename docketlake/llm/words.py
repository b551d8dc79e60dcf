"""64-bit hashes of the words of many texts at once. Words are runs of bytes that are no ASCII white space; A-Z count as a-z."""

from __future__ import annotations

import functools

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _bytes_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for every byte, A-Z as a-z; which bytes are white space; numbers for places in a word."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
    values[65:91] = values[97:123]
    white = np.zeros(256, dtype=bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    return values, white, mix(np.arange(1_000, 5_096, dtype=np.uint64) * _GOLD) | np.uint64(1)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, first word of each text (one more at the end), and each word's first and last byte in its text's UTF-8."""
    parts = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
    values, white, places = _bytes_table()
    if not len(data):
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64), empty, empty
    inside = ~white[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = ends - starts
    letters = np.flatnonzero(inside)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    if len(sizes) and sizes.max() > len(places):
        places = mix(np.arange(1_000, 1_000 + int(sizes.max()), dtype=np.uint64) * _GOLD) | np.uint64(1)
    found = np.add.reduceat(values[data[letters]] * places[place], first) if len(first) else np.empty(0, np.uint64)
    hashes = mix(found + sizes.astype(np.uint64) * _GOLD)
    lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    at = np.cumsum(lengths) - lengths
    bounds = np.append(np.searchsorted(starts, at), len(starts))
    base = np.repeat(at, np.diff(bounds))
    return hashes, bounds, starts - base, ends - base


@functools.cache
def _factors(n: int) -> np.ndarray:
    return mix(np.arange(9_000, 9_000 + n, dtype=np.uint64) * _GOLD) | np.uint64(1)


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


@functools.lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    told = []
    for base in (BASE, inverse):
        x = np.full(n, base, dtype=np.uint64)
        x[0] = 1
        told.append(np.cumprod(x, dtype=np.uint64))
    return told[0], told[1]


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, in order; of the whole sequence where there are fewer; none without words."""
    size = min(n, len(words))
    if not size:
        return np.empty(0, np.uint64)
    if n >= 16:  # long runs by differences of prefix sums
        up, down = (x[: len(words)] for x in _powers(1 << max(12, (len(words) - 1).bit_length())))
        sums = np.append(np.uint64(0), np.cumsum(words * up, dtype=np.uint64))
        return mix((sums[size:] - sums[:-size]) * down[: len(words) - size + 1] + np.uint64(size))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k, factor in enumerate(_factors(size)):
        out += words[k : len(words) - size + 1 + k] * factor
    return mix(out + np.uint64(size))
