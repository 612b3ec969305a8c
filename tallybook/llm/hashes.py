"""Hashes of words and of runs of words with numpy, for many texts at once.

A word's hash is the sum of table[byte] * base**i modulo 2**64, finished by a mixer; the sum over any stretch is the
difference of two prefix sums. A run of words is hashed the same way from the hashes of its words. Different seeds
give independent hashes; two of them make 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallybook.llm.common import SPACES

#: Texts are hashed in blocks of about so many bytes, to bound memory.
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; a plain sort is several times faster here than numpy's own function."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


_BASES: dict[int, tuple[np.ndarray, int, int]] = {}
_POWERS: dict[int, np.ndarray] = {}


def _base(seed: int) -> tuple[np.ndarray, int, int]:
    """Table of random values for bytes, a base congruent to 3 modulo 4, and the base's inverse."""
    if seed not in _BASES:
        random = np.random.Generator(np.random.PCG64(0x7A11 + seed))
        table = random.integers(0, 1 << 64, 256, np.uint64)
        base = int(random.integers(0, 1 << 62)) * 4 + 3
        _BASES[seed] = table, base, pow(base, -1, 1 << 64)
    return _BASES[seed]


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; only those a usual block needs are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, BLOCK + (1 << 16))
        steps = np.full(size, base, np.uint64)
        steps[:1] = 1
        known = np.multiply.accumulate(steps)
        if size <= 2 * BLOCK:
            _POWERS[base] = known
    return known[:n]


def _block_words(data: bytes, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    table, base, inverse = _base(seed)
    a = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(a) + 2, bool)
    np.logical_not(_SPACE[a], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(table[a] * _powers(base, len(a)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(inverse, len(a) + 1)[starts]), starts


def cuts(data: bytes) -> Iterator[bytes]:
    """data in blocks that end before a white space."""
    at = 0
    while len(data) - at > BLOCK:
        end = at + BLOCK
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def words(data: bytes, seed: int = 0) -> np.ndarray:
    """The hashes of the words of one text, in order."""
    return np.concatenate([_block_words(x, seed)[0] for x in cuts(data)])


def flat_words(texts: list[bytes], seed: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Short texts hashed together: number of the first text, all word hashes, and where each text's words begin.

    The last of the places is the number of words.
    """
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at]) + 1
        if size > BLOCK:
            hashes = words(texts[at], seed)
            yield at, hashes, np.array([0, len(hashes)])
            at = end
            continue
        while end < len(texts) and size + len(texts[end]) < BLOCK:
            size += len(texts[end]) + 1
            end += 1
        group = texts[at:end]
        hashes, starts = _block_words(b" ".join(group), seed)
        first = np.cumsum([0] + [len(x) + 1 for x in group])
        yield at, hashes, np.searchsorted(starts, first)
        at = end


def words_of(texts: list[bytes], seed: int = 0) -> Iterator[np.ndarray]:
    """The hashes of the words of each text; short texts are hashed together."""
    for _, hashes, places in flat_words(texts, seed):
        yield from np.split(hashes, places[1:-1])


def stretches(word_hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """The hash of each stretch of words from starts up to ends."""
    n = len(word_hashes)
    _, base, inverse = _base(seed)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hashes * _powers(base, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(inverse, n + 1)[starts])


def runs(word_hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The hash of each run of `length` consecutive words; empty if there are fewer words."""
    starts = np.arange(max(0, len(word_hashes) - length + 1))
    return stretches(word_hashes, starts, starts + length, seed)
