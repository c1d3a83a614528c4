"""Words of many texts at once, as arrays: places, hashes and shingles, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

SLICE_BYTES = 1 << 19

# ASCII white space and the lower case of A-Z
IS_SPACE = np.zeros(256, np.uint8)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _ODD)


_BYTE = numbers(256, 1)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + (1 << 16)), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


@dataclass
class Words:
    """The words of some texts: byte places in ``raw``, the range of words of each text."""

    raw: np.ndarray  # all texts, each followed by a line end
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per text, its first word
    last: np.ndarray  # per text, the word after its last

    @staticmethod
    def of(texts: list[bytes]) -> Words:
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        edges = np.diff(IS_SPACE[raw].view(np.int8), prepend=np.int8(1))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        last = np.searchsorted(starts, text_ends)
        return Words(raw, starts, ends, np.concatenate([np.zeros(1, np.int64), last[:-1]]), last)

    def hashes(self) -> np.ndarray:
        """64 bits of every word, with A-Z in lower case."""
        n = len(self.raw)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[LOWER[self.raw]] * _power(_BASE, n), out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * _power(_BASE_INVERSE, n)[self.starts])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle of ``size`` words, by text and hash.

    A text with fewer words has its whole sequence as one shingle; a text without words has none.
    """
    hashes = words.hashes()
    n = len(hashes)
    factors = numbers(size, 2)
    rolled = np.zeros(n, np.uint64)
    lengths = words.last - words.first
    starts = np.maximum(lengths - size + 1, 0)
    for j in range(size):
        rolled[: max(n - j, 0)] += hashes[j:] * factors[j]
    place = np.repeat(words.first - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
    text = np.repeat(np.arange(len(lengths)), starts)
    value = mixed(rolled[place])
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        whole = [np.sum(hashes[words.first[t] : words.last[t]] * factors[: lengths[t]], dtype=np.uint64) for t in short]
        text = np.concatenate([text, short])
        value = np.concatenate([value, mixed(np.array(whole, np.uint64) + lengths[short].astype(np.uint64))])
    order = np.argsort(value)
    order = order[np.argsort(text[order].astype(np.int32), kind="stable")]
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def slices(rows: Iterable[tuple[int | None, bytes]], limit: int = SLICE_BYTES) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Keys and texts, about ``limit`` bytes at a time; a longer text comes alone."""
    keys: list[int | None] = []
    texts: list[bytes] = []
    size = 0
    for key, text in rows:
        if keys and size + len(text) > limit:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(key)
        texts.append(text)
        size += len(text)
    if keys:
        yield keys, texts
