"""Shingle sets and fast similarity sketches of a batch of texts, with numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

COORDINATES = 160
_CACHE_WORDS = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hashes of the words seen so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


class Shingler:
    """Distinct word shingles of a text as a sorted array of 64-bit hashes.

    A-Z become small letters; words are runs without ``[\\x20\\x09-\\x0D]``. Fewer words than ``width`` make one
    shingle of them all, no words make none.
    """

    def __init__(self, width: int):
        self.width, self.hashes = width, _Hashes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(h))
        last = len(h) - width + 1
        shingle = h[:last]
        for j in range(1, width):
            shingle = mixed(shingle) + h[j:last + j]
        return np.unique(mixed(shingle + np.uint64(width)))


def sketches(sets: Iterable[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A row of ``t`` coordinates for each set; two sets agree in a coordinate with the probability of their Jaccard
    index. Empty sets have no meaning here.

    Rounds 0 .. t-1 throw every element into a hashed bin, rounds t .. 2t-1 throw every element into bin
    (round - t), so that no coordinate stays empty; a bin keeps its smallest value, and earlier rounds come first. A set
    takes part only until its bins are full: after one or two rounds for sets much larger than t.
    """
    sets = list(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    bins = np.full(len(sets) * t, np.iinfo(np.uint64).max, np.uint64)
    if not len(sets) or not sizes.sum():
        return bins.reshape(len(sets), t)
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    for k in range(2 * t):
        h = mixed(elements + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = (h % np.uint64(t)).astype(np.int64) if k < t else np.full(len(h), k - t)
        # The bin comes from the hash modulo t; the value is an independent scramble of it, below the round's number.
        value = (mixed(h) >> np.uint64(10)) | np.uint64(k << 54)
        np.minimum.at(bins, owner * t + at, value)
        open_sets = (bins.reshape(len(sets), t) == np.iinfo(np.uint64).max).any(axis=1)
        more = open_sets[owner]
        if not more.any():
            break
        elements, owner = elements[more], owner[more]
    return bins.reshape(len(sets), t)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for every band of ``rows`` coordinates, different from band to band."""
    docs, t = sketch.shape
    parts = sketch.reshape(docs, t // rows, rows)
    key = np.broadcast_to(np.arange(t // rows, dtype=np.uint64), parts.shape[:2])
    for j in range(rows):
        key = mixed(key + parts[:, :, j])
    return key.view(np.int64)
