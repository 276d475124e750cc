"""A minimal perfect hash over 64-bit keys, with a fingerprint kept for each key.

Level by level, keys hash into a bit array; a bit is set where exactly one key lands, and the
others go on to the next level.  A key's slot is the number of set bits before its own, so n keys
fill the slots 0 to n - 1 without gaps at about three bits a key.  Bits lie in words of 64, and a
directory holds the number of set bits before each word.  A lookup reads one word and one
number of the directory per level, of which it passes two on average, however many keys there are; the
fingerprint in the slot tells foreign keys apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS_PER_KEY = 2
MAX_LEVELS = 64
_U64 = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits per key (the splitmix64 finaliser)."""
    x = keys.astype(_U64) + _U64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys, level) % _U64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits per key, independent of its places."""
    return (mix(keys, MAX_LEVELS + 1) >> _U64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """``sizes``: bits of each level; ``words``: all levels, 64 bits each; ``ranks``: set bits before each word;
    ``prints``: one per slot."""

    sizes: np.ndarray
    words: np.ndarray
    ranks: np.ndarray
    prints: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """The index of distinct keys."""
        rest, sizes, levels = keys.astype(_U64), [], []
        while len(rest):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = len(rest) * BITS_PER_KEY + 1
            places = _place(rest, len(sizes), size)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            rest = rest[~alone[places]]
        bits = np.concatenate([*levels, np.zeros(-sum(sizes) % 64, bool)])
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        index = cls(np.array(sizes, np.int64), words, ranks, np.zeros(len(keys), np.uint32))
        index.prints[index._slots(keys)] = fingerprints(keys)
        return index

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has its bit."""
        slots, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            places = base + _place(keys[open_], level, size)
            at, bit = places >> 6, (places & 63).astype(_U64)
            words = self.words[at]
            hit = (words >> bit) & _U64(1) == 1
            before = np.bitwise_count(words & ((_U64(1) << bit) - _U64(1)))
            slots[open_[hit]] = (self.ranks[at] + before)[hit]
            open_, base = open_[~hit], base + size
        return slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that the index does not hold."""
        keys = keys.astype(_U64)
        slots = self._slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprints(keys[known])
        return np.where(known, slots, -1)
