"""Anchors for 64-bit fingerprints: covering codes, and who has to visit which anchor.

A fingerprint is cut into ``parts``.  Two fingerprints that differ in at most ``distance`` bits
differ in at most ``distance // parts`` bits of some part.  On each part the anchors are the
words of a covering code: the binary Golay code (any 23-bit word is within radius 3 of exactly
one code word), extended by plain bits where a part is longer and cut by fixed zeros where it is
shorter.  The home of a part is its nearest anchor.  If x and y differ in at most t bits there, y
is within radius + t of x's home, so it is enough that every fingerprint visits all anchors
within radius + t and is compared with those at home there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np

GOLAY_BITS, GOLAY_RADIUS = 23, 3
GOLAY_POLYNOMIAL = 0xAE3  # x^11+x^9+x^7+x^6+x^5+x+1


def _syndromes(words: np.ndarray) -> np.ndarray:
    """The remainder of each word by the generator polynomial: 0 for code words."""
    rest = words.astype(np.int64).copy()
    for bit in range(GOLAY_BITS - 1, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY_POLYNOMIAL << (bit - 11), 0)
    return rest


@lru_cache(maxsize=8)
def _offsets(extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome the differences to all code words within radius + extra.

    Differences sorted by syndrome and weight, where each syndrome starts (one more at the end),
    and how far each difference exceeds the radius.
    """
    masks = [
        sum(1 << bit for bit in bits)
        for weight in range(GOLAY_RADIUS + extra + 1)
        for bits in combinations(range(GOLAY_BITS), weight)
    ]
    words = np.array(masks, np.int64)
    of = _syndromes(words)
    order = np.argsort(of, kind="stable")  # lighter differences first, the nearest code word first
    starts = np.searchsorted(of[order], np.arange(2049))
    over = np.maximum(np.bitwise_count(words[order]).astype(np.int64) - GOLAY_RADIUS, 0)
    return words[order], starts, over


def _flips(bits: int, most: int) -> list[int]:
    return [sum(1 << b for b in some) for n in range(most + 1) for some in combinations(range(bits), n)]


@dataclass(frozen=True)
class Covering:
    """How 64-bit fingerprints meet.  Fewer parts mean finer anchors but more visits.

    With 3 parts and distance 4 a fingerprint makes about 16 visits to 3 * 4,096 anchors, with 2
    parts about 210 visits to 2 * 2,097,152.
    """

    parts: int = 3
    distance: int = 4

    def widths(self) -> list[int]:
        return [64 * (i + 1) // self.parts - 64 * i // self.parts for i in range(self.parts)]

    def visits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in prints, anchor, whether the anchor is the print's home) for every visit."""
        within = self.distance // self.parts
        places, anchors, homes = [], [], []
        shift = 0
        for part, width in enumerate(self.widths()):
            word = (prints >> np.uint64(shift) & np.uint64(2**width - 1)).astype(np.int64)
            shift += width
            plain = max(0, width - GOLAY_BITS)
            core, rest = word >> plain, word & ((1 << plain) - 1)
            differences, starts, over = _offsets(within)
            of = _syndromes(core)
            counts = starts[of + 1] - starts[of]
            place = np.repeat(np.arange(len(prints)), counts)
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            pick = starts[of[place]] + nth
            code = core[place] ^ differences[pick]
            for flip in _flips(plain, within):
                ok = over[pick] + flip.bit_count() <= within
                places.append(place[ok])
                anchors.append(((code[ok] << plain | (rest[place[ok]] ^ flip)) * self.parts) + part)
                homes.append((nth[ok] == 0) & (flip == 0))
        return np.concatenate(places), np.concatenate(anchors), np.concatenate(homes)
