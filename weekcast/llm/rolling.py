"""Hashes of all runs of words of a text, in arrays.

A word is two 64-bit halves of a keyed 128-bit hash; a run of words is a
polynomial over them in two odd bases modulo 2^64.  What such a polynomial is
known to confuse are long sequences of two symbols; over the hashes of whole
words and over short runs that leaves more than 70 of 128 bits.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

#: Odd numbers without structure, one for each half.
BASES = (0x9E3779B97F4A7C55, 0xD1342543DE82EF95)
KEPT_WORDS = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing steps of a common generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class _Places(dict):
    """Words by their first appearance."""

    def __init__(self) -> None:
        super().__init__()
        self.digests: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.digests.append(blake2b(word, digest_size=16, key=b"words").digest())
        return place


class RunHashes:
    """Hashes of runs of words; a task keeps one and so hashes a word once."""

    def __init__(self) -> None:
        self._forget()
        self.up = self.down = np.ones((1, 2), np.uint64)

    def _forget(self) -> None:
        self.places, self.table = _Places(), np.zeros((0, 2), np.uint64)

    def _reach(self, size: int) -> None:
        if size > len(self.up):
            size = max(size, 2 * len(self.up))
            self.up, self.down = np.ones((size, 2), np.uint64), np.ones((size, 2), np.uint64)
            for half, base in enumerate(BASES):
                self.up[1:, half] = base
                self.down[1:, half] = pow(base, -1, 1 << 64)
            np.cumprod(self.up, axis=0, out=self.up)
            np.cumprod(self.down, axis=0, out=self.down)

    def words(self, words: list[bytes]) -> np.ndarray:
        """Both halves of every word's hash."""
        if len(self.places) > KEPT_WORDS:
            self._forget()
        places = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        if self.places.digests:
            fresh = np.frombuffer(b"".join(self.places.digests), np.uint64).reshape(-1, 2)
            known = len(self.places) - len(fresh)
            if len(self.places) > len(self.table):
                grown = np.zeros((max(1024, 2 * len(self.places)), 2), np.uint64)
                grown[:known] = self.table[:known]
                self.table = grown
            self.table[known : len(self.places)] = fresh
            self.places.digests.clear()
        return self.table[places]

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        """What ``runs`` needs to know of a text's words."""
        self._reach(len(hashes) + 1)
        sums = np.zeros((len(hashes) + 1, 2), np.uint64)
        np.cumsum(hashes * self.up[: len(hashes)], axis=0, out=sums[1:])
        return sums

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, halves: slice = slice(None)) -> np.ndarray:
        """The hash of the words from each start up to its end."""
        return mixed((sums[ends, halves] - sums[starts, halves]) * self.down[starts, halves])
