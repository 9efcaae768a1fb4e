"""Sets of word shingles and their circulant MinHash signatures, in arrays."""

from __future__ import annotations

import numpy as np

from .rolling import RunHashes, mixed

WORDS = 5
UNIVERSE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C55)
_BACK = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, size: int) -> None:
        if size > len(self.up):
            size = max(size, 2 * len(self.up))
            self.up = np.full(size, _BASE)
            self.down = np.full(size, _BACK)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)


_POWERS = Powers()


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes; equal stretches have equal ones.

    Meant for short stretches: among those of a thousand bytes there are some
    of two letters that this polynomial confuses."""
    _POWERS.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    np.cumsum(codes * _POWERS.up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _POWERS.down[starts])


def shingle_set(text: str, words: int = WORDS, hashing: RunHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``words`` words.

    Words are runs of characters other than ASCII spaces, A-Z lower-cased.  A
    shorter text is one run; a text without words is an empty set.
    """
    split = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not split:
        return np.zeros(0, np.uint64)
    hashing = hashing or RunHashes()
    sums = hashing.sums(hashing.words(split))
    starts = np.arange(max(1, len(split) - words + 1))
    return np.unique(hashing.runs(sums, starts, starts + min(words, len(split)), slice(0, 1)))


class CirculantMinHash:
    """Signatures from two permutations of a universe of 2^20 places.

    The first scatters the set; the second gives every coordinate its order of
    the places, shifted by one place more for each coordinate.
    """

    def __init__(self, coordinates: int, seed: int = 1):
        draw = np.random.RandomState(seed)
        self.scatter = draw.permutation(UNIVERSE).astype(np.int32)
        order = draw.permutation(UNIVERSE).astype(np.int32)
        around = np.concatenate([order, order[:coordinates]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(around, coordinates)
        self.coordinates = coordinates

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The least place over the set, for every shift; the set is not empty."""
        places = self.scatter[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)]
        least = np.full(self.coordinates, UNIVERSE, np.int32)
        for at in range(0, len(places), 256):
            np.minimum(least, self.shifted[places[at : at + 256]].min(axis=0), out=least)
        return least


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` neighbouring coordinates."""
    bands = signature.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(bands), dtype=np.uint64)
    for column in bands.T:
        key = mixed(key * _BASE + column + np.uint64(1))
    return key
