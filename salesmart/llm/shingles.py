"""Word shingles of many texts at once, as 64-bit numbers, and signatures of the sets."""

from __future__ import annotations

import numpy as np

# Fixed value: which bytes separate words.
_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEPS = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z in lower case, and where each text's words start."""
    joined = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    lower = joined + np.where((joined >= 65) & (joined <= 90), np.uint8(32), np.uint8(0))
    separates = _SEPARATES[joined]
    edges = np.diff(separates.astype(np.int8))
    starts, ends = np.nonzero(edges == -1)[0] + 1, np.nonzero(edges == 1)[0] + 1
    values = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(joined)), out=values[1:])
    hashes = mixed((values[ends] - values[starts]) * _powers(_BASE_INVERSE, len(joined))[starts])
    text_starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, text_starts)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of ``width`` words of each text.

    A text of fewer words is one shingle, the whole sequence; one without words has none.
    """
    hashes, starts = word_hashes(texts)
    rolled = hashes.copy()
    for i in range(1, width):
        ahead = hashes[i:]
        rolled[: len(ahead)] = rolled[: len(ahead)] * _STEPS[(i - 1) % 3] + ahead
    rolled = mixed(rolled)
    out = []
    for first, last in zip(starts[:-1], starts[1:], strict=True):
        if last - first >= width:
            out.append(np.unique(rolled[first : last - width + 1]))
        elif last > first:
            whole = hashes[first : first + 1]
            for i in range(first + 1, last):
                whole = whole * _STEPS[(i - first - 1) % 3] + hashes[i : i + 1]
            out.append(mixed(whole ^ np.uint64(last - first)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


class MinHash:
    """Signatures of ``positions`` values of 16 bits: of each of as many hashes, the smallest over the set, cut down."""

    def __init__(self, positions: int, seed: int):
        random = np.random.default_rng(seed)
        self.factors = random.integers(0, 2**63, positions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.terms = random.integers(0, 2**63, positions, dtype=np.uint64)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row per set; the sets must not be empty."""
        joined = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        out = np.empty((len(sets), len(self.factors)), dtype=np.int32)
        for i, (factor, term) in enumerate(zip(self.factors, self.terms, strict=True)):
            smallest = np.minimum.reduceat(mixed_once(joined * factor + term), starts)
            out[:, i] = (mixed(smallest) & np.uint64(0xFFFF)).astype(np.int32)
        return out


def mixed_once(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(29))
