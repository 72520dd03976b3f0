"""Word shingles of a text as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_MASK = (1 << 64) - 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.n = 0
        self.up = self.down = np.empty(0, np.uint64)

    def reach(self, n: int) -> None:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 14)
            self.up = np.full(self.n, BASE, np.uint64)
            self.down = np.full(self.n, pow(BASE, -1, 1 << 64), np.uint64)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(text: str, powers: Powers) -> np.ndarray:
    """One number per word ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[raw], [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    powers.reach(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers.up[:len(raw)], out=total[1:])
    return mixed((total[end] - total[start]) * powers.down[start])


def shingle_numbers(text: str | None, size: int, powers: Powers) -> np.ndarray:
    """The distinct shingles of ``size`` words, sorted; the whole word sequence where it is shorter; none without words."""
    words = word_numbers(text or "", powers)
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(BASE) + words[i:len(words) - size + 1 + i])
    return np.unique(out)
