"""64-bit hashes of words and of runs of words, for whole texts at once in numpy.

A run's hash is a polynomial modulo 2**64, taken from running sums, so every run of any length costs
one subtraction. Words are runs of bytes, and runs of words are runs of word hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK_BYTES = 1 << 20

# Odd multipliers of the polynomial hashes (arbitrary 64-bit numbers) and their inverses.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1B54A32D192ED03
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse, as many as asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate(
                [self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))]
            )
        return self.up[:n], self.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


def run_hashes(values: np.ndarray, firsts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of values[first:end] for every pair, equal for equal runs wherever they stand."""
    up, down = powers.of(len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    return mixed((sums[ends] - sums[firsts]) * down[firsts])


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_hashes_of(
    texts: Iterable[str | None], powers: Powers, lower: bool = False
) -> Iterator[np.ndarray]:
    """64-bit hashes of the words of every text, in order; `lower` reads A-Z as a-z.

    Texts are hashed together, about `CHUNK_BYTES` at a time.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= CHUNK_BYTES:
            yield from _hashed(held, powers, lower)
            held, size = [], 0
    yield from _hashed(held, powers, lower)


def _hashed(texts: list[bytes], powers: Powers, lower: bool) -> list[np.ndarray]:
    if not texts:
        return []
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_space(data)
    change = np.flatnonzero(inside[1:] != inside[:-1])
    hashes = run_hashes(data.astype(np.uint64) + np.uint64(1), change[::2], change[1::2], powers)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    cuts = np.searchsorted(change[::2], starts)
    return [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
