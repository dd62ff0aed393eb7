"""Minimal perfect hashing of 64-bit keys, in vectorised numpy.

Levels of bits: a key sets the bit it hashes to if no other key of its level does; keys that meet go on to the next level. The
number of a key is the number of bits set before its own, so n keys get the numbers 0 to n - 1 and a key costs about four
bits. A key that was not among them may get any number, so who needs to know keeps the keys by number and compares.
"""

from __future__ import annotations

import numpy as np

#: Bits of a level for each key that is left.
SPARE = 2.0


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Bijective scrambling of 64-bit keys, another one for every level."""
    x = keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalHash:
    """Numbers 0 to n - 1 for n different keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [int(x.sum()) for x in levels]
        starts = np.cumsum([0, *ones])
        self.ranks = [start + np.cumsum(x) - x for start, x in zip(starts, levels)]
        self.size = int(starts[-1])

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        """Hash of different unsigned 64-bit keys."""
        left, levels = keys.astype("u8"), []
        while len(left):
            n_bits = max(8, int(SPARE * len(left)))
            at = mixed(left, len(levels)) % np.uint64(n_bits)
            met = np.bincount(at.astype("i8"), minlength=n_bits)
            levels.append(met == 1)
            left = left[met[at.astype("i8")] > 1]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of every key, -1 for one that surely was not among those the hash was made of."""
        keys = keys.astype("u8")
        out, left = np.full(len(keys), -1, "i8"), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = (mixed(keys[left], level) % np.uint64(len(bits))).astype("i8")
            own = bits[at]
            out[left[own]] = ranks[at[own]]
            left = left[~own]
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u8")
        return sizes.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> MinimalHash:
        n = int(np.frombuffer(data, "<u8", 1)[0])
        sizes = np.frombuffer(data, "<u8", n, 8).astype("i8").tolist()
        levels, at = [], 8 * (n + 1)
        for size in sizes:
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, "u1", width, at), count=size).astype(bool))
            at += width
        return cls(levels)
