"""Minimal perfect hashing: n keys to the slots 0 .. n - 1, a few bits per key, no keys stored.

Every level is a bit map. A key whose position no other key shares sets its bit and is done; the rest go to the
next level under another hash. A key's slot is the number of bits set before its own, so a lookup costs a few
probes whatever n is. A foreign key may hit a bit too: callers store fingerprints to tell.
"""

from __future__ import annotations

import numpy as np
import xxhash

GAMMA = 2.0
LEVELS = 64


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """(n, 2) words of a 128-bit hash."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(k) for k in keys), "<u8").reshape(-1, 2)


def positions(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    x = hashes[:, 0] + np.uint64(level) * (hashes[:, 1] | np.uint64(1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


class MinimalPerfectHash:
    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> "MinimalPerfectHash":
        if len(np.unique(hashes, axis=0)) != len(hashes):
            raise ValueError("keys must be distinct")
        sizes, maps, left = [], [], hashes
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, int(GAMMA * len(left)))
            at = positions(left, level, size)
            alone = np.bincount(at, minlength=size)
            sizes.append(size)
            maps.append(alone == 1)
            left = left[alone[at] != 1]
        if len(left):
            raise ValueError("keys did not separate")
        return cls(np.array(sizes, "<u4"), np.concatenate(maps) if maps else np.zeros(0, bool))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for a key that hits no bit (and is surely foreign)."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = positions(hashes[open_], level, int(size)) + self.starts[level]
            hit = self.bits[at]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        return np.uint32(len(self.sizes)).tobytes() + self.sizes.astype("<u4").tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "MinimalPerfectHash":
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        sizes = np.frombuffer(raw, "<u4", n, 4)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=4 + 4 * n)).astype(bool)
        return cls(sizes, bits[:int(sizes.sum())])
