"""Minimal perfect hash of distinct 64-bit keys (cascade of bit arrays) with an entry per key.

Level by level, each key left over hashes into as many bits as there are keys; bits hit exactly once
are set and their keys leave. A key's number is the rank of its bit over all levels: n keys get the
numbers 0..n-1. About three bits a key; a lookup probes 1.6 levels on average.
"""

from __future__ import annotations

import struct

import numpy as np

from bluelines.llm.shingles import mix

MAGIC = b"BLMPH001"
ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("ordinal", "<u8"), ("copies", "<u4")])
_U = np.uint64


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + _U((0x9E3779B97F4A7C15 * (level + 1)) % 2**64))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1 << 20) >> _U(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # one bool array per level
        before = np.concatenate([[0], np.cumsum([int(x.sum()) for x in levels])])
        self.rank = [np.cumsum(x) - 1 + b for x, b in zip(levels, before)]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """``keys`` must be distinct."""
        levels, left = [], np.asarray(keys, np.int64)
        while len(left):
            at = (_hash(left, len(levels)) % _U(len(left))).astype(np.int64)
            once = np.bincount(at, minlength=len(left)) == 1
            levels.append(once)
            left = left[~once[at]]
            if len(levels) > 500:
                raise ValueError("the keys are not distinct")
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1 for some keys that are not in the set (others get any number)."""
        keys = np.asarray(keys, np.int64)
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (bits, rank) in enumerate(zip(self.levels, self.rank)):
            at = (_hash(keys[left], k) % _U(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def dump(keys: np.ndarray, shard, offset, ordinal, copies):
    """The bytes of an index file: magic, level sizes, packed bits, then one entry per key by number."""
    tree = PerfectHash.build(keys)
    entries = np.zeros(len(keys), ENTRY)
    at = tree.numbers(keys)
    for name, values in zip(ENTRY.names, (fingerprints(np.asarray(keys)), shard, offset, ordinal, copies)):
        entries[name][at] = values
    yield MAGIC + struct.pack("<QQ", len(keys), len(tree.levels)) + struct.pack(f"<{len(tree.levels)}Q", *map(len, tree.levels))
    for bits in tree.levels:
        yield np.packbits(bits).tobytes()
    yield entries.tobytes()


def load(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not an index file")
    n, depth = struct.unpack_from("<QQ", data, 8)
    sizes = struct.unpack_from(f"<{depth}Q", data, 24)
    at, levels = 24 + 8 * depth, []
    for size in sizes:
        packed = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
        levels.append(np.unpackbits(packed, count=size).astype(bool))
        at += len(packed)
    return PerfectHash(levels), np.frombuffer(data, ENTRY, n, at)


def find(tree: PerfectHash, entries: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Entry number of each key, -1 where the stored fingerprint differs (a key that was never
    indexed passes with chance 2**-32)."""
    at = tree.numbers(keys)
    good = at >= 0
    good[good] = entries["fingerprint"][at[good]] == fingerprints(np.asarray(keys)[good])
    return np.where(good, at, -1)
