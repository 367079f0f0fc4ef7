"""Word shingles as 64-bit hashes, from the UTF-8 bytes of whole Arrow batches (numpy only).

A word's hash is a polynomial over random 64-bit byte codes, read off prefix sums, so no word is ever
made as a Python object. Two different words or shingles collide with a chance near 2**-61.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

WIDTH = 5  # words to a shingle
PERMUTATIONS = 128
CHUNK = 1 << 19  # bytes of text handled at once
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@lru_cache(1)
def _codes() -> np.ndarray:
    codes = np.random.default_rng(20240501).integers(0, 2**64, 256, dtype=np.uint64)
    for c in range(ord("A"), ord("Z") + 1):
        codes[c] = codes[c + 32]
    return codes


@lru_cache(1)
def _separators() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return out


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(1)
def multipliers() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * _U(2) + _U(1)


def _bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and offsets[-1] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text (null: none), and the number of the first word of each text."""
    raw, offsets = _bytes_and_offsets(column)
    word = ~_separators()[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    after = np.zeros(len(raw), bool)
    after[:-1] = word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    size = 1 << max(CHUNK.bit_length(), int(len(raw)).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_codes()[raw] * power[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts]), np.searchsorted(starts, offsets)


def shingle_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (repeats kept) and the number of the first shingle of each text."""
    words, first = word_hashes(column)
    n = len(words)
    owner_end = np.repeat(first[1:], np.diff(first))
    at = np.arange(n)
    padded = np.concatenate([words, np.zeros(WIDTH, np.uint64)])
    out = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        out += np.where(at + k < owner_end, padded[k:k + n], _U(0)) * _U(pow(0xD6E8FEB86659FD93, k + 1, 2**64))
    begin = np.zeros(n, bool)
    begin[first[:-1][np.diff(first) > 0]] = True
    good = (owner_end - at >= WIDTH) | begin
    counts = np.concatenate([[0], np.cumsum(good)])
    return mix(out[good] ^ _U(0x2545F4914F6CDD1D)), counts[first]


def distinct_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first = shingle_hashes(column)
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]


def minima(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minhashes of the texts that have shingles, set sizes of all, set digests of all as two columns)."""
    hashes, first = shingle_hashes(column)
    sizes, digests = np.zeros(len(column), np.int64), np.zeros((len(column), 2), np.uint64)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if b > a:
            own = np.unique(hashes[a:b])
            sizes[i] = len(own)
            digests[i] = own.sum(dtype=np.uint64), mix(own).sum(dtype=np.uint64)
    full = first[:-1][np.diff(first) > 0]
    out = np.empty((PERMUTATIONS, len(full)), np.uint64)
    if len(full):
        turned = np.empty_like(hashes)
        for k, a in enumerate(multipliers()):
            np.multiply(hashes, a, out=turned)
            out[k] = np.minimum.reduceat(turned, full)
    return out.T, sizes, digests
