"""Word shingles of whole batches of texts, by vectorised hashing of their UTF-8 bytes.

A word is a run of bytes other than 09-0D and 20, A-Z lower-cased.  A word's hash is a polynomial in
its bytes modulo 2^64 (each byte by a random 64-bit value), finished by a mixer; a shingle's hash
mixes those of its words in order.  A text with fewer words than a shingle is one shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, U64), np.ones(1, U64)]  # powers of the base, and of its inverse


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit words."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and offsets, from 0; null is empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many there are before each text (and in all)."""
    raw, at = utf8(column)
    if not len(raw):
        return np.zeros(0, U64), np.zeros(len(at), np.int64)
    space = _SPACE[raw]
    before = np.ones(len(raw), bool)
    before[1:] = space[:-1]
    before[at[:-1][at[:-1] < len(raw)]] = True
    starts = np.flatnonzero(~space & before)
    after = np.ones(len(raw), bool)
    after[:-1] = space[1:]
    after[at[1:][at[1:] > 0] - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, U64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))
    return words, np.searchsorted(starts, at)


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending within it, and where each text's begin (and end)."""
    words, at = word_hashes(column)
    n = np.diff(at)
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    owner = np.repeat(np.arange(len(n)), counts)
    begin = np.arange(first[-1]) - first[owner] + at[owner]
    length = np.minimum(n[owner], width)
    padded = np.concatenate([words, np.zeros(width, U64)])
    value = length.astype(U64) * U64(0xD6E8FEB86659FD93)
    for j in range(width):
        step = value * U64(0xA0761D6478BD642F) + padded[begin + j]
        value = np.where(j < length, step ^ (step >> U64(29)), value)
    value = mix(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(n) + 1))
