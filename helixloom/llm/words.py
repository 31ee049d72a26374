"""Vectorised word splitting and hashing over the UTF-8 buffers of Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; all of these are ASCII, so splitting bytes and
splitting code points agree. A word's hash folds its bytes in, eight at a time, through a bijective
64-bit mixer, so each block of eight changes all bits before the next one enters; words beyond LONG_WORD bytes are hashed
by BLAKE2b. Two seeds give two independent hashes. No Python object is made per word of common length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SUB_BATCH = 4 << 20
LONG_WORD = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks that keep the first n bytes of a little-endian block of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SEEDS = np.random.default_rng(20240611).integers(1, 2**63, 16, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def sub_batches(data: np.ndarray, offsets: np.ndarray, limit: int = SUB_BATCH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents of about ``limit`` bytes: first, past-last, their bytes and offsets."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the position of the first word of each document (one more at the end)."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = solid[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = solid[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, of its lower-cased (A-Z only) bytes if ``lower``; each ``seed`` gives another hash."""
    size = ends - starts
    padded = np.zeros(len(data) + LONG_WORD + 8, np.uint8)
    padded[: len(data)] = _LOWER[data] if lower else data
    eights = np.ndarray(len(data) + LONG_WORD + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out = mix(size.astype(np.uint64) ^ _SEEDS[seed])
    for at in range(0, min(LONG_WORD, int(size.max(initial=0))), 8):
        live = np.flatnonzero(size > at) if at else slice(None)
        block = eights[starts[live] + at] & _FIRST[np.minimum(size[live] - at, 8)]
        out[live] = mix(out[live] * np.uint64(0x9E3779B97F4A7C15) + (block ^ _SEEDS[seed + 1]))
    key = seed.to_bytes(1, "little")
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def normal_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """A 128-bit digest of each document's sequence of lower-cased words; None without words."""
    if not len(starts):
        return [None] * (len(first) - 1)
    # the words of all documents, each with one space behind it
    step = np.concatenate(([0], np.cumsum(ends - starts + 1)))
    solid = np.zeros(len(data) + 1, np.int8)
    solid[starts] += 1
    solid[ends] -= 1
    inside = np.cumsum(solid[:-1], dtype=np.int8).astype(bool)
    flat = np.full(step[-1], 32, np.uint8)
    kept = np.ones(step[-1], bool)
    kept[step[1:] - 1] = False
    flat[kept] = _LOWER[data[inside]]
    return [hashlib.blake2b(flat[step[a] : step[b]].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one document; all its words as one shingle if there are fewer."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    acc = np.full(n, np.uint64(min(k, len(words))), np.uint64)
    for i in range(min(k, len(words))):
        acc = (acc ^ words[i : i + n]) * np.uint64(0xD6E8FEB86659FD93)
        acc ^= acc >> np.uint64(32)
    acc = mix(acc)
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))] if n > 1 else acc
