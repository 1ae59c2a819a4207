"""Vectorised text kernels over Arrow batches: word bounds, word hashes, n-gram hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D, so no kernel decodes
UTF-8. All of them work on whole documents; blocks() only groups documents so that the
working arrays stay small, and a longer document forms a block of its own.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Odd multipliers of the polynomial hash of runs of words, modulo 2**64.
WORD_BASE = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
#: Seed of the hashes of spans. Hashes only find what may be equal; what depends on equality compares bytes.
SEED = 0x9E3779B97F4A7C15
#: Longest span, in bytes, that is hashed eight bytes at a time for all spans at once.
SHORT = 48
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n+1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def blocks(offsets: np.ndarray, most: int = (1 << 18) - 2) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of documents with at most `most` bytes, or a single longer document."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    kept = _powers.get(base)
    if kept is None or len(kept[0]) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p, step, have = np.ones(size, U64), b, 1
            while have < size:
                p[have : 2 * have] = p[:have] * U64(step)
                step, have = step * step % (1 << 64), 2 * have
            out.append(p)
        _powers[base] = kept = (out[0], out[1])
    return kept


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of the polynomial hash counts."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for the n documents the n+1 word offsets."""
    solid = ~SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[heads] = solid[heads]
    last[tails] = solid[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], U64)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes: mixed eight bytes at a time, or XXH3 for a long one."""
    size = ends - starts
    out = mix(size.astype(U64) ^ U64(SEED))
    if not len(starts):
        return out
    eights, live = _eights(data), np.flatnonzero((size > 0) & (size <= SHORT))
    at = 0
    while len(live):
        part = eights[starts[live] + at] & _KEEP[np.minimum(size[live] - at, 8)]
        out[live] = mix((out[live] ^ part) * U64(WORD_BASE[0]))
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]], SEED)
    return out


def same_bytes(a: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Whether span i of a has the bytes of span i of b."""
    size = a_ends - a_starts
    out = size == b_ends - b_starts
    first = _eights(a)
    second = first if b is a else _eights(b)
    live, at = np.flatnonzero(out & (size > 0) & (a_starts != b_starts if b is a else True)), 0
    while len(live):
        differ = (first[a_starts[live] + at] ^ second[b_starts[live] + at]) & _KEEP[np.minimum(size[live] - at, 8)]
        out[live[differ != 0]] = False
        at += 8
        live = live[(differ == 0) & (size[live] > at)]
    return out


def gram_hash(words: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive words from theirs; runs that cross documents must be left out by the caller."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers(WORD_BASE[lane], len(words) + 1)
    total = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n])


def inside(word_offsets: np.ndarray, k: int) -> np.ndarray:
    """For each run of k words, whether it lies in one document."""
    n = int(word_offsets[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    crosses = np.zeros(n + k, np.int32)
    # runs that start in the last k-1 words of a document leave it
    ends = word_offsets[1:]
    np.add.at(crosses, np.maximum(ends - k + 1, word_offsets[:-1]), 1)
    np.add.at(crosses, ends, -1)
    return np.cumsum(crosses)[:n] == 0


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def byte_grams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash (below 2**bits) of each run of n bytes, n from 2 to 4."""
    if len(data) < n:
        return np.zeros(0, np.int64)
    size = len(data) - n + 1
    value = data[:size].astype(np.uint32)
    for i in range(1, n):
        value = (value << np.uint32(8)) | data[i : i + size]
    return ((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)


def gram_sums(values: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Sum of values over the runs of n bytes that lie in each document; values is (runs,) or (runs, k)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    first = np.minimum(offsets[:-1], len(values))
    last = np.clip(offsets[1:] - n + 1, first, len(values))
    return total[last] - total[first]


def gram_inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """For each run of n bytes, whether it lies in one document."""
    return inside(offsets, n)


def _trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow, after whose end the worker, which other stages use again, keeps no freed memory."""

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _trim()

    return task
