"""Bloom filters over 64-bit keys: of a size bounded by a parameter, built by tasks, joined a page at a time.

A filter only saves work. It never loses a key, and whoever asks it takes an exact step after it;
when it would be nearly full it is not built and lets everything through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gapweave.llm.kernels import U64, trimmed

#: A key's bits lie in one line of 64 bytes; pages of 64 lines travel.
LINE, PAGE, BITS = 64, 4096, 4
#: Bits for each key up to the bound, and keys for each byte at the bound from which a filter is not worth its size.
BITS_A_KEY, FULL = 20, 2
PAGE_SCHEMA = "page long, bits binary"


class Bloom:
    """The upper bits of a key choose the line, so a range of keys owns neighbouring pages."""

    def __init__(self, n_bytes: int, full: bool = False):
        self.bits = np.full(LINE, 255, np.uint8) if full else np.zeros(-(-max(n_bytes, 1) // LINE) * LINE, np.uint8)

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        """For each of a key's bits, its place."""
        line = ((keys >> U64(32)) * U64(len(self.bits) // LINE)) >> U64(32)
        mixed = keys * U64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> U64(29)
        for i in range(BITS):
            yield ((line << U64(9)) | ((mixed >> U64(9 * i)) & U64(511))).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for at in self.places(keys):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys):
            out &= ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        return out

    def pages(self, keys: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
        """The filter's pages that hold bits of keys, numbered from `first`; only the range of pages that keys touch is made."""
        if not len(keys):
            return
        at = np.concatenate(list(self.places(keys)))
        low, high = int(at.min()) // (8 * PAGE), int(at.max()) // (8 * PAGE) + 1
        bits = np.zeros((high - low) * PAGE, np.uint8)
        at -= low * 8 * PAGE
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        whole = bits.reshape(-1, PAGE)
        some = np.flatnonzero(whole.any(1))
        for a in range(0, len(some), 256):
            own = some[a : a + 256]
            yield pa.record_batch([pa.array(own + low + first, pa.int64()), pa.array([whole[i].tobytes() for i in own], pa.binary())], ["page", "bits"])


def size_for(n_keys: int, most: int) -> int:
    """Bytes for n keys, `most` at most; 0 if even that would be nearly full."""
    most = max(LINE, most // LINE * LINE)
    if n_keys > FULL * most:
        return 0
    return min(most, -(-max(n_keys, 1) * BITS_A_KEY // (8 * LINE)) * LINE)


def joined(parts: DataFrame, sizes: list[int]) -> list[Bloom]:
    """The filters of the given sizes, whose pages (page, bits) follow each other, from the tasks' parts."""
    n_pages = [-(-size // PAGE) for size in sizes]

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, np.zeros(PAGE, np.uint8)
        for batch in batches:
            for page, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if page != now:
                    if now is not None:
                        yield pa.record_batch([pa.array([now]), pa.array([bits.tobytes()], pa.binary())], ["page", "bits"])
                    now, bits = page, np.zeros(PAGE, np.uint8)
                bits |= np.frombuffer(raw.as_buffer(), np.uint8)
        if now is not None:
            yield pa.record_batch([pa.array([now]), pa.array([bits.tobytes()], pa.binary())], ["page", "bits"])

    whole = np.zeros((sum(n_pages), PAGE), np.uint8)
    tasks = max(1, sum(n_pages) // 512)
    for row in parts.repartition(tasks, "page").sortWithinPartitions("page").mapInArrow(trimmed(either), PAGE_SCHEMA).toLocalIterator():  # 2 MB at a time
        whole[row["page"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    out, at = [], 0
    for size, n in zip(sizes, n_pages):
        own = Bloom(1)
        own.bits = whole[at : at + n].ravel()[:size]
        out.append(own)
        at += n
    return out


def longs(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy().view(U64)


def build(keys: DataFrame, n_keys: int, most: int, keys_of: Callable[[pa.RecordBatch], np.ndarray] = longs) -> Bloom:
    """Filter of the keys that keys_of finds in rows, by default a column of longs, well mixed; n of them; of `most` bytes at
    most."""
    size = size_for(n_keys, most)
    if not size:
        return Bloom(1, full=True)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shape = [], Bloom(size)
        for batch in batches:
            held.append(keys_of(batch))
            if sum(map(len, held)) > 1_000_000:
                yield from shape.pages(np.concatenate(held))
                held = []
        if held:
            yield from shape.pages(np.concatenate(held))

    return joined(keys.mapInArrow(trimmed(part), PAGE_SCHEMA), [size])[0]
