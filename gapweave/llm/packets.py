"""Integer columns packed into one value: differences, byte by byte, compressed. So rows travel many at a time."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_CODEC = pa.Codec("zstd", compression_level=1)
#: Rows that a packet has at least, in the mean, once a batch is as large as it may be.
LEAST = 64


def sizes(rows: int, band_rows: int, batch: int, most_batch: int) -> tuple[int, int]:
    """Number of bands, and rows of a batch, for so many rows in all: bands of band_rows and batches of `batch`, both
    more for very large inputs, so that a batch still has some LEAST rows for each band."""
    bands = int(-(-rows // max(band_rows, LEAST * rows // most_batch))) + 1
    return bands, max(batch, min(most_batch, LEAST * bands))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, of 64-bit integers; those that change little from row to row become small."""
    n, planes = len(columns[0]), []
    for column in columns:
        step = np.diff(column.view(np.int64), prepend=np.int64(0))
        step = (step << 1) ^ (step >> 63)  # small for small steps of either sign
        planes.append(np.ascontiguousarray(step.view(np.uint8).reshape(n, 8).T))
    return struct.pack("<I", n) + _CODEC.compress(np.concatenate(planes), asbytes=True)


def unpack(raw: bytes, k: int) -> list[np.ndarray]:
    """The k columns of a packet, as 64-bit signed integers."""
    (n,) = struct.unpack_from("<I", raw)
    planes = np.frombuffer(_CODEC.decompress(raw[4:], 8 * n * k, asbytes=True), np.uint8).reshape(k, 8, n)
    out = []
    for plane in planes:
        step = np.ascontiguousarray(plane.T).view(np.uint64).ravel()
        step = (step >> np.uint64(1)).view(np.int64) ^ -((step & np.uint64(1)).view(np.int64))
        out.append(np.cumsum(step))
    return out


def by_band(band: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(band, packet) of the rows of each band, which keep their order."""
    order = np.argsort(band, kind="stable")
    columns = [c[order] for c in columns]
    own, at = np.unique(band[order], return_index=True)
    for b, x, y in zip(own.tolist(), at.tolist(), [*at[1:].tolist(), len(band)]):
        yield b, pack(*(c[x:y] for c in columns))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each band from batches sorted by their first column, the band."""
    now, rows = None, []
    for batch in batches:
        columns = batch.columns
        for i, band in enumerate(columns[0].to_pylist()):
            if band != now:
                if rows:
                    yield now, rows
                now, rows = band, []
            rows.append(tuple(c[i] for c in columns[1:]))
    if rows:
        yield now, rows
