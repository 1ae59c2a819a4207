"""Sums of count vectors of fixed size over all rows: tasks add up their own, slices are added by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.kernels import trimmed

SLICE = 4096
#: Tasks that add up the slices of all others: what each reads grows with the number of those.
TASKS = 32


def summed(df: DataFrame, width: int, add: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """The vector of `width` int64 counts to which add(batch, counts) adds each batch of df.

    The driver gets one vector of fixed size, whatever df has.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(width, np.int64)
        for batch in batches:
            add(batch, own)
        for a in range(0, width, SLICE):
            if own[a : a + SLICE].any():
                yield pa.record_batch([pa.array([a // SLICE], pa.int32()), pa.array([own[a : a + SLICE].tobytes()], pa.binary())], ["slice", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_buffer(), np.int64)
                sums[at] = sums[at] + part if at in sums else part.copy()
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["slice", "counts"])

    parts = df.mapInArrow(trimmed(count), "slice int, counts binary").repartition(max(1, min(TASKS, width // SLICE)), F.col("slice"))
    out = np.zeros(width, np.int64)
    for row in parts.mapInArrow(total, "slice int, counts binary").collect():
        part = np.frombuffer(bytes(row["counts"]), np.int64)
        out[row["slice"] * SLICE : row["slice"] * SLICE + len(part)] = part
    return out


def summed_slices(df: DataFrame, width: int, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], most: int = 1024) -> Iterator[tuple[int, np.ndarray]]:
    """(number, counts) of each slice of the vector of `width` counts in which keys(batch) counts; slices without any are
    left out. For wide vectors with much that is empty: a task holds `most` slices (32 MB) and sends on what is more.
    """

    def rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["slice", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in keys(batch):
                values, n = np.unique(part, return_counts=True)
                numbers, first = np.unique(values // SLICE, return_index=True)
                for at, v, c in zip(numbers.tolist(), np.split(values, first[1:]), np.split(n, first[1:])):
                    if at not in own:
                        if len(own) == most:
                            yield rows(own)
                            own = {}
                        own[at] = np.zeros(SLICE, np.int64)
                    own[at][v - at * SLICE] += c
        if own:
            yield rows(own)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_buffer(), np.int64)
                sums[at] = sums[at] + part if at in sums else part.copy()
        if sums:
            yield rows(sums)

    slices = -(-width // SLICE)
    parts = df.mapInArrow(trimmed(count), "slice int, counts binary").repartition(max(1, min(TASKS, slices), slices // 256), F.col("slice"))
    for row in parts.mapInArrow(trimmed(total), "slice int, counts binary").toLocalIterator():
        yield row["slice"], np.frombuffer(bytes(row["counts"]), np.int64)
