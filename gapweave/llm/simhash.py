"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. The binary Golay code
(23, 12) is perfect: each 23-bit word lies within 3 bits of exactly one codeword. A
segment's fuzzy keys are the codewords to which it and its one-bit neighbours decode, at
most six; two segments that differ in at most two bits have a common neighbour and so a
common key. Of two fingerprints at distance 2 or less, one segment is free of errors
(three segments, two errors) and the cyclically next one has at most two, so they meet
under (that segment as it is, a fuzzy key of the next): at most 18 keys each.

Keys with more than `hot` distinct fingerprints are cut again, exactly: the 42 bits
outside the segment that agrees form six blocks of seven, two errors touch at most two,
so the pair agrees in some four of the six blocks; under that key at most 2**14 distinct
fingerprints can exist, or 2**15 beside a segment of 21 bits, whose 43 other bits have one block of eight. Each group yields a spanning forest of its verified links, never
all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.components import components
from gapweave.llm.kernels import U64, trimmed
from gapweave.llm.shared import discard_since, join_counted, made, materialise

#: Generator polynomial of the (23, 12) Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY_POLYNOMIAL = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 2
HOT = 256


def _remainder(word: np.ndarray) -> np.ndarray:
    """Remainder (syndrome, 11 bits) of 23-bit words modulo the generator."""
    word = word.copy()
    for bit in range(22, 10, -1):
        word ^= np.where((word >> bit) & 1 == 1, GOLAY_POLYNOMIAL << (bit - 11), 0).astype(word.dtype)
    return word


def golay_table() -> np.ndarray:
    """Error pattern of weight 3 or less for each of the 2048 syndromes."""
    patterns = [0, *(sum(1 << b for b in c) for w in (1, 2, 3) for c in combinations(range(23), w))]
    patterns = np.array(patterns, np.int64)
    table = np.full(2048, -1, np.int64)
    table[_remainder(patterns)] = patterns
    return table


_tables: dict[str, np.ndarray] = {}


def golay_index(word: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    if not _tables:
        all_low = np.arange(1 << 12, dtype=np.int64)
        # the syndrome is linear, so that of a word is the sum of those of its halves
        _tables.update(error=golay_table(), low=_remainder(all_low), high=_remainder(all_low[: 1 << 11] << 12))
    syndrome = _tables["low"][word & 0xFFF] ^ _tables["high"][word >> 12]
    return (word ^ _tables["error"][syndrome]) >> 11


def fuzzy_keys(segment: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices of each segment and its one-bit neighbours: an array (n, bits + 1), with repeats."""
    flips = np.array([0, *(1 << b for b in range(bits))], np.int64)
    return golay_index(segment[:, None] ^ flips)


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of a UTF-8 text: shingles of lower-cased (A-Z) words, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(x), seed) for x in zip(*(words[i:] for i in range(shingle)))]
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[a : a + (1 << 14)], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * total > len(hashes))))


def _segment(fp: np.ndarray, s: int) -> np.ndarray:
    at, bits = SEGMENTS[s]
    return ((fp >> U64(at)) & U64((1 << bits) - 1)).astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp) to (key, fp), one row for each different key."""
    for batch in batches:
        fp = batch.column(0).to_numpy().view(U64)
        for a in range(0, len(fp), 1 << 13):
            part = fp[a : a + (1 << 13)]
            segments = [_segment(part, s) for s in range(3)]
            for s in range(3):
                fuzzy = np.sort(fuzzy_keys(segments[(s + 1) % 3], SEGMENTS[(s + 1) % 3][1]), axis=1)
                new = np.ones(fuzzy.shape, bool)
                new[:, 1:] = fuzzy[:, 1:] != fuzzy[:, :-1]
                row = np.nonzero(new)[0]
                key = (np.int64(s) << 40) | (segments[s][row] << 12) | fuzzy[new]
                yield pa.record_batch([pa.array(key), pa.array(part[row].view(np.int64))], ["key", "fp"])


_BLOCK_SETS = list(combinations(range(6), 4))


def _narrow_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of hot keys to 15 narrower keys each: the agreeing segment and four of the six 7-bit blocks outside it."""
    for batch in batches:
        key, fp = (batch.column(i).to_numpy() for i in range(2))
        which, bits = key >> 40, fp.view(U64)
        for s, (at, width) in enumerate(SEGMENTS):
            own = which == s
            if not own.any():
                continue
            part = bits[own]
            same = U64(((1 << width) - 1) << at)
            places = [b for b in range(64) if not at <= b < at + width]
            places = [places[i * len(places) // 6 : (i + 1) * len(places) // 6] for i in range(6)]
            for c, chosen in enumerate(_BLOCK_SETS):
                mask = same | U64(sum(1 << b for i in chosen for b in places[i]))
                tag = np.full(len(part), s * len(_BLOCK_SETS) + c, np.int32)
                yield pa.record_batch([pa.array(tag), pa.array((part & mask).view(np.int64)), pa.array(part.view(np.int64))], ["tag", "key", "fp"])


def forest(fp: np.ndarray, most: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links (distance <= most) among the fingerprints of one group, as signed numbers."""
    names = fp.view(np.int64)
    if len(fp) == 2:
        return [(int(names[0]), int(names[1]))] if int(fp[0] ^ fp[1]).bit_count() <= most else []
    parent = list(range(len(fp)))
    out = []
    for i in range(len(fp) - 1):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= most) + i + 1:
            x, y = i, int(j)
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[y] = x
                out.append((int(names[i]), int(names[j])))
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of a common key to verified links (u, v)."""
    for batch in batches:
        found: list[tuple[int, int]] = []
        for at in range(batch.num_rows):
            found += forest(batch.column(0)[at].values.to_numpy().view(U64))
        if found:
            u, v = zip(*found)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, carry) of whole texts; a null text counts as empty."""
    schema = docs.select(F.col("doc_id").cast("long"), F.lit(0).cast("long").alias("fp"), *carry).schema

    def run(batches):
        for batch in batches:
            text = batch.column(1)
            fps = np.array([simhash(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, seed) for t in text], dtype=U64)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], schema.names)

    return docs.select(F.col("doc_id").cast("long"), "text", *carry).mapInArrow(trimmed(run), schema)


#: Fingerprints of one task that makes their keys.
TASK_NODES = 20_000


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, hot: int = HOT, carry: tuple[str, ...] = ()) -> DataFrame:
    """Components of documents linked at 2 or fewer differing fingerprint bits.

    Columns read: doc_id, text, and those named in carry, which come back; others are ignored. Returns one row per input
    row: doc_id, fp (long), component_id (smallest doc_id reachable, itself included), component (a number that the
    rows of a component, and they alone, have), carry. Empty and null texts have fingerprint zero and link like any other; equal texts
    link at distance 0. Links are between rows: rows that repeat a doc_id stay as often as they come, and those with
    different texts are in one component only if linked. Rows with a null doc_id link like others; their component_id
    is null if no row of the component has a doc_id. An empty table gives an empty table.
    """
    marked = materialise(fingerprints(docs, shingle, seed, carry), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    n_rows, mark = marked.count(), made()
    nodes = materialise(nodes.repartition(max(1, n_rows // TASK_NODES), "fp"), "fingerprint-nodes")
    keys = nodes.select("fp").mapInArrow(trimmed(_keys), "key long, fp long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialise(keys.join(shared, "key"), "fingerprint-keys")
    group = F.collect_list("fp").alias("members")
    cold = met.filter(F.col("n") <= hot).groupBy("key").agg(group).select("members")
    narrow = met.filter(F.col("n") > hot).select("key", "fp").mapInArrow(_narrow_keys, "tag int, key long, fp long")
    # a fingerprint that comes under several hot keys of one segment would repeat here
    narrow = narrow.distinct().groupBy("tag", "key").agg(group).filter(F.size("members") > 1).select("members")
    edges = cold.unionAll(narrow).mapInArrow(trimmed(_links), "u long, v long")
    found = components(edges)
    named = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", "rows", F.coalesce("component", "fp").alias("component"), F.col("node").isNotNull().alias("linked"))
    named = materialise(named, "fingerprint-components")
    discard_since(docs.sparkSession, mark, named)
    alone = named.filter("not linked").select("fp", "component", F.col("least").alias("component_id"), "rows")
    linked = named.filter("linked")
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = alone.union(linked.join(smallest, "component").select("fp", "component", "component_id", "rows"))
    return join_counted(marked, named, "fp", "rows", n_rows).select("doc_id", "fp", "component_id", "component", *carry)


def kept_rows(found: DataFrame, row: tuple[str, ...]) -> DataFrame:
    """Of the rows of near_duplicates(carry=row) one of each component: that of the smallest doc_id, and of these the first
    by row, whose values no two rows share. Rows with a null doc_id come last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *row)).alias("first")
    return found.groupBy("component").agg(first).select(*(F.col(f"first.{c}").alias(c) for c in row))
