"""Quality rules: base counts, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams: the raw corpus, counted over all documents, and
the trusted target, counted over documents labelled good and not toxic. A document's score is the mean
over its n-grams of log(target / raw); every document below the threshold goes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.counts import summed
from gapweave.llm.kernels import blocks, byte_grams, gram_hash, gram_inside, gram_sums, inside, same_bytes, span_hash, trimmed, utf8, word_bounds

GRAM = 4
BITS = 18
#: Bound of the sample of labelled rows that stands for the trusted target.
TRUSTED_ROWS = 20_000
#: Pseudo-counts with which the raw corpus smooths the target.
SMOOTH = 50_000.0
#: Added to the number of n-grams in the mean, so that a very short text is not judged on a few n-grams.
SHRINK = 32
THRESHOLD = -0.2
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_NEWLINE = 10


def _repeats(text: bytes) -> tuple[int, int]:
    """n_repeat_words and n_dup_lines of one text by its words and lines themselves."""
    words, lines = text.split(), [line for line in text.split(b"\n") if line.split()]
    windows = list(zip(*(words[i:] for i in range(5))))
    count = Counter(windows)
    gone = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    return len(gone), len(lines) - len(set(lines))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document. Equal hashes are compared byte
    by byte; a document in which they differ is counted by its words and lines themselves."""
    n = len(offsets) - 1

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, of = word_bounds(data, offsets)
    lead = (data & 0xC0) != 0x80
    solid = np.zeros(len(data) + 1, np.int8)
    solid[starts] += 1
    np.subtract.at(solid, ends, 1)
    in_word = np.cumsum(solid[:-1], dtype=np.int32) > 0
    out = {"n_words": np.diff(of), "word_chars": per_doc(lead & in_word), "n_symbols": per_doc(SYMBOLS[data]), "n_dup_lines": np.zeros(n, np.int64)}

    hashes = span_hash(data, starts, ends)
    good = np.flatnonzero(inside(of, 5))
    doc_of = np.repeat(np.arange(n), np.diff(of))
    covered = np.zeros(len(hashes) + 1, np.int32)
    apart: set[int] = set()  # documents in which different words or lines share a hash
    if len(good):
        keys = gram_hash(hashes, 5)[good]
        order = np.lexsort((keys, doc_of[good]))
        k, at = keys[order], good[order]
        same = np.flatnonzero((k[1:] == k[:-1]) & (doc_of[at[1:]] == doc_of[at[:-1]]))
        for i in range(5):
            x, y = at[same + 1] + i, at[same] + i
            apart |= set(doc_of[x[~same_bytes(data, starts[x], ends[x], data, starts[y], ends[y])]].tolist())
        twice = np.zeros(len(k), bool)
        twice[same] = twice[same + 1] = True
        np.add.at(covered, at[twice], 1)
        np.subtract.at(covered, at[twice] + 5, 1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    out["n_repeat_words"] = total[of[1:]] - total[of[:-1]]

    breaks = np.flatnonzero(data == _NEWLINE)
    heads = np.sort(np.concatenate([breaks + 1, offsets[:-1][np.diff(offsets) > 0]]))
    heads = np.unique(heads[heads < len(data)]) if len(heads) else heads.astype(np.int64)
    tails = np.minimum(np.append(heads[1:], len(data)), len(data))
    tails = np.where((tails > heads) & (data[tails - 1] == _NEWLINE), tails - 1, tails) if len(heads) else tails
    worded = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails = heads[worded], tails[worded]
    if len(heads):
        doc = np.searchsorted(offsets, heads, "right") - 1
        keys = span_hash(data, heads, tails)
        order = np.lexsort((keys, doc))
        again = np.flatnonzero((keys[order][1:] == keys[order][:-1]) & (doc[order][1:] == doc[order][:-1]))
        x, y = order[again + 1], order[again]
        apart |= set(doc[x[~same_bytes(data, heads[x], tails[x], data, heads[y], tails[y])]].tolist())
        out["n_dup_lines"] = np.bincount(doc[x], minlength=n)
    for d in apart:
        out["n_repeat_words"][d], out["n_dup_lines"][d] = _repeats(data[offsets[d] : offsets[d + 1]].tobytes())
    return {k: v.astype(np.int64) for k, v in out.items()}


def trusted_ids(labels: DataFrame, most: int = TRUSTED_ROWS) -> list[int]:
    """At most `most` doc_ids labelled good and not toxic, those of smallest hash: the same at every run."""
    good = labels.filter("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long"))
    return sorted({r[0] for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()})


def fit(docs: DataFrame, ids: list[int], smooth: float = SMOOTH) -> np.ndarray:
    """log(target / raw) of each hashed n-gram; zero if there is no trusted document."""
    size = 1 << BITS
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(ids, np.int64)))

    def add(batch: pa.RecordBatch, counts: np.ndarray) -> None:
        data, offsets = utf8(batch.column(1))
        own = np.isin(batch.column(0).fill_null(-1).to_numpy(), wanted.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        for a, b in blocks(offsets):
            part = offsets[a : b + 1] - offsets[a]
            grams = byte_grams(data[offsets[a] : offsets[b]], GRAM, BITS)
            good = gram_inside(part, GRAM)
            counts[:size] += np.bincount(grams[good], minlength=size)
            if own[a:b].any():
                trusted = np.repeat(own[a:b], np.diff(part))[: len(grams)]
                counts[size:] += np.bincount(grams[good & trusted], minlength=size)

    counts = summed(docs.select(F.col("doc_id").cast("long"), "text"), 2 * size, add).astype(np.float64)
    raw, target = counts[:size] + 1, counts[size:]
    raw /= raw.sum()
    return np.log((target + smooth * raw) / (target.sum() + smooth)) - np.log(raw)


_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def judge(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shipped.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in blocks(offsets):
                body, part = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                found = base_counts(body, part)
                total = gram_sums(ratio[byte_grams(body, GRAM, BITS)], part, GRAM)
                score = np.round(total / (np.maximum(np.diff(part) - GRAM + 1, 0) + SHRINK), 9)
                failed = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
                arrays = [batch.column(0).slice(a, b - a), *(pa.array(v) for v in found.values()), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)]
                yield pa.record_batch(arrays, ["doc_id", *found, "base_failed", "kept", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), _SCHEMA)


def quality(docs: DataFrame, labels: DataFrame, trusted_rows: int = TRUSTED_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, the base counts, base_failed, kept and the score.

    Columns read: doc_id, text; of labels doc_id, quality, toxic. A null text has no words and fails
    the base rules. Rows that repeat a doc_id are judged alike if their texts are. Labels with nulls
    do not count as trusted; with no trusted document every score is 0 and only the base rules
    decide. An empty table gives an empty table.
    """
    return judge(docs, fit(docs, trusted_ids(labels, trusted_rows)), threshold)
