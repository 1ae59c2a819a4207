"""Repeated-passage removal by fixed-block anchors.

A passage is a window of `window` words. Cut every document into non-overlapping reference
blocks of window/2 words: whichever words a window covers, it holds one such block whole.
So if a window occurs twice, a run of window/2 words in one place is a reference block in the
other, or a block of both. The steps:

1. index: tasks reduce the hashes of their reference blocks to sorted sets, dealt by hash band;
   a band's task adds them to a filter of all blocks and to one of blocks seen twice.
2. probe: every rolling run of window/2 words is looked up, one that is no block of its own
   document in the first filter, one that is in the second. Windows that hold a hit are candidates. The filters
   never lose a hit; when they are full more windows are candidates, and the steps behind are exact.
3. first place: a task keeps the first of candidate windows whose words are equal, compared
   word by word, and sends (hash, place) for it; a band's task names the first place of each hash.
4. extend: windows of a document whose first places follow each other join to maximal repeats,
   and these are compared with the words at their first place. Windows in which a word differs, as their hash
   collides, are grouped by their words themselves.
5. the words that verified repeats cover go. Only documents with some travel for that.

A place is (doc_id, row, word). Rows that repeat a doc_id are told apart by row, a digest of their text;
rows that repeat both are one place, of which one row stays as the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.filters import PAGE, PAGE_SCHEMA, Bloom, build, joined, size_for
from gapweave.llm.kernels import U64, blocks, gram_hash, inside, same_bytes, span_hash, trimmed, utf8, word_bounds
from gapweave.llm.packets import by_band, grouped, sizes, unpack
from gapweave.llm.shared import discard, materialise

WINDOW = 20
#: Largest size of the broadcast filters of blocks, and of that of documents with repeats.
FILTER_BYTES = 32 << 20
#: Rows that one band's task holds at a time, and rows that a task gathers before it packs them. For very large
#: inputs both grow, the second to MAX_BATCH, see sizes().
BAND_ROWS = 400_000
BATCH = 150_000
MAX_BATCH = 8_000_000
#: Documents that lean on one source and are compared with one copy of it, and the most sources that have several copies.
SALT_ROWS = 1_000
MOST_SALTED = 100_000


class _Words:
    """Words of a block of documents and the hashes of their runs."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.of = word_bounds(data, offsets)
        self.hashes = span_hash(data, self.starts, self.ends)

    def runs(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each rolling run of `block` words in one document, where it starts, whether it is a reference block."""
        good = np.flatnonzero(inside(self.of, block))
        first = np.repeat(self.of[:-1], np.diff(self.of))
        return gram_hash(self.hashes, block)[good], good, (good - first[good]) % block == 0


def _dealt(df: DataFrame, bands: int) -> DataFrame:
    """df with band b in partition b, sorted by band."""
    return df.repartitionById(bands, F.col("band")).sortWithinPartitions("band")


# ---- 1. index ----


def _blocks(docs: DataFrame, block: int, bands: int, batch_rows: int) -> DataFrame:
    """(band, hashes, twice): packed sets of the hashes of reference blocks, by band of their upper bits; whether
    each came twice or more."""

    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        band = ((values >> U64(32)) * U64(bands)) >> U64(32)
        rows = list(by_band(band.astype(np.int64), values, (n > 1).astype(np.int64)))
        for a in range(0, len(rows), 1024):
            own, raw = zip(*rows[a : a + 1024])
            yield pa.record_batch([pa.array(own, pa.int32()), pa.array(raw, pa.binary())], ["band", "packet"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in blocks(offsets):
                hashes, _, own = _Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).runs(block)
                held.append(hashes[own])
            if sum(map(len, held)) >= batch_rows:
                yield from packed(held)
                held = []
        if sum(map(len, held)):
            yield from packed(held)

    return docs.select("text").mapInArrow(trimmed(run), "band int, packet binary")


def index(docs: DataFrame, block: int, n_blocks: int, most: int = FILTER_BYTES, band_rows: int = BAND_ROWS, batch: int = BATCH) -> tuple[Bloom, Bloom]:
    """Filter of all reference blocks, and that of those seen twice."""
    every = size_for(n_blocks, most // 4 * 3 // PAGE * PAGE or most)
    if not every:
        return Bloom(1, full=True), Bloom(1, full=True)
    every, twice = -(-every // PAGE) * PAGE, max(PAGE, every // 3 // PAGE * PAGE)
    bands, batch = sizes(n_blocks, band_rows, batch, MAX_BATCH)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches):
            parts = [unpack(raw.as_buffer().to_pybytes(), 2) for (raw,) in rows]
            values = np.concatenate([p[0] for p in parts]).view(U64)
            seen = np.concatenate([p[1] for p in parts])
            order = np.argsort(values, kind="stable")
            values, seen = values[order], seen[order]
            at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            many = (np.diff(np.append(at, len(values))) > 1) | (np.maximum.reduceat(seen, at) > 0)
            yield from Bloom(every).pages(values[at])
            yield from Bloom(twice).pages(values[at][many], every // PAGE)

    return tuple(joined(_dealt(_blocks(docs, block, bands, batch), bands).mapInArrow(trimmed(meet), PAGE_SCHEMA), [every, twice]))


# ---- 2. and 3. probe, and first places ----


class _Held:
    """Candidate windows of a task with the words they lie in."""

    def __init__(self):
        self.data, self.starts, self.ends = [], [], []
        self.rows: list[list[np.ndarray]] = []  # hash, doc, row, at, number of the first word
        self.n_words = self.n_bytes = self.n_rows = 0

    def add(self, data: np.ndarray, words: _Words, hashes, doc, row, at, word) -> None:
        self.rows.append([hashes, doc, row, at, word + self.n_words])
        self.data.append(data)
        self.starts.append(words.starts + self.n_bytes)
        self.ends.append(words.ends + self.n_bytes)
        self.n_words, self.n_bytes, self.n_rows = self.n_words + len(words.starts), self.n_bytes + len(data), self.n_rows + len(at)

    def split(self, window: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Windows that no earlier one here equals (hash, doc, row, at), and repeats (doc, row, at)."""
        data, starts, ends = np.concatenate(self.data), np.concatenate(self.starts), np.concatenate(self.ends)
        hashes, doc, row, at, word = (np.concatenate(c) for c in zip(*self.rows))
        _, which, n = np.unique(hashes, return_inverse=True, return_counts=True)
        lead = n[which] == 1
        rest = np.flatnonzero(~lead)
        if not len(rest):
            return [hashes, doc, row, at], [doc[:0], row[:0], at[:0]]
        rest = rest[np.lexsort((at[rest], row[rest], doc[rest], which[rest]))]
        group = which[rest]
        new = np.concatenate([[True], group[1:] != group[:-1]])
        place = np.ones(len(rest), bool)  # not the place before it once more
        place[1:] = new[1:] | (doc[rest][1:] != doc[rest][:-1]) | (row[rest][1:] != row[rest][:-1]) | (at[rest][1:] != at[rest][:-1])
        rest, new = rest[place], new[place]
        lead[rest[new]] = True
        later = np.flatnonzero(~new)
        x, y = rest[later], rest[later - 1]
        same = _equal_windows(data, starts, ends, word[x], word[y], window)
        lead[x[~same]] = True
        x = x[same]
        return [c[lead] for c in (hashes, doc, row, at)], [doc[x], row[x], at[x]]


def _equal_windows(data, starts, ends, x: np.ndarray, y: np.ndarray, window: int) -> np.ndarray:
    """Whether the windows of words from x and from y have equal words. Words that overlapping windows of one distance
    share are compared once."""
    order = np.lexsort((x, x - y))
    a, step = x[order], (x - y)[order]
    begin = a.copy()
    near = (step[1:] == step[:-1]) & (a[1:] < a[:-1] + window)
    begin[1:][near] = a[:-1][near] + window
    size = a + window - begin
    end = np.cumsum(size)
    words = np.repeat(begin - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)
    other = words - np.repeat(step, size)
    differ = ~same_bytes(data, starts[words], ends[words], data, starts[other], ends[other])
    total = np.concatenate([[0], np.cumsum(differ)])
    out = np.empty(len(x), bool)
    out[order] = total[end] == total[end - window]
    return out


def _spans(doc: np.ndarray, row: np.ndarray, at: np.ndarray, window: int) -> list[np.ndarray]:
    """(doc, row, start, end) of the maximal spans that windows cover."""
    order = np.lexsort((at, row, doc))
    doc, row, at = doc[order], row[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (at[1:] > at[:-1] + window)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return [doc[first], row[first], at[first], at[last] + window] if len(at) else [doc, row, at, at]


def _place_band(doc: np.ndarray, row: np.ndarray, bands: int) -> np.ndarray:
    return ((((doc ^ row).view(U64) * U64(0x9E3779B97F4A7C15)) >> U64(32)) % U64(bands)).astype(np.int64)


def _out(kind: int, packets: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    rows = list(packets)
    for a in range(0, len(rows), 1024):
        own, raw = zip(*rows[a : a + 1024])
        yield pa.record_batch([pa.array(own, pa.int32()), pa.array(np.full(len(own), kind, np.int8)), pa.array(raw, pa.binary())], ["band", "kind", "packet"])


def candidates(docs: DataFrame, window: int, block: int, bands: int, shipped, batch_rows: int) -> DataFrame:
    """(band, kind, packet): kind 0, the first of equal candidate windows of a task, by band of their hash; kind 1,
    spans of windows that repeat others of the task, by band of their document."""

    def packed(held: _Held) -> Iterator[pa.RecordBatch]:
        lead, again = held.split(window)
        order = np.lexsort((lead[3], lead[2], lead[1]))
        lead = [c[order] for c in lead]
        band = ((lead[0] >> U64(32)) * U64(bands)) >> U64(32)
        yield from _out(0, by_band(band.astype(np.int64), *lead))
        spans = _spans(*again, window)
        yield from _out(1, by_band(_place_band(spans[0], spans[1], bands), *spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, twice = shipped.value
        held = _Held()
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            ids, rows = (batch.column(i).to_numpy() for i in range(2))
            for a, b in blocks(offsets):
                body = data[offsets[a] : offsets[b]]
                words = _Words(body, offsets[a : b + 1] - offsets[a])
                keys, at, own = words.runs(block)
                hit = every.has(keys)
                hit[own] = twice.has(keys[own])
                some = np.zeros(len(words.hashes) + 1, np.int32)
                some[1:][at[hit]] = 1
                some = np.cumsum(some)
                start = np.flatnonzero(inside(words.of, window))
                start = start[some[start + window - block + 1] > some[start]]
                if not len(start):
                    continue
                doc = np.searchsorted(words.of, start, "right") - 1
                held.add(body, words, gram_hash(words.hashes, window, 1)[start], ids[a:b][doc], rows[a:b][doc], start - words.of[doc], start)
                if held.n_rows >= batch_rows or held.n_words >= 4 * batch_rows:
                    yield from packed(held)
                    held = _Held()
        if held.n_rows:
            yield from packed(held)

    return docs.select("doc_id", "row", "text").mapInArrow(trimmed(run), "band int, kind byte, packet binary")


_SEGMENT = "doc_id long, row long, at long, n long, from_id long, from_row long, from_at long"


def segments(found: DataFrame, window: int, bands: int) -> DataFrame:
    """(doc_id, row, at, n, from_id, from_row, from_at): n words that equal those at an earlier place, by their hashes;
    from_* are null for those that are verified."""

    def first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows by hash band to (place, first place) by document band."""
        for band, rows in grouped(batches):
            raw = [(k.as_py(), p.as_buffer().to_pybytes()) for k, p in rows]
            yield from _out(1, ((band, p) for k, p in raw if k == 1))
            windows = [unpack(p, 4) for k, p in raw if k == 0]
            if not windows:
                continue
            hashes, doc, row, at = (np.concatenate(c) for c in zip(*windows))
            _, which, n = np.unique(hashes, return_inverse=True, return_counts=True)
            rest = np.flatnonzero(n[which] > 1)
            if not len(rest):
                continue
            rest = rest[np.lexsort((at[rest], row[rest], doc[rest], which[rest]))]
            new = np.concatenate([[True], which[rest][1:] != which[rest][:-1]])
            lead = rest[np.flatnonzero(new)[np.cumsum(new) - 1]]
            other = (doc[rest] != doc[lead]) | (row[rest] != row[lead]) | (at[rest] != at[lead])
            rest, lead = rest[other], lead[other]
            order = np.lexsort((at[rest], row[rest], doc[rest]))
            rest, lead = rest[order], lead[order]
            columns = [doc[rest], row[rest], at[rest], doc[lead], row[lead], at[lead]]
            yield from _out(0, by_band(_place_band(doc[rest], row[rest], bands), *columns))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places whose first places follow each other to maximal repeats."""
        for _, rows in grouped(batches):
            raw = [(k.as_py(), p.as_buffer().to_pybytes()) for k, p in rows]
            if sure := [unpack(p, 4) for k, p in raw if k == 1]:
                doc, row, start, end = (np.concatenate(c) for c in zip(*sure))
                none = pa.nulls(len(doc), pa.int64())
                yield from _batches([pa.array(doc), pa.array(row), pa.array(start), pa.array(end - start), none, none, none])
            if pairs := [unpack(p, 6) for k, p in raw if k == 0]:
                doc, row, at, *lead = (np.concatenate(c) for c in zip(*pairs))
                order = np.lexsort((at, row, doc))
                doc, row, at, *lead = (c[order] for c in (doc, row, at, *lead))
                new = np.ones(len(at), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
                new[1:] |= (lead[0][1:] != lead[0][:-1]) | (lead[1][1:] != lead[1][:-1]) | (lead[2][1:] != lead[2][:-1] + 1)
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at))) - 1 + window
                yield from _batches([pa.array(c) for c in (doc[first], row[first], at[first], n, *(x[first] for x in lead))])

    def _batches(columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        whole = pa.record_batch(columns, ["doc_id", "row", "at", "n", "from_id", "from_row", "from_at"])
        for a in range(0, len(whole), 4096):
            yield whole.slice(a, 4096)

    places = _dealt(found, bands).mapInArrow(trimmed(first_places), "band int, kind byte, packet binary")
    return _dealt(places, bands).mapInArrow(trimmed(extend), _SEGMENT)


# ---- 4. and 5. compare, and remove ----


def _send(docs: DataFrame, keys: Bloom, copies: dict[tuple[int, int], int] | None = None) -> DataFrame:
    """(doc_id, row, salt, text) of documents whose key the filter has: one for each different (doc_id, row) of a task, and
    as many copies of it, numbered by salt, as copies says."""
    shipped = docs.sparkSession.sparkContext.broadcast((keys, copies or {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, copies = shipped.value
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            take, salts = [], []
            chosen = np.flatnonzero(keys.has(batch.column(2).to_numpy().view(U64)))
            for i, place in zip(chosen.tolist(), zip(batch.column(0).take(pa.array(chosen)).to_pylist(), batch.column(1).take(pa.array(chosen)).to_pylist())):
                if place not in sent:
                    sent.add(place)
                    n = copies.get(place, 1)
                    take += [i] * n
                    salts += range(n)
            for a in range(0, len(take), 256):
                own = pa.array(take[a : a + 256], pa.int64())
                yield pa.record_batch([batch.column(0).take(own), batch.column(1).take(own), pa.array(salts[a : a + 256], pa.int32()), batch.column(3).take(own)], ["doc_id", "row", "salt", "text"])

    known = docs.filter("doc_id is not null")
    return known.select("doc_id", "row", "key", "text").mapInArrow(trimmed(run), "doc_id long, row long, salt int, text string")


def _bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


_SLICE = "doc_id long, row long, kind int, at long, n long, words binary"


def slices(docs: DataFrame, found: DataFrame, n_found: int, tasks: int, filter_bytes: int, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Segments with the words at their first place, joined by one space: (doc_id, row, kind 3, at, n, words)."""
    sources = found.groupBy("from_id", "from_row").agg(F.count("*").alias("leaning"))
    most = max(salt_rows, n_found // MOST_SALTED)
    copies = {(r["from_id"], r["from_row"]): -(-r["leaning"] // most) for r in sources.filter(F.col("leaning") > most).collect()}
    keys = found.select(F.xxhash64("from_id", "from_row"))
    texts = _send(docs, build(keys, n_found, filter_bytes), copies)
    salt = F.lit(0)
    if copies:
        hot = docs.sparkSession.createDataFrame([(*k, n) for k, n in copies.items()], "from_id long, from_row long, salts int")
        found = found.join(F.broadcast(hot), ["from_id", "from_row"], "left")
        salt = F.pmod(F.xxhash64("doc_id", "row", "at"), F.coalesce("salts", F.lit(1))).cast("int")
    wanted = found.select("from_id", "from_row", salt.alias("salt"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("text"), "doc_id", "row", "at", "n", "from_at")
    none = [F.lit(None).cast("long").alias(c) for c in ("a", "b", "c", "d", "e")]
    rows = texts.select(F.col("doc_id").alias("from_id"), F.col("row").alias("from_row"), "salt", F.lit(0).alias("kind"), "text", *none).union(wanted)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words = None, []
        for batch in batches:
            out = []
            key = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for i, (place, kind) in enumerate(zip(key, batch.column(3).to_pylist())):
                if kind == 0:
                    if place != now:
                        now, words = place, _bytes(batch.column(4)[i]).split()
                elif place == now:
                    doc, row, at, n, first = (batch.column(j)[i].as_py() for j in range(5, 10))
                    out.append((doc, row, 3, at, n, b" ".join(words[first : first + n])))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "row", "kind", "at", "n", "words"])

    keys = ["from_id", "from_row", "salt"]
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "kind").mapInArrow(trimmed(cut), _SLICE)


_KEPT = "doc_id long, n_words long, n_removed long, kept binary"


def removed(texts: DataFrame, marks: DataFrame, window: int, tasks: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, row, odd) of the texts that were sent; odd: hashes of windows whose words differ
    from those at the first place of their hash.

    marks: (doc_id, row, kind, at, n, words): kind 1, n rows have this place; kind 2, n words from at go; kind 3, they go
    where they equal words."""
    rows = texts.select("doc_id", "row", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.col("text").cast("binary").alias("words")).union(marks)

    def finish(place, words: list[bytes], copies: int, gone: np.ndarray, odd: set[int]) -> list[tuple]:
        kept = [w for w, g in zip(words, gone) if not g] if gone.any() else words
        out = [(place[0], len(words), len(words) - len(kept), b" ".join(kept), place[1], sorted(odd))]
        if copies > 1:
            n = len(words)
            out += [(place[0], n, n if n >= window else 0, b"" if n >= window else b" ".join(words), place[1], [])] * (copies - 1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, copies, gone, odd = None, [], 1, np.zeros(0, bool), set()
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for i, (doc, row, kind, at, n) in enumerate(zip(*columns)):
                if kind == 0:
                    if (doc, row) != now:
                        if now is not None:
                            out += finish(now, words, copies, gone, odd)
                        now, words, copies, odd = (doc, row), _bytes(batch.column(5)[i]).split(), 1, set()
                        gone = np.zeros(len(words), bool)
                elif (doc, row) != now:
                    continue
                elif kind == 1:
                    copies = n
                elif kind == 2:
                    gone[at : at + n] = True
                else:
                    own, other = words[at : at + n], _bytes(batch.column(5)[i])
                    if b" ".join(own) == other:
                        gone[at : at + n] = True
                    else:
                        differ = np.array([x != y for x, y in zip(own, other.split())])
                        total = np.concatenate([[0], np.cumsum(differ)])
                        equal = total[window:] == total[:-window]
                        for j in np.flatnonzero(equal).tolist():
                            gone[at + j : at + j + window] = True
                        odd |= set(_window_hashes(own, window)[~equal].tolist())
            yield from _removed_batches(out)
        if now is not None:
            yield from _removed_batches(finish(now, words, copies, gone, odd))

    return rows.repartition(tasks, "doc_id", "row").sortWithinPartitions("doc_id", "row", "kind", "at").mapInArrow(trimmed(run), f"{_KEPT}, row long, odd array<long>")


def _removed_batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 64):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 64]), types)], ["doc_id", "n_words", "n_removed", "kept", "row", "odd"])


def _window_hashes(words: list[bytes], window: int) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    return gram_hash(span_hash(data, starts, ends), window, 1).view(np.int64)


def _by_words(docs: DataFrame, odd: DataFrame, window: int, filter_bytes: int) -> DataFrame:
    """Marks (kind 2) of all repeated windows among those whose hash is odd, grouped by their words."""
    odd = odd.distinct()
    shipped = docs.sparkSession.sparkContext.broadcast(build(odd.select(F.xxhash64("hash")), odd.count(), filter_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = _bytes(text).split()
                if len(words) < window:
                    continue
                hashes = _window_hashes(words, window)
                for a in range(0, len(hashes), 1024):
                    part = hashes[a : a + 1024].tolist()
                    raw = [b" ".join(words[i : i + window]) for i in range(a, a + len(part))]
                    n = len(part)
                    yield pa.record_batch([pa.array([doc] * n, pa.int64()), pa.array([row] * n, pa.int64()), pa.array(range(a, a + n), pa.int64()), pa.array(part, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "row", "at", "hash", "words"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shipped.value
        for batch in batches:
            yield batch.filter(pa.array(keys.has(batch.column(5).to_numpy().view(U64)))).select(list(range(5)))

    every = docs.filter("doc_id is not null and text is not null").select("doc_id", "row", "text").mapInArrow(trimmed(run), "doc_id long, row long, at long, hash long, words binary")
    every = every.withColumn("key", F.xxhash64("hash")).mapInArrow(probe, "doc_id long, row long, at long, hash long, words binary")
    place = F.struct("doc_id", "row", "at")
    first = every.groupBy("words").agg(F.min(place).alias("first"), F.count("*").alias("rows")).filter("rows > 1").drop("rows")
    again = every.join(first, "words").filter(place > F.col("first")).select("doc_id", "row", "at").distinct()
    return again.select("doc_id", "row", F.lit(2).alias("kind"), "at", F.lit(window).cast("long").alias("n"), F.lit(None).cast("binary").alias("words"))


def kept_words(docs: DataFrame, window: int = WINDOW, filter_bytes: int = FILTER_BYTES, band_rows: int = BAND_ROWS, batch: int = BATCH, salt_rows: int = SALT_ROWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words of each text that no repeated window covers, joined by one space.

    Columns read: doc_id, text; others are ignored. A window is a repeat if its words start earlier too: at a smaller
    doc_id, or earlier in the same document. Rows that repeat a doc_id are taken in the order of a digest of their texts;
    of rows that repeat doc_id and text one is the first, and the others lose every word that a window
    covers. A null or empty text has no words; a row with a null doc_id keeps all its words, and none is judged by it.
    An empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.filter("doc_id is not null")
    row, twins = F.lit(0).cast("long"), None
    size, n_rows, n_ids = known.agg(F.coalesce(F.sum(F.octet_length("text")).cast("long"), F.lit(0)), F.count("*"), F.count_distinct("doc_id")).first()
    if n_ids < n_rows:
        row = F.conv(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 15), 16, 10).cast("long")
        twins = known.select("doc_id", row.alias("row")).groupBy("doc_id", "row").count().filter("count > 1")
        twins = materialise(twins, "repeated-rows")
    docs = docs.select("doc_id", row.alias("row"), F.xxhash64("doc_id", row).alias("key"), "text")
    known = docs.filter("doc_id is not null and text is not null")
    words, block = size // 6 + 1, max(1, window // 2)
    shipped = docs.sparkSession.sparkContext.broadcast(index(known, block, words // block + 1, filter_bytes, band_rows, batch))
    bands, batch = sizes(words, 3 * band_rows, batch, MAX_BATCH)
    found = materialise(segments(candidates(known, window, block, bands, shipped, batch), window, bands), "repeated-segments")

    pairs = found.filter("from_id is not null")
    n_pairs, n_found = found.agg(F.count("from_id"), F.count("*")).first()
    none = F.lit(None).cast("binary").alias("words")
    marks = found.filter("from_id is null").select("doc_id", "row", F.lit(2).alias("kind"), "at", "n", none)
    held = found.select("doc_id", "row")
    if twins is not None:
        marks = marks.union(twins.select("doc_id", "row", F.lit(1), F.lit(0).cast("long"), "count", none))
        held = held.union(twins.select("doc_id", "row"))
        n_found += twins.count()
    touched = build(held.select(F.xxhash64("doc_id", "row")), n_found, filter_bytes)
    texts = _send(docs, touched).drop("salt")
    compared = marks
    if n_pairs:
        compared = marks.union(slices(known, pairs, n_pairs, bands, filter_bytes, salt_rows))
    done = materialise(removed(texts, compared, window, bands), "passages")
    odd = done.select(F.explode("odd").alias("hash"))
    if not odd.isEmpty():
        more = materialise(_by_words(known, odd, window, filter_bytes), "passages-by-words")
        again = held.union(more.select("doc_id", "row"))
        touched = build(again.select(F.xxhash64("doc_id", "row")), n_found + more.count(), filter_bytes)
        done = materialise(removed(_send(docs, touched).drop("salt"), compared.union(more), window, bands), "passages")
    discard(found)

    keys = docs.sparkSession.sparkContext.broadcast(touched)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that were not sent, with all their words."""
        for batch in batches:
            stay = ~keys.value.has(batch.column(1).to_numpy().view(U64)) | ~batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(stay))
            words = [_bytes(t).split() for t in batch.column(2)]
            n = pa.array([len(w) for w in words], pa.int64())
            yield pa.record_batch([batch.column(0), n, pa.array(np.zeros(len(words), np.int64)), pa.array([b" ".join(w) for w in words], pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return docs.select("doc_id", "key", "text").mapInArrow(trimmed(whole), _KEPT).union(done.drop("row", "odd"))
