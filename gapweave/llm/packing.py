"""Best-two-fit packing of token sequences.

Only lengths matter to the packing, and there are at most `width` different ones. So the
corpus is reduced to a histogram of piece lengths, the packing is worked out on counts,
and pieces are then dealt to the places that the plan has for their length. A bin is
filled greedily with the largest piece that fits; if a gap stays, its smallest piece goes
back and two unpacked pieces that fit the expanded gap more tightly take its place. A bin
found this way is repeated as often as the counts allow, which is what filling the bins
one by one would do. The plan's size depends on `width` alone.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gapweave.llm.kernels import U64, blocks, same_bytes, span_hash, trimmed, utf8, word_bounds
from gapweave.llm.shared import materialise

WIDTH = 4096
END_ID = 1
#: Words that a worker keeps (about 35 bytes each), unknown words encoded in one call, late words, and bytes of a block.
CACHE = 2_000_000
GROUP = 256
RECENT = 50_000
BLOCK = (1 << 19) - 2
#: Symbols that part a word from what stands before them.
MARKS = b".,;:!?*#$%&|)"
_MARK, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(MARKS)] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: Rows of one length that are numbered together, and the most buckets of a length: beyond RANK_ROWS * MAX_BUCKETS rows
#: the buckets grow, so that neither a bucket nor the table of a length's buckets is too much for one task.
RANK_ROWS = 250
MAX_BUCKETS = 50_000


class WordIds:
    """Ids of words, found by 64-bit hashes in sorted arrays and kept beside the words' bytes, which are compared.

    The tokenizer drops white space and none of its rules looks across it, nor across the bound
    between an ASCII letter or digit and one of MARKS; so the parts between can be encoded one by
    one. It lower-cases, so ASCII letters are lower-cased here already, but for those that a
    combining character might follow. A block's different words are looked up together; unknown ones are encoded many in a
    call, parted by a word of one control character, and merged into the arrays of late words, these
    now and then into the large ones. Beyond CACHE words all start anew. A text with one of the tokenizer's
    special strings, which it takes for single tokens, is given to it whole.
    """

    SEPARATOR = "\x01"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [token.content.encode() for token in self.whole.get_added_tokens_decoder().values()]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # lower-casing must not make special strings of others
        mark = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.levels = [self._empty(), self._empty()]  # many words, and those learned lately
        self.ids, self.words = np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    @staticmethod
    def _empty() -> list[np.ndarray]:
        """Hash, start and number of ids, start and end of bytes."""
        return [np.zeros(0, U64), *(np.zeros(0, np.int32) for _ in range(4))]

    @property
    def n_words(self) -> int:
        return sum(len(level[0]) for level in self.levels)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each has."""
        if self.mark is None or any(self.SEPARATOR in w for w in words):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)
        parts, between = [], f" {self.SEPARATOR} "
        for a in range(0, len(words), GROUP):
            text = between.join(words[a : a + GROUP])
            parts.append(np.array([*self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.mark], np.uint32))
        ids = np.concatenate(parts)
        ends = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(ends, prepend=-1) - 1

    def _learn(self, key: np.ndarray, words: list[bytes]) -> None:
        """Add words whose hashes are not there, by rising hash."""
        ids, size = self._encode([w.decode("utf-8", "replace") for w in words])
        start = (len(self.ids) + np.cumsum(size) - size).astype(np.int32)
        stop = (len(self.words) + np.cumsum([len(w) for w in words])).astype(np.int32)
        begin = np.append(np.int32(len(self.words)), stop[:-1])
        self.ids, self.words = np.concatenate([self.ids, ids]), np.concatenate([self.words, np.frombuffer(b"".join(words), np.uint8)])
        self.levels[1] = self._merged(self.levels[1], [key, start, size.astype(np.int32), begin, stop])
        if len(self.levels[1][0]) > max(RECENT, len(self.levels[0][0]) // 8):
            self.levels = [self._merged(*self.levels), self._empty()]

    @staticmethod
    def _merged(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        at = np.searchsorted(a[0], b[0])
        return [np.insert(x, at, y) for x, y in zip(a, b)]

    def _find(self, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start and number of ids, start and end of bytes under each hash; number -1 if there is none."""
        out = [np.zeros(len(key), np.int64) for _ in range(4)]
        out[1][:] = -1
        for keys, *columns in self.levels:
            if len(keys):
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                own = keys[at] == key
                for to, column in zip(out, columns):
                    to[own] = column[at[own]]
        return tuple(out)

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each document of a block."""
        raw = data.tobytes()
        out = self._encode_words(data, offsets)
        if any(s in raw for s in self.special):
            for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                if any(s in raw[a:b] for s in self.special):
                    out[i] = np.array(self.whole.encode(raw[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        return out

    def _encode_words(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        data = data.copy()
        plain = np.append(data[1:], 0) < 128
        data[(data >= 65) & (data <= 90) & plain] |= 32
        starts, ends, of = word_bounds(data, offsets)
        cuts = np.flatnonzero(_MARK[data[1:]] & _ALNUM[data[:-1]]) + 1
        if len(cuts):
            flags = np.zeros((2, len(data) + 1), bool)
            flags[0, starts] = flags[1, ends] = True
            flags[:, cuts] = True
            starts, ends = np.flatnonzero(flags[0]), np.flatnonzero(flags[1])
            of = np.searchsorted(starts, offsets)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * (len(offsets) - 1)
        key, which, place = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        raw, own = data.tobytes(), (starts[which], ends[which])
        exact = same_bytes(data, starts, ends, data, own[0][place], own[1][place]).all()
        if exact:
            start, size, begin, stop = self._find(key)
            new = np.flatnonzero(size < 0)
            if len(new):
                if self.n_words + len(new) > CACHE:
                    self._clear()
                    new = np.arange(len(key))
                self._learn(key[new], [raw[a:b] for a, b in zip(own[0][new].tolist(), own[1][new].tolist())])
                start, size, begin, stop = self._find(key)
            exact = same_bytes(data, *own, self.words, begin, stop).all()
        if exact:
            size = size[place]
            put = np.cumsum(size) - size
            ids = self.ids[np.repeat(start[place] - put, size) + np.arange(int(size.sum()))]
        else:  # different words share a hash: all words of the block one by one
            ids, size = self._encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())])
        bounds = np.concatenate([[0], np.cumsum(size)])[of]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


_tokenizers: dict[str, WordIds] = {}


def pieces(docs: DataFrame, tokenizer_path: str, width: int = WIDTH, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32): each text's ids and the end id, cut at every `width` ids; ids
    (packed) are null unless with_ids.

    Columns read: doc_id, text; a null text counts as empty and has the end id only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizers.get(tokenizer_path) or _tokenizers.setdefault(tokenizer_path, WordIds(tokenizer_path))
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            doc_ids = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            encoded = (x for a, b in blocks(offsets, BLOCK) for x in words.encode_block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            for doc_id, found in zip(doc_ids, encoded):
                ids = found.astype("<u4").tobytes() + end
                rows += [(doc_id, p, p * width, (min(len(ids), a + 4 * width) - a) // 4, ids[a : a + 4 * width]) for p, a in enumerate(range(0, len(ids), 4 * width))]
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows):
        a, p, s, n, i = zip(*rows)
        crc = pa.array([zlib.crc32(x) for x in i], pa.int64())
        i = i if with_ids else [None] * len(i)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(p, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(i, pa.binary()), crc], ["doc_id", "piece", "start", "length", "ids", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long")


def best_two_fit(counts: np.ndarray, width: int = WIDTH) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how often), from counts[length] for lengths 0 to width; no piece is left out."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    index = np.arange(width + 1)
    plan = []
    top = width
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return plan
        chosen: list[int] = []
        gap, high = width, top
        while gap:
            high = min(high, gap)
            while high and not left[high]:
                high -= 1
            if not high:
                break
            take = int(min(gap // high, left[high]))
            chosen += [high] * take
            left[high] -= take
            gap -= take * high
        if gap and len(chosen) > 1:
            small = chosen[-1]
            left[small] += 1
            room = gap + small
            fits = np.maximum.accumulate(np.where(left > 0, index, 0))  # the largest length available up to each
            first = np.flatnonzero(left[: room + 1])
            second = fits[room - first]
            # a pair of equal lengths needs two pieces: else the next smaller length
            twin = (second == first) & (left[first] < 2)
            second[twin] = np.where(first[twin] > 0, fits[first[twin] - 1], 0)
            total = np.where(second > 0, first + second, 0)
            if len(total) and total.max() > small:
                best = int(total.argmax())
                chosen = sorted([*chosen[:-1], int(first[best]), int(second[best])], reverse=True)
                left[first[best]] -= 1
                left[second[best]] -= 1
            else:
                left[small] -= 1
        needs = np.bincount(chosen, minlength=width + 1)
        used = np.flatnonzero(needs)
        more = int((left[used] // needs[used]).min())
        left[used] -= more * needs[used]
        plan.append((chosen, 1 + more))


def places(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """For each run of places: length, first rank of that length, first sequence, offset. Sorted by length and rank.

    Piece number r of a length goes to the run with the largest first rank <= r, to sequence
    (first sequence + r - first rank)."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in plan:
        at = 0
        for n in lengths:
            rows.append((n, rank.get(n, 0), sequence, at))
            rank[n] = rank.get(n, 0) + times
            at += n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(cut: DataFrame, width: int = WIDTH, rank_rows: int = RANK_ROWS, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """cut (doc_id, piece, length, ...) with sequence_id and offset, gapless from 0 in each sequence.

    Every row gets a place, rows that repeat a doc_id and rows with a null doc_id too; rows
    of length 0 do not occur, as each document has its end id. Rows of equal doc_id and piece
    may swap places between runs. An empty table gives an empty table.
    """
    counts = np.zeros(width + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most `width` rows
        counts[row["length"]] = row["count"]
    runs = places(best_two_fit(counts, width))
    buckets = F.get(F.lit(np.clip(-(-counts // rank_rows), 1, max_buckets).tolist()), F.col("length").cast("int"))
    shipped = cut.sparkSession.sparkContext.broadcast(runs)
    names = cut.columns
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), buckets).cast("long"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = W.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    rows = rows.withColumn("own", F.row_number().over(own) - 1).join(base, ["length", "bucket"])
    rows = rows.select(*names, (F.col("base") + F.col("own")).alias("rank"))
    at, n_at = names.index("length"), len(names)
    schema = rows.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shipped.value
        keys = (runs[:, 0] << 48) + runs[:, 1]
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(n_at).to_numpy()
            run = runs[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            columns = [*batch.columns[:n_at], pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 3])]
            yield pa.record_batch(columns, schema.names)

    return rows.mapInArrow(trimmed(deal), schema)


def packed_pieces(docs: DataFrame, tokenizer_path: str, width: int = WIDTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents.

    Columns read: doc_id, text; others are ignored. A null, empty or blank text has the end id only, as one piece of
    length 1; a text of more than width - 1 ids is cut. Every row is packed, rows that repeat a doc_id and rows with
    a null doc_id too; of pieces that tie, any may take either place. An empty table gives an empty table.
    """
    cut = pieces(docs, tokenizer_path, width, with_ids=False).drop("ids")
    return pack(materialise(cut, "pieces"), width)
