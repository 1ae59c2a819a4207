"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points become classes through one array; a six-state machine over the classes is run
as a scan of transition functions (composed row by row for all entry states, then across
rows by doubling, then replayed), and token bounds follow from the state before a code
point and its neighbours. No regular expression is run. The slices between bounds feed
pair merging, whose results are cached per slice. The bounds are retained, as byte offsets, with the number of the first id of
each slice: decoding puts the bytes of each slice's ids at its offset, so any slices can be decoded alone.

The bounds are those of public_tokenizers.PATTERN: contractions 's 't 're 've 'm 'll 'd;
runs of letters, of digits, or of other symbols, each with one optional space before;
white space, of which a run leaves its last character to a following token.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.kernels import blocks, trimmed, utf8

#: Classes of code points.
WHITE, BLANK, LETTER, DIGIT, OTHER, QUOTE = range(6)
#: States after a code point: white space or start, blank, letter run, digit run, symbol run, lone quote.
START, SPACED, LETTERS, DIGITS, SYMBOLS, QUOTED = range(6)
ROW = 64
#: Entries of each of the two generations of cached slices.
CACHE = 300_000
LONG_PIECE = 200


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks by token from a file of 'base64 rank' lines."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


def class_table() -> np.ndarray:
    """Class of each code point. Which are letters, numbers and white space is asked of the library
    whose results are to be matched, so both have the same Unicode version."""
    import tiktoken

    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", WHITE)):
        found = bytes(tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        table[np.frombuffer(found.decode().encode("utf-32-le"), "<u4")] = kind
    table[ord(" ")] = BLANK
    table[ord("'")] = QUOTE
    return table


def _transitions() -> np.ndarray:
    """Next state by (class, state); classes 6 to 11 are those of a document's first code point, which forget the state."""
    t = np.zeros((12, 6), np.uint8)
    t[WHITE], t[BLANK], t[LETTER], t[DIGIT], t[OTHER] = START, SPACED, LETTERS, DIGITS, SYMBOLS
    t[QUOTE] = [QUOTED, SYMBOLS, QUOTED, QUOTED, SYMBOLS, SYMBOLS]
    for kind in range(6):
        t[6 + kind] = t[kind][START]
    return t


_FLAT = _transitions().ravel()


def scan(symbols: np.ndarray) -> np.ndarray:
    """State after each symbol, by an associative scan of transition functions."""
    n = len(symbols)
    rows = max(1, -(-n // ROW))
    grid = np.full(rows * ROW, 6 + WHITE, np.intp)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T) * 6
    whole = np.broadcast_to(np.arange(6, dtype=np.uint8), (rows, 6))
    for column in grid:  # the function of each row: its end state for each entry state
        whole = _FLAT[column[:, None] + whole]
    step = 1
    while step < rows:  # the function of all rows up to each
        after = whole.copy()
        after[step:] = np.take_along_axis(whole[step:], whole[:-step].astype(np.intp), 1)
        whole, step = after, 2 * step
    state = np.zeros(rows, np.uint8)
    state[1:] = whole[:-1, START]
    out = np.empty((ROW, rows), np.uint8)
    for i, column in enumerate(grid):
        out[i] = state = _FLAT[column + state]
    return out.T.reshape(-1)[:n]


def token_starts(points: np.ndarray, heads: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point. heads: whether a document does."""
    kind = classes[points]
    before = np.empty(len(points), np.uint8)
    before[:1] = START
    state = scan(kind + 6 * heads.astype(np.uint8))
    before[1:] = state[:-1]
    starts = np.ones(len(points), bool)
    blank_before = before == SPACED
    starts[(kind == LETTER) & ((before == LETTERS) | blank_before)] = False
    starts[(kind == DIGIT) & ((before == DIGITS) | blank_before)] = False
    symbol = (kind == OTHER) | (kind == QUOTE)
    starts[symbol & ((before == SYMBOLS) | (before == QUOTED) | blank_before)] = False
    white = kind <= BLANK
    more = np.zeros(len(points), bool)  # the next code point is of the same document and not white
    more[:-1] = ~white[1:] & ~heads[1:]
    inner = np.zeros(len(points), bool)
    inner[1:] = white[1:] & white[:-1]
    starts[inner & ~more] = False
    # contractions: a lone quote and its letters are one token, and the next letter starts another
    quote = np.flatnonzero(state == QUOTED)
    if len(quote):
        pad = np.concatenate([points, np.zeros(3, points.dtype)])
        ends = np.concatenate([heads, np.ones(3, bool)])
        a, b = pad[quote + 1], pad[quote + 2]
        here, there = ~ends[quote + 1], ~ends[quote + 2]
        one = here & np.isin(a, [ord(c) for c in "stmd"])
        two = here & there & (((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l"))))
        starts[quote[one | two] + 1] = False
        after = np.concatenate([quote[one] + 2, quote[two] + 3])
        starts[after[after < len(points)]] = True
    starts[heads] = True
    return starts


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: again and again, the leftmost pair of lowest rank becomes one."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    none = 1 << 60
    cuts = list(range(len(piece) + 1))
    of = ranks.get
    pairs = [of(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = of(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = of(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, for very long slices."""
    n = len(piece)
    end, last = list(range(1, n + 1)), list(range(-1, n - 1))  # end of the part at i; the part before it
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue  # a part of this pair has changed since
        middle = end[i]
        alive[middle], end[i] = False, stop
        if stop < n:
            last[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := last[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Merges(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit integers. Two generations of bounded size:
    what was used since the last turnover outlives it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.old = ranks, {}

    def __missing__(self, piece: bytes) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = np.array(merge(piece, self.ranks), "<u4").tobytes()
            if len(piece) > LONG_PIECE:
                return found
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


def encode_block(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, merges: Merges) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray]]:
    """For each document its ids (packed), the byte offsets at which its pre-tokens start, and the number of the first
    id of each."""
    raw = data.tobytes()
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
    at = np.flatnonzero((data & 0xC0) != 0x80)
    heads = np.zeros(len(points), bool)
    first = np.searchsorted(at, offsets)
    heads[first[:-1][first[:-1] < first[1:]]] = True
    cuts = at[token_starts(points, heads, classes)]
    bounds = np.append(cuts, len(data)).tolist()
    ids = list(map(merges.__getitem__, [raw[a:b] for a, b in zip(bounds, bounds[1:])]))
    place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
    of = np.searchsorted(cuts, offsets).tolist()
    return [b"".join(ids[a:b]) for a, b in zip(of, of[1:])], [cuts[a:b] - s for a, b, s in zip(of, of[1:], offsets.tolist())], [place[a:b] - place[a] for a, b in zip(of, of[1:])]


class Vocabulary:
    """Token bytes end to end with their offsets, for decoding by gathers."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, starts: np.ndarray, heads: np.ndarray) -> bytes:
        """Bytes of the slices that start at the byte offsets `starts`, with ids[heads[i] : heads[i + 1]] in slice i; from
        the first slice's offset on."""
        if not len(ids):
            return b""
        size = self.size[ids]
        before = np.cumsum(size) - size
        slice_of = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(ids))))
        put = starts[slice_of].astype(np.int64) - int(starts[0]) + before - before[heads][slice_of]  # place of each id's bytes
        out = np.empty(int(put[-1] + size[-1]), np.uint8)
        within = np.arange(int(size.sum())) - np.repeat(before, size)
        out[np.repeat(put, size) + within] = self.blob[np.repeat(self.start[ids], size) + within]
        return out.tobytes()


_loaded: dict = {}


def _worker(shipped) -> tuple[np.ndarray, Merges, Vocabulary]:
    """Tables of this worker process; they have the fixed size of the vocabulary."""
    key = shipped.id if hasattr(shipped, "id") else id(shipped)
    if key not in _loaded:
        lines, classes = shipped.value
        ranks = load_ranks(lines)
        _loaded.clear()
        _loaded[key] = (np.frombuffer(classes, np.uint8), Merges(ranks), Vocabulary(ranks))
    return _loaded[key]


def ship(spark: SparkSession, ranks_path: str):
    """Broadcast the rank file and class table, both of fixed size (under 2 MB)."""
    with open(ranks_path, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), class_table().tobytes()))


def encode(docs: DataFrame, shipped) -> DataFrame:
    """(doc_id, ids, starts, heads): token ids of whole texts, the byte offset of each pre-token, and the number of its first
    id, all packed as unsigned 32-bit integers. Columns read: doc_id, text; a null or empty text has no ids. Rows are
    independent: ties, repeated or null doc_ids pass through. An empty table gives an empty table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, merges, _ = _worker(shipped)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in blocks(offsets):
                ids, *marks = encode_block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], classes, merges)
                marks = [pa.array([s.astype("<u4").tobytes() for s in own], pa.binary()) for own in marks]
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()), *marks], ["doc_id", "ids", "starts", "heads"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, ids binary, starts binary, heads binary")


def decode(encoded: DataFrame, shipped) -> DataFrame:
    """(doc_id, ids, body): bytes of the ids that encode() gave, each slice put at the offset retained for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, vocabulary = _worker(shipped)
        for batch in batches:
            packed = zip(*(batch.column(i) for i in range(1, 4)))
            bodies = [vocabulary.decode(*(np.frombuffer(x.as_buffer(), "<u4") for x in row)) if row[0].is_valid else None for row in packed]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(bodies, pa.binary())], ["doc_id", "ids", "body"])

    return encoded.select("doc_id", "ids", "starts", "heads").mapInArrow(trimmed(run), "doc_id long, ids binary, body binary")
