"""Exact deduplication by a log-structured merge index of text digests.

Each task keeps a memtable (digest -> smallest doc_id, rows). A full memtable is flushed as a run
sorted by digest, cut at the bounds of digest bands, each piece with a Bloom filter of its digests.
A band's task takes the runs' pieces one after the other: it probes the filters of the runs that it holds,
skips those that cannot have any of the new digests, looks the others up by
their order, and adds what it finds to the entry there, which keeps the smallest identifier. Digests that no run has form a
run of their own; runs of one tier are merged, by their order, into one of the next. What is left is
the level: one row a digest.

Digests that several rows have are hits. Their texts, chosen by a Bloom filter of fixed size, travel once, in salted groups,
and each is compared byte by byte with that of the row that stays. Texts that share a digest and yet
differ are grouped by the text itself. All other rows are done where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gapweave.llm.filters import Bloom, build, size_for
from gapweave.llm.kernels import U64, mix, trimmed
from gapweave.llm.packets import grouped, pack, sizes, unpack
from gapweave.llm.shared import discard, materialise

#: Rows of a memtable, and the most it may grow to for very large inputs; digests of a band.
MEMTABLE_ROWS, MAX_MEMTABLE = 200_000, 2_000_000
BAND_ROWS = 400_000
#: Runs of one tier that are merged into one of the next.
FAN = 8
#: Rows of one group of copies that are verified together, and the most groups that are shared out.
SALT_ROWS = 250
MOST_SALTED = 100_000
#: Upper bound of the broadcast filter of hit digests, and of the filter of one run's piece.
FILTER_BYTES = 8 << 20
RUN_FILTER_BYTES = 4 << 20

SPACES = b" \t\n\r\v\f"


def normalise(text: bytes) -> bytes:
    """Each run of space and 0x09-0x0D becomes one space, at the ends too."""
    body = b" ".join(text.split())
    if not body:
        return b" " if text else b""
    return (b" " if text[0] in SPACES else b"") + body + (b" " if text[-1] in SPACES else b"")


def digest(norm: bytes, size: int) -> bytes:
    return hashlib.sha256(norm).digest()[:size]


def key_of(digests: np.ndarray) -> np.ndarray:
    """Keys for filters, of an array of digests."""
    size = digests.dtype.itemsize
    raw = np.zeros((len(digests), 8), np.uint8)
    raw[:, : min(8, size)] = digests.view(np.uint8).reshape(-1, size)[:, :8]
    return mix(raw.view(">u8").ravel().astype(U64))


class Run:
    """Digests in rising order, each with its smallest id (none if has is false) and its number of rows; and a filter."""

    def __init__(self, digests: np.ndarray, ids: np.ndarray, has: np.ndarray, rows: np.ndarray):
        self.digests, self.ids, self.has, self.rows = digests, ids, has, rows
        self._bloom: Bloom | None = None

    def __len__(self) -> int:
        return len(self.digests)

    @property
    def bloom(self) -> Bloom:
        if self._bloom is None:
            self._bloom = Bloom(size_for(len(self), RUN_FILTER_BYTES) or 1, full=not size_for(len(self), RUN_FILTER_BYTES))
            if size_for(len(self), RUN_FILTER_BYTES):
                self._bloom.add(key_of(self.digests))
        return self._bloom

    @staticmethod
    def of(digests: np.ndarray, ids: np.ndarray, has: np.ndarray, rows: np.ndarray) -> Run:
        """Of entries in any order, equal digests joined."""
        order = np.lexsort((ids, ~has, digests))  # the smallest id first, missing ids last
        digests, ids, has = digests[order], ids[order], has[order]
        first = np.flatnonzero(np.concatenate([[True], digests[1:] != digests[:-1]])) if len(digests) else np.zeros(0, np.int64)
        return Run(digests[first], ids[first], has[first], np.add.reduceat(rows[order], first) if len(first) else rows)

    def take(self, which) -> Run:
        return Run(self.digests[which], self.ids[which], self.has[which], self.rows[which])

    def merged(self, other: Run) -> Run:
        """Both, which share no digest, as one run: other's entries go to their places by order."""
        at = np.searchsorted(self.digests, other.digests)
        return Run(*(np.insert(a, at, b) for a, b in zip((self.digests, self.ids, self.has, self.rows), (other.digests, other.ids, other.has, other.rows))))

    def absorb(self, new: Run, live: np.ndarray) -> bool:
        """Add those of new's live entries whose digests are here, and take them out of live. False if the filter says
        that there are none, so that nothing was looked up."""
        some = np.flatnonzero(live)
        some = some[self.bloom.has(key_of(new.digests[some]))]
        if not len(some):
            return False
        at = np.searchsorted(self.digests, new.digests[some])
        at[at == len(self)] = 0
        hit = self.digests[at] == new.digests[some]
        at, some = at[hit], some[hit]
        better = new.has[some] & (~self.has[at] | (new.ids[some] < self.ids[at]))
        self.ids[at[better]], self.has[at[better]] = new.ids[some[better]], True
        self.rows[at] += new.rows[some]
        live[some] = False
        return True

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """Numbers, digests and filter."""
        return pack(self.ids, self.has.astype(np.int64), self.rows), self.digests.tobytes(), self.bloom.bits.tobytes()

    @staticmethod
    def unpacked(numbers: bytes, digests: bytes, bloom: bytes, size: int) -> Run:
        ids, has, rows = unpack(numbers, 3)
        run = Run(np.frombuffer(digests, f"S{size}"), ids, has.astype(bool), rows)
        run._bloom = Bloom(1)
        run._bloom.bits = np.frombuffer(bloom, np.uint8)
        return run


class Memtable:
    """Newest level of the index: entries until they are flushed as a sorted run."""

    def __init__(self, limit: int = MEMTABLE_ROWS):
        self.limit, self.held, self.n = limit, [], 0

    def put(self, digests: np.ndarray, ids: np.ndarray, has: np.ndarray) -> None:
        self.held.append(Run(digests, ids, has, np.ones(len(digests), np.int64)))
        self.n += len(digests)
        if self.n >= 2 * self.limit:  # many may be equal
            self.held = [self._joined()]
            self.n = len(self.held[0])

    def _joined(self) -> Run:
        return Run.of(*(np.concatenate([getattr(r, c) for r in self.held]) for c in ("digests", "ids", "has", "rows")))

    def full(self) -> bool:
        return self.n >= self.limit

    def flush(self) -> Run | None:
        run = self._joined() if self.held else None
        self.held, self.n = [], 0
        return run


class Index:
    """Runs in tiers; no digest is in two of them."""

    def __init__(self, fan: int = FAN):
        self.fan, self.tiers, self.probed, self.skipped = fan, [], 0, 0

    def add(self, run: Run) -> None:
        live = np.ones(len(run), bool)
        for own in (r for tier in self.tiers for r in tier):
            if live.any():
                self.probed += 1
                self.skipped += not own.absorb(run, live)
        if live.any():
            self._place(run.take(live) if not live.all() else run, 0)

    def _place(self, run: Run, tier: int) -> None:
        if len(self.tiers) == tier:
            self.tiers.append([])
        self.tiers[tier].append(run)
        if len(self.tiers[tier]) >= self.fan:
            runs, self.tiers[tier] = self.tiers[tier], []
            self._place(self._one(runs), tier + 1)

    @staticmethod
    def _one(runs: list[Run]) -> Run:
        while len(runs) > 1:
            runs = [a.merged(b) for a, b in zip(runs[::2], runs[1::2])] + runs[len(runs) // 2 * 2 :]
        return runs[0]

    def level(self) -> Run | None:
        runs = [r for tier in self.tiers for r in tier]
        return self._one(sorted(runs, key=len)) if runs else None


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def log(docs: DataFrame, size: int = 32, limit: int = MEMTABLE_ROWS, bands: int = 1, carry: tuple[str, ...] = ()) -> DataFrame:
    """Row log and runs in one table: digest, doc_id and carry of each document; and for each run's piece the band, its
    number in the task, and numbers, digests, filter."""
    schema = docs.select(F.lit(b"").alias("digest"), F.col("doc_id").cast("long"), *carry).schema
    for field in schema:
        field.nullable = True
    schema = schema.add("band", "integer").add("numbers", "binary").add("digests", "binary").add("bloom", "binary")
    names = schema.names
    rest = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kinds = Memtable(limit), None

        def flushed() -> Iterator[pa.RecordBatch]:
            done = table.flush()
            if done is None:
                return
            upper = np.zeros((len(done), 4), np.uint8)
            upper[:, : min(4, size)] = done.digests.view(np.uint8).reshape(-1, size)[:, :4]
            band = (upper.view(">u4").ravel().astype(np.int64) * bands) >> 32
            own, at = np.unique(band, return_index=True)
            for b, x, y in zip(own.tolist(), at.tolist(), [*at[1:].tolist(), len(done)]):
                piece = [pa.array([v], pa.binary()) for v in done.take(slice(x, y)).packed()]
                yield pa.record_batch([pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), *(pa.nulls(1, k) for k in kinds), pa.array([b], pa.int32()), *piece], names)

        for batch in batches:
            kinds = [c.type for c in batch.columns[2:]]
            keys = [digest(normalise(t), size) for t in _texts(batch.column(1))]
            n = len(keys)
            if n:
                table.put(np.array(keys, f"S{size}"), *_ids(batch.column(0)))
                if table.full():
                    yield from flushed()
            yield pa.record_batch([pa.array(keys, pa.binary()), batch.column(0), *batch.columns[2 : 2 + rest], pa.nulls(n, pa.int32()), *(pa.nulls(n, pa.binary()) for _ in range(3))], names)
        yield from flushed()

    return docs.select(F.col("doc_id").cast("long"), "text", *carry).mapInArrow(trimmed(run), schema)


def compact(runs: DataFrame, bands: int, size: int = 32) -> DataFrame:
    """(digest, keep_id, group_size) of the level that all runs (band, numbers, digests, bloom) are merged into."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches):
            index = Index()
            for piece in rows:
                index.add(Run.unpacked(*(x.as_buffer().to_pybytes() for x in piece), size))
            level = index.level()
            for a in range(0, len(level), 1 << 14):
                part = level.take(slice(a, a + (1 << 14)))
                raw = part.digests.tobytes()
                digests = pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.binary())
                yield pa.record_batch([digests, pa.array(part.ids, mask=~part.has), pa.array(part.rows)], ["digest", "keep_id", "group_size"])

    dealt = runs.repartitionById(bands, F.col("band")).sortWithinPartitions("band")
    return dealt.mapInArrow(trimmed(merge), "digest binary, keep_id long, group_size long")


def lookup(level: DataFrame, digests: list[bytes]) -> DataFrame:
    """The level's rows of a few digests; the files are sorted, so row groups whose ranges exclude them are not read."""
    return level.filter(F.col("digest").isin([F.lit(d) for d in digests])) if digests else level.limit(0)


def _keys(size: int):
    return lambda batch: key_of(np.array(batch.column(0).to_pylist(), f"S{size}"))


def verify(docs: DataFrame, hits: DataFrame, index: Bloom, n_rows: int, size: int = 32, salt_rows: int = SALT_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(digest, doc_id, carry, keep_id, group_size, kept, body) of the rows that the filter lets through: body is the normalised
    text if it differs from that of the row that stays, else null.

    hits: digest, keep_id, group_size of digests that several rows have, n_rows rows in all."""
    most = max(salt_rows, n_rows // MOST_SALTED)
    large = {bytes(r["digest"]): (-(-r["group_size"] // most), r["keep_id"]) for r in hits.filter(F.col("group_size") > most).collect()}
    shipped = docs.sparkSession.sparkContext.broadcast((index, large))
    fields = docs.select(*carry).schema
    rest = [f.name for f in fields]
    schema = docs.select(F.lit(b"").alias("digest"), F.lit(0).alias("salt"), F.lit(0).alias("kind"), F.col("doc_id").cast("long"), F.lit(0).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(b"").alias("body"), *carry).schema
    for field in schema:
        field.nullable = True

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, large = shipped.value
        turn: dict[bytes, int] = {}
        referred: set[tuple[bytes, bytes]] = set()
        for batch in batches:
            norms = [normalise(t) for t in _texts(batch.column(1))]
            keys = [digest(n, size) for n in norms]
            if not keys:
                continue
            which, salts, kinds = [], [], []
            chosen = np.flatnonzero(index.has(key_of(np.array(keys, f"S{size}")))).tolist()
            ids = batch.column(0).to_pylist()
            for i in chosen:
                n, keep = large.get(keys[i], (1, None))
                salt = 0
                if n > 1:
                    if ids[i] == keep:
                        if (keys[i], norms[i]) not in referred:
                            referred.add((keys[i], norms[i]))
                            which, salts, kinds = which + [i] * (n - 1), salts + list(range(1, n)), kinds + [1] * (n - 1)
                    if ids[i] != keep or keep is None:
                        salt = turn[keys[i]] = (turn.get(keys[i], -1) + 1) % n
                which.append(i)
                salts.append(salt)
                kinds.append(2)
            for a in range(0, len(which), 256):
                own = which[a : a + 256]
                at, none = pa.array(own, pa.int64()), pa.nulls(len(own), pa.int64())
                columns = [pa.array([keys[i] for i in own], pa.binary()), pa.array(salts[a : a + 256], pa.int32()), pa.array(kinds[a : a + 256], pa.int32()), batch.column(0).take(at), none, none]
                yield pa.record_batch([*columns, pa.array([norms[i] for i in own], pa.binary()), *(c.take(at) for c in batch.columns[2:])], schema.names)

    found = docs.select(F.col("doc_id").cast("long"), "text", *carry).mapInArrow(trimmed(probe), schema)
    salts = F.greatest(F.lit(1), F.ceil(F.col("group_size") / F.lit(most)).cast("int"))
    named = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    named = named.select("digest", "salt", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), "keep_id", "group_size", F.lit(None).cast("binary").alias("body"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
    names = ["digest", "doc_id", *rest, "keep_id", "group_size", "kept", "body"]
    out = docs.select(F.lit(b"").alias("digest"), F.col("doc_id").cast("long"), *carry, F.lit(0).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lit(b"").alias("body")).schema
    for field in out:
        field.nullable = True

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hit, reference, stays = None, None, None, False
        for batch in batches:
            rows, own = [], []
            keys, salts, kinds, ids, keeps, counts = (batch.column(i).to_pylist() for i in range(6))
            for i, place in enumerate(zip(keys, salts)):
                if place != now:
                    now, hit, reference, stays = place, None, None, salts[i] == 0
                if kinds[i] == 0:
                    hit = keeps[i], counts[i]
                    continue
                if hit is None:  # the filter let a digest through that one row has
                    rows.append((keys[i], ids[i], ids[i], 1, True, None))
                    own.append(i)
                    continue
                body = batch.column(6)[i].as_buffer()
                if reference is None:
                    reference = body.to_pybytes()
                same = len(body) == len(reference) and body.to_pybytes() == reference
                if kinds[i] == 2:
                    rows.append((keys[i], ids[i], *hit, stays and same, None if same else body.to_pybytes()))
                    own.append(i)
                    stays = False
            if rows:
                key, doc, keep, count, kept, body = zip(*rows)
                at = pa.array(own, pa.int64())
                arrays = [pa.array(key, pa.binary()), pa.array(doc, pa.int64()), *(c.take(at) for c in batch.columns[7:]), pa.array(keep, pa.int64()), pa.array(count, pa.int64()), pa.array(kept), pa.array(body, pa.binary())]
                yield pa.record_batch(arrays, names)

    tasks = n_rows // 4_000 + 1
    tasks = min(tasks, 20_000 + tasks // 50)
    rows = found.union(named).repartition(tasks, "digest", "salt")
    return rows.sortWithinPartitions("digest", "salt", "kind", F.asc_nulls_last("doc_id"), "body").mapInArrow(trimmed(compare), out)


def exact_duplicates(docs: DataFrame, digest_bytes: int = 32, memtable_rows: int = MEMTABLE_ROWS, filter_bytes: int = FILTER_BYTES, band_rows: int = BAND_ROWS, salt_rows: int = SALT_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Groups of texts that are equal after whitespace runs become one space.

    Columns read: doc_id, text, and those named in carry, which come back; others are ignored. Returns one row per input row:
    doc_id, keep_id (smallest doc_id of the group), group_size, kept, digest (binary), carry. Of each group one row has kept true:
    one with the smallest doc_id, also where several rows have it, or, if no row has a doc_id, one of
    them. A null text counts as empty; all empty texts form one group. A null doc_id never becomes keep_id unless the group has
    no other. An empty table gives an empty table.
    """
    bands, limit = sizes(docs.count(), band_rows, memtable_rows, max(memtable_rows, MAX_MEMTABLE))
    logged = materialise(log(docs, digest_bytes, limit, bands, carry), "digest-log")
    runs = logged.filter("band is not null").select("band", "numbers", "digests", "bloom")
    level = materialise(compact(runs, bands, digest_bytes), "digest-level")
    rows = logged.filter("band is null").select("digest", "doc_id", *carry)
    hits = level.filter("group_size > 1")
    n_hits, n_copies = hits.agg(F.count("*"), F.coalesce(F.sum("group_size"), F.lit(0))).first()
    index = build(hits.select("digest"), n_hits, filter_bytes, _keys(digest_bytes)) if n_hits else Bloom(1)
    shipped = docs.sparkSession.sparkContext.broadcast(index)
    columns = ["doc_id", "keep_id", "group_size", "kept", "digest", *carry]
    keys_of = _keys(digest_bytes)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(~shipped.value.has(keys_of(batch))))

    single = rows.mapInArrow(alone, rows.schema).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest", *carry)
    if not n_hits:
        discard(level)
        return single
    checked = materialise(verify(docs, hits, index, n_copies, digest_bytes, salt_rows, carry), "digest-checked")
    discard(level)
    odd = checked.filter("body is not null")
    if odd.isEmpty():
        return single.union(checked.select(*columns))
    group, first = W.partitionBy("digest", "body"), F.asc_nulls_last("doc_id")
    apart = odd.select("doc_id", F.min("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"), (F.row_number().over(group.orderBy(first)) == 1).alias("kept"), "digest", *carry)
    lost = odd.groupBy("digest").agg(F.count("*").alias("lost"))
    rest = checked.filter("body is null").join(lost, "digest", "left").withColumn("group_size", F.col("group_size") - F.coalesce("lost", F.lit(0)))
    return single.union(rest.select(*columns)).union(apart.select(*columns))
