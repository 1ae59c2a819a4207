import hashlib
import random

import numpy as np

from gapweave.llm import packets, queries, substring
from gapweave.llm.shared import table
from tests.llm.cases import ROWS, documents, thue_morse


def brute(rows, window=20):
    """By the definition: every window in order of (doc_id, row, start); rows that repeat a doc_id in the order of their
    texts' digests."""
    seen, out = set(), []
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], hashlib.sha256((r[1] or "").encode()).hexdigest())):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    for _, text in (r for r in rows if r[0] is None):
        words = (text or "").encode().split()
        out.append((None, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()))
    return sorted(out, key=str)


def run(docs, **more):
    rows = substring.kept_words(docs, **more).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows), key=str)


def small_rows(n=120, repeated=False):
    rng = random.Random(3)
    phrase = " ".join(f"p{i}" for i in range(27))
    rows = []
    for i in range(n):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
        words[rng.randint(0, len(words)) : 0] = phrase.split()[rng.randint(0, 9) :] * rng.randint(0, 2)
        rows.append((i * 7 % n // (3 if repeated else 1), rng.choice([" ", "\n\t"]).join(words)))
    return rows


def test_packets_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 500):
        columns = rng.integers(-(1 << 63), (1 << 63) - 1, n), np.sort(rng.integers(0, 1 << 40, n)), np.zeros(n, np.int64)
        assert all((a == b).all() for a, b in zip(columns, packets.unpack(packets.pack(*columns), 3)))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = queries.QUERIES["op7_fixed_block_anchors"](spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == brute(rows)


def test_small_alphabets_and_partitions(spark):
    rows = small_rows()
    for window in (1, 2, 5, 20):
        assert run(documents(spark, rows).repartition(5), window=window, band_rows=300, batch=100) == brute(rows, window)
    for filter_bytes in (8, 20_000):  # full, and of several pages
        assert run(documents(spark, rows).repartition(3), filter_bytes=filter_bytes, batch=200, salt_rows=2) == brute(rows)


def test_repeated_doc_ids_keep_the_first(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(10, text), (10, text), (10, text + " more"), (11, "x " + text), (None, text), (12, "short"), (12, "short"), (12, None)]
    for parts in (1, 4):
        assert run(documents(spark, rows).repartition(parts)) == brute(rows)
    rows = small_rows(150, repeated=True)
    rows += rows[:40]
    assert run(documents(spark, rows).repartition(6), band_rows=300, batch=100, salt_rows=3) == brute(rows)


def test_words_that_linear_hashes_confuse(spark):
    x, y = thue_morse(1024)
    filler = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join([*filler[:19], x])), (2, " ".join([*filler[:19], y])), (3, " ".join([*filler[:10], x, *filler[11:30]])), (4, " ".join([*filler[:10], x, *filler[11:30]]))]
    assert run(documents(spark, rows)) == brute(rows)


def test_hashes_that_collide_change_nothing(spark, monkeypatch):
    """Nested functions travel to workers with the patched hashes."""
    rows = [(i // 2, t) for i, t in small_rows(30)] + [(1, " ".join(f"w{i}" for i in range(25)))] * 2
    grams, whole = substring.gram_hash, substring._window_hashes
    for most in (1, 3):
        m = np.uint64(most)
        monkeypatch.setattr(substring, "gram_hash", lambda w, k, lane=0, m=m: grams(w, k, lane) % m)
        monkeypatch.setattr(substring, "_window_hashes", lambda w, k, m=m: (whole(w, k).view(np.uint64) % m).view(np.int64))
        assert run(documents(spark, rows).repartition(3)) == brute(rows)


def test_awkward_rows(spark):
    assert run(documents(spark)) == brute(ROWS)
    assert substring.kept_words(documents(spark).limit(0)).count() == 0
    assert run(documents(spark, [(1, None), (None, "a"), (2, "")])) == brute([(1, None), (None, "a"), (2, "")])


def test_maximal_repeats_are_extended(spark):
    """One passage of 60 words at two places of one document is one segment of 60 words."""
    passage = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(["a", *passage, "b"])), (2, " ".join(["c", "d", "e", *passage]))]
    docs = documents(spark, rows).repartition(2, "doc_id").selectExpr("doc_id", "0L AS row", "text")
    shipped = spark.sparkContext.broadcast(substring.index(docs, 10, 100))
    found = substring.segments(substring.candidates(docs, 20, 10, 3, shipped, 100), 20, 3).collect()
    assert [(r["doc_id"], r["at"], r["n"]) for r in found] == [(2, 3, 60)]


def test_packets_stay_worth_their_rows_at_any_size():
    for rows in (10, 10**6, 10**9, 10**11, 10**13):
        bands, batch = packets.sizes(rows, substring.BAND_ROWS, substring.BATCH, substring.MAX_BATCH)
        assert batch <= substring.MAX_BATCH and batch >= 0.99 * packets.LEAST * (bands - 2)
        assert rows / bands <= max(substring.BAND_ROWS, 1e-5 * rows)
