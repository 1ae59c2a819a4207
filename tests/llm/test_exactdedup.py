import hashlib
import random
import re

import numpy as np

from gapweave.llm import exactdedup, queries, shared
from gapweave.llm.shared import table
from tests.llm.cases import ROWS, documents


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_normalise_as_the_pattern_says():
    for t in ["", " ", "\n\n", " a", "a ", "a\t\nb", "\x0ba\x0c", "a\x1cb c d", "é  ü"]:
        assert exactdedup.normalise(t.encode()).decode() == norm(t)


def test_query_equals_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(norm(r["text"]), []).append(r["doc_id"])
    got = queries.op10_exact_dedup(spark, sf_dir).collect()
    assert len(got) == len(rows)
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in got:
        own = groups[norm(texts[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(own), len(own), r["doc_id"] == min(own))
        assert r["text_sha256"] == hashlib.sha256(norm(texts[r["doc_id"]]).encode()).hexdigest()


def test_colliding_digests_are_told_apart_by_bytes(spark):
    rows = [(i, f"text {i % 300}") for i in range(900)] + [(2000 + i, None) for i in range(5)]
    got = exactdedup.exact_duplicates(documents(spark, rows), digest_bytes=1, memtable_rows=7).collect()
    want = {}
    for i, t in rows:
        want.setdefault(t, []).append(i)
    by = {i: (min(want[t]), len(want[t])) for i, t in rows}
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got} == by
    assert sum(r["kept"] for r in got) == len(want)


def brute(rows):
    """keep_id, group_size, and how many rows of each (doc_id, normalised text) are kept."""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        order = known + [None] * (len(ids) - len(known))
        out += [(i, order[0], len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(order)]
    return sorted(out, key=str)


def found(docs, **more):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in exactdedup.exact_duplicates(docs, **more).collect()), key=str)


def test_salted_groups(spark):
    rows = [(i, "same  text") for i in range(50)] + [(100, "other"), (3, "same text"), (0, "same text"), (0, "same\ttext")] + [(None, None)] * 9 + [(7, "b"), (None, "b"), (7, "b"), (7, "c")]
    for more in ({}, {"salt_rows": 3}, {"salt_rows": 1, "memtable_rows": 4, "band_rows": 10}):
        assert found(documents(spark, rows).repartition(3), **more) == brute(rows)


def test_awkward_rows(spark):
    assert found(documents(spark)) == brute(ROWS)
    assert found(documents(spark), salt_rows=1) == brute(ROWS)
    assert exactdedup.exact_duplicates(documents(spark).limit(0)).count() == 0
    got = exactdedup.exact_duplicates(documents(spark), carry=("lang", "key")).collect()
    assert len(got) == len(ROWS) and {r["key"] for r in got} == {1}


def test_full_filter_changes_nothing(spark):
    rows = [(i, f"text {i % 140}") for i in range(300)]
    assert found(documents(spark, rows), filter_bytes=4) == found(documents(spark, rows), filter_bytes=1 << 12) == brute(rows)


def run_of(pairs):
    keys, ids = zip(*pairs)
    ids_, has = np.array([i or 0 for i in ids]), np.array([i is not None for i in ids])
    return exactdedup.Run.of(np.array(keys, "S32"), ids_, has, np.ones(len(keys), np.int64))


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_memtable_flushes_a_sorted_run():
    table_ = exactdedup.Memtable(6)
    table_.put(np.array([b"b", b"a", b"b"], "S32"), np.array([5, 7, 2]), np.array([True, True, True]))
    assert not table_.full()
    table_.put(np.array([b"c", b"c", b"d"], "S32"), np.array([0, 9, 0]), np.array([False, True, False]))
    assert table_.full()
    run = table_.flush()
    assert list(zip(run.digests.tolist(), run.ids.tolist(), run.has.tolist(), run.rows.tolist())) == [(b"a", 7, True, 1), (b"b", 2, True, 2), (b"c", 9, True, 2), (b"d", 0, False, 1)]
    assert table_.flush() is None
    again = exactdedup.Run.unpacked(*run.packed(), 32)
    assert (again.digests == run.digests).all() and (again.rows == run.rows).all() and (again.bloom.bits == run.bloom.bits).all()


def test_index_equals_a_dictionary_and_filters_skip_runs():
    rng = random.Random(8)
    for fan in (2, 3, 8):
        index, want = exactdedup.Index(fan), {}
        for _ in range(40):
            pairs = [(key(rng.randrange(400)), rng.choice([None, rng.randrange(10**6)])) for _ in range(rng.randint(1, 30))]
            for k, i in pairs:
                have = want.setdefault(k, [None, 0])
                have[1] += 1
                have[0] = i if have[0] is None else have[0] if i is None else min(i, have[0])
            index.add(run_of(pairs))
        level = index.level()
        assert level.digests.tolist() == sorted(want) or [d.ljust(32, b"\0") for d in level.digests.tolist()] == sorted(want)
        got = {d.ljust(32, b"\0"): [i if h else None, n] for d, i, h, n in zip(level.digests.tolist(), level.ids.tolist(), level.has.tolist(), level.rows.tolist())}
        assert got == want
    index = exactdedup.Index()
    for start in (0, 100, 200):
        index.add(run_of([(key(i), i) for i in range(start, start + 100)]))
    before = index.skipped
    index.add(run_of([(key(i), i + 1000) for i in range(100, 103)]))  # in the second run only
    assert index.skipped - before >= 1 and index.level().rows.sum() == 303


def test_levels_can_be_looked_up(spark):
    rows = exactdedup.log(documents(spark), limit=4, bands=3)
    runs = rows.filter("band is not null").select("band", "numbers", "digests", "bloom")
    level = shared.materialise(exactdedup.compact(runs, 3), "level")
    one = hashlib.sha256(norm("one").encode()).digest()
    assert [(r["keep_id"], r["group_size"]) for r in exactdedup.lookup(level, [one, b"none"]).collect()] == [(10, 3)]
    assert exactdedup.lookup(level, []).count() == 0
