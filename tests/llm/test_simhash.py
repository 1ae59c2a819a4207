import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from gapweave.llm import queries, shared, simhash
from gapweave.llm.components import components
from gapweave.llm.shared import table
from tests.llm.cases import documents


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    fps, parent = np.array(fps, np.uint64), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(fps[a + 1 :] ^ fps[a]) <= 2) + a + 1:
            x, y = root(ids[a]), root(ids[int(b)])
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_golay_code_is_perfect_and_keys_meet():
    table_ = simhash.golay_table()
    assert (table_ >= 0).all() and len(set(table_.tolist())) == 2048
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 22, 2000)
    b = a ^ (1 << rng.integers(0, 22, 2000)) ^ (1 << rng.integers(0, 22, 2000))
    for x, y in zip(simhash.fuzzy_keys(a, 22), simhash.fuzzy_keys(b, 22)):
        assert set(x) & set(y)
        assert len(set(x)) <= 6


def test_query_equals_brute_force(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op2_simhash_near_dedup(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    whole = brute_components([r["doc_id"] for r in rows], fps)
    assert len(got) == len(rows)
    for r, fp in zip(rows, fps):
        assert got[r["doc_id"]]["fingerprint"] == f"{fp:016x}"
        assert got[r["doc_id"]]["component_id"] == whole[r["doc_id"]]


def links_of(spark, fps, hot, monkeypatch):
    """near_duplicates() on given fingerprints."""
    frame = spark.createDataFrame([(i, str(i)) for i in range(len(fps))], "doc_id long, text string")
    values = [int(f) for f in fps]

    def given(docs, *_, **__):
        def run(batches):
            for b in batches:
                got = np.array([values[int(t)] for t in b.column(1).to_pylist()], np.uint64)
                yield pa.record_batch([b.column(0), pa.array(got.view(np.int64))], ["doc_id", "fp"])

        return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")

    monkeypatch.setattr(simhash, "fingerprints", given)
    return {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame, hot=hot).collect()}


def test_hot_keys_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(12))])
    want = brute_components(list(range(len(fps))), fps)
    assert links_of(spark, fps, 2, monkeypatch) == want
    assert links_of(spark, fps, 256, monkeypatch) == want


def test_awkward_rows(spark):
    docs = documents(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], r["component_id"])
    assert by[1] == by[2] == by[9] == 1
    assert by[3] == by[4] == by[5] == 3
    assert by[6] == by[7] == 6
    assert by[10] == 10
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {3, 10}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    none = documents(spark, [(None, "a"), (None, "a"), (None, "b c d")])
    assert {r["component_id"] for r in simhash.near_duplicates(none).collect()} == {None}


def test_rows_that_repeat_a_doc_id_are_rows_of_their_own(spark, monkeypatch):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "xyz"]
    docs = documents(spark, [(1, texts[0]), (5, texts[0]), (5, texts[1]), (5, texts[1]), (None, texts[2]), (None, texts[2])])
    for most in (10_000, 1):
        monkeypatch.setattr(shared, "HOT_ROWS", most)
        found = shared.materialise(simhash.near_duplicates(docs.withColumn("place", F.monotonically_increasing_id()), carry=("place",)), "found")
        got = found.collect()
        assert sorted(str((r["doc_id"], r["component_id"])) for r in got) == sorted(map(str, [(1, 1), (5, 1), (5, 5), (5, 5), (None, None), (None, None)]))
        assert len({r["component"] for r in got}) == 3
        kept = {r["place"] for r in simhash.kept_rows(found, ("place",)).collect()}
        assert sorted(str(r["doc_id"]) for r in got if r["place"] in kept) == ["1", "5", "None"]


def test_long_chain_of_components(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(7, 7), (3, 2)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)}
    assert components(edges.filter(F.lit(False))).count() == 0
