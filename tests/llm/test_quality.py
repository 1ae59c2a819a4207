import math
import random
from collections import Counter

import numpy as np

from gapweave.llm import quality, queries
from gapweave.llm.kernels import byte_grams
from gapweave.llm.shared import table
from tests.llm.cases import ROWS, documents, thue_morse


def brute(text):
    """Base counts by their definitions."""
    text = text or ""
    data = text.encode()
    words = data.split()
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = [False] * len(words)
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            hit[i : i + 5] = [True] * 5
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, sum(hit), n < 10 or 100 * sum(hit) > 20 * n)


def counts(r):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])


def test_query_equals_brute_force(spark, sf_dir):
    rows = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    labels = {r["doc_id"] for r in table(spark, sf_dir, "labels").collect() if r["quality"] == 1 and not r["toxic"]}
    size = 1 << quality.BITS
    raw, target = np.ones(size), np.zeros(size)
    grams = {i: byte_grams(np.frombuffer((t or "").encode(), np.uint8), quality.GRAM, quality.BITS) for i, t in rows.items()}
    for i, g in grams.items():
        np.add.at(raw, g, 1)
        if i in labels:
            np.add.at(target, g, 1)
    raw /= raw.sum()
    ratio = np.log((target + quality.SMOOTH * raw) / (target.sum() + quality.SMOOTH)) - np.log(raw)
    got = queries.QUERIES["op8_ngram_likelihood_ratio"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        assert counts(r) == brute(rows[r["doc_id"]])
        g = grams[r["doc_id"]]
        score = math.fsum(ratio[g]) / (len(g) + quality.SHRINK)
        assert abs(score - r["score"]) < 1e-6
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)


def test_good_documents_stay_and_poor_ones_go(spark, sf_dir):
    got = queries.QUERIES["op8_ngram_likelihood_ratio"](spark, sf_dir.replace("0.001", "0.01"))
    labels = table(spark, sf_dir.replace("0.001", "0.01"), "labels")
    rows = got.join(labels, "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    poor = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(poor) < 0.25


def test_awkward_rows(spark):
    rows = [*ROWS, (60, "a b\n\na b\n a b\na b"), (61, "x # <b> | $5 & 50%\n" * 9), (62, "é " * 30), (63, "\n\n\n"), (64, "w1 w2 w3 w4 w5 w6 w1 w2 w3 w4 w5 w7")]
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None), (6, 0, 0), (999, 1, None)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    got = quality.quality(docs, labels).collect()
    assert sorted((str(r["doc_id"]), counts(r)) for r in got) == sorted((str(i), brute(t)) for i, t in rows)
    none = quality.quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0} and all(r["kept"] != r["base_failed"] for r in none)
    assert quality.quality(docs.limit(0), labels).count() == 0


def base(texts):
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    found = quality.base_counts(np.frombuffer(data, np.uint8), offsets)
    return [tuple(int(v[i]) for v in found.values()) for i in range(len(texts))]


def test_hashes_that_collide_change_nothing(monkeypatch):
    rng = random.Random(4)
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "cc", *thue_morse(1024)]) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 8))) for _ in range(60)]
    x, y = thue_morse(1024)
    texts += [f"{x}\n{y}", f"{x} {x} {y} {y} {x} {y} {y} {x} {x} {y}", "", f"a\tb c d e\n a b c d e"]
    want = [brute(t)[:5] for t in texts]
    assert base(texts) == want
    spans, grams = quality.span_hash, quality.gram_hash
    for most in (1, 3):
        monkeypatch.setattr(quality, "span_hash", lambda d, a, b: spans(d, a, b) % np.uint64(most))
        monkeypatch.setattr(quality, "gram_hash", lambda w, k: grams(w, k) % np.uint64(most))
        assert base(texts) == want
