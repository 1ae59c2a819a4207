import random
from collections import Counter

import numpy as np

from gapweave.llm import licenses, queries
from gapweave.llm.shared import table
from tests.llm.cases import ROWS, documents

INDEX = licenses.Index()
LINES = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All rights reserved.": "proprietary"}


def test_query_finds_every_planted_line(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = queries.QUERIES["op6_winnowed_licenses"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]]
        assert r["licenses"] == ",".join(sorted({n for line, n in LINES.items() if line in text}))
        for span in filter(None, r["spans"].split(",")):
            name, _, a, b = span.rsplit(":", 3)
            assert any(n == name and line.rstrip(".") == text[int(a) : int(b)] for line, n in LINES.items())


def test_winnowing_keeps_one_of_each_window():
    for t, ids in enumerate(INDEX.words):
        kept = {j for posts in INDEX.postings.values() for u, j in posts if u == t}
        n = len(INDEX.hashes(ids))
        for a in range(max(1, n - licenses.WINDOW + 1)):
            assert kept & set(range(a, a + licenses.WINDOW))


def test_edited_notices_are_found_with_their_spans():
    rng = random.Random(1)
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            words = text.split()
            if len(words) < 30:
                continue
            for _ in range(len(words) // 20):
                i = rng.randrange(2, len(words) - 2)
                words[i : i + 1] = rng.choice([[], ["changed"], [words[i], "added"]])
            noise = " ".join(rng.choices(["lorem", "ipsum", "dolor"], k=40))
            whole = f"{noise} Ümlaut {' '.join(words)} {noise}"
            found = licenses.scan(whole, INDEX)
            assert name in {f[0] for f in found}, (name, found)
            a, b = min(f[3] for f in found), max(f[4] for f in found)
            start = len(noise) + 8
            assert abs(a - start) < 40 and abs(b - (start + len(" ".join(words)))) < 40


def full(text, template):
    """Score of the best local alignment, without a band."""
    above, best = [0] * (len(text) + 1), 0
    for w in template:
        row = [0]
        for i, t in enumerate(text):
            row.append(max(0, above[i] + (licenses.MATCH if t == w else licenses.MISS), above[i + 1] + licenses.GAP, row[i] + licenses.GAP))
            best = max(best, row[-1])
        above = row
    return best


def test_banded_alignment_equals_the_full_one_within_its_band():
    rng = np.random.default_rng(2)
    for _ in range(60):
        template = rng.integers(1, 9, 14)
        at = int(rng.integers(0, 10))
        text = rng.integers(20, 30, 30)
        own = np.delete(template, rng.integers(0, 14, 2))
        text[at : at + len(own)] = own
        assert licenses.align(text, template, at, band=14)[5] == full(text.tolist(), template.tolist())


def test_a_notice_with_words_put_in_between_is_one_span():
    for name in ("MIT", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "ISC"):
        text = next(t for t in reversed(licenses.TEMPLATES[name]) if len(t.split()) >= 30)
        words = text.split()
        middle = len(words) // 2
        whole = " ".join([*words[:middle], *(f"page{i} header" for i in range(10)), *words[middle:]])
        found = licenses.scan("lorem " + whole + " ipsum", INDEX)
        assert [(f[0], f[3]) for f in found] == [(name, 6)] and abs(found[0][4] - 6 - len(whole)) < 3 and found[0][1] > 0.95, (name, found)
        two = licenses.scan(f"{text} ipsum {whole}", INDEX)
        assert [f[0] for f in two] == [name, name]


def test_whole_licenses_with_edits():
    rng = random.Random(6)
    for name, (text,) in licenses.whole_texts().items():
        assert [(f[0], f[1]) for f in licenses.scan("x " + text, INDEX)] == [(name, 1.0)]
        words = text.split()
        for _ in range(len(words) // 100):
            words[rng.randrange(len(words))] = "changed"
        del words[len(words) // 3 : len(words) // 3 + 30]
        found = max(licenses.scan("x " + " ".join(words), INDEX), key=lambda f: f[2])
        assert found[0] == name and found[1] > 0.93, (name, found)
    for name in ("BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "Zlib"):
        assert [f[:2] for f in licenses.scan(f"a {licenses.TEMPLATES[name][0]} b", INDEX)] == [(name, 1.0)]


def test_offsets_are_those_of_the_text_as_it_is():
    text = "\u0130\u0130\u0130 x \u0130 Released under the MIT License. \u0130"
    (found,) = licenses.scan(text, INDEX)
    assert text[found[3] : found[4]] == "Released under the MIT License"


def best_alignments(text, separators):
    """For each template the best local alignment without a band in each of the documents that `text` joins: matched words."""
    out = []
    n, index = len(text), np.arange(len(text))
    docs = [Counter(text[a:b].tolist()) for a, b in zip(separators, separators[1:])]
    for template in INDEX.words:
        bag = Counter(template.tolist())
        if max((sum((bag & doc).values()) for doc in docs), default=0) < licenses.MIN_COVERAGE * len(template):
            out.append(np.zeros(len(docs), np.int64))  # no alignment can match more words than both have
            continue
        score, matches, best = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((2, n), np.int64)
        for word in template.tolist():
            hit = text == word
            up, up_matches = np.concatenate([[0], score[:-1]]), np.concatenate([[0], matches[:-1]])
            base = up + np.where(hit, licenses.MATCH, licenses.MISS)
            own = up_matches + hit
            down = score + licenses.GAP > base
            base, own = np.where(down, score + licenses.GAP, base), np.where(down, matches, own)
            # the best cell to the left, less the gap to it
            left = np.maximum.accumulate(((base - licenses.GAP * index) << 24) | (n - index)) & ((1 << 24) - 1)
            left = n - left
            score = base[left] + licenses.GAP * (index - left)
            matches = own[left]
            matches[score <= 0] = 0
            score = np.maximum(score, 0)
            better = hit & (score > best[0])
            best[0][better], best[1][better] = score[better], matches[better]
        tops = np.array([best[0][a:b].argmax() + a if b > a else -1 for a, b in zip(separators, separators[1:])])
        out.append(np.where(tops >= 0, best[1][tops], 0))
    return np.array(out)


def test_query_equals_full_alignment(spark, sf_dir):
    """Every document against every template without index, band or hits: whatever aligns well enough is found, nothing else."""
    larger = sf_dir.replace("0.001", "0.01")
    texts = {(sf_dir, r["doc_id"]): r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    texts |= {(larger, r["doc_id"]): r["text"] or "" for r in table(spark, larger, "documents").collect() if any(x in (r["text"] or "") for x in LINES)}
    ids, bounds = [], [0]
    for text in texts.values():
        ids += [INDEX.vocabulary.get(w, 0) for w in licenses._WORD.findall(text.lower())] + [-1] * 60
        bounds.append(len(ids))
    best = best_alignments(np.array(ids), bounds)
    found = {}
    for sf in (larger, sf_dir):
        found |= {(sf, r["doc_id"]): set(filter(None, r["licenses"].split(","))) for r in queries.QUERIES["op6_winnowed_licenses"](spark, sf).collect()}
    for k, i in enumerate(texts):
        size = np.array([len(w) for w in INDEX.words])
        enough = (best[:, k] >= licenses.MIN_COVERAGE * size) & (best[:, k] >= np.minimum(licenses.MIN_WORDS, size))
        names = {INDEX.names[t] for t in np.flatnonzero(enough)}
        # a template within a longer one that is found too gives way to it
        assert found[i] <= names and bool(found[i]) == bool(names), (i, found[i], names)
        longest = max((best[t, k], best[t, k] / size[t], INDEX.names[t]) for t in np.flatnonzero(enough))[2] if names else None
        assert longest is None or longest in found[i]


def test_awkward_rows(spark):
    rows = [*ROWS, (70, "All rights reserved. " * 3000), (71, "Licensed under the license of licensing under the terms"), (72, "Released\nunder THE mit  license")]
    got = {}
    for r in licenses.license_scan(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], r)
    assert got[70]["n_licenses"] == 3000 and got[71]["n_licenses"] == 0 and got[72]["licenses"] == "MIT"
    assert all(got[i]["spans"] == "" for i in (1, 2, 3, 4, 5, 6, 8, 10))
    assert licenses.license_scan(documents(spark).limit(0)).count() == 0
