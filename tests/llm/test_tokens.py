import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gapweave.llm import bpe, packing, queries
from gapweave.llm.kernels import blocks, utf8
from gapweave.llm.shared import table
from tests.llm.cases import ROWS, documents, thue_morse

RANKS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS_PATH = public_tokenizers.path("word_bpe_49k.json")
RANKS = bpe.load_ranks(open(RANKS_PATH, "rb").read())
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CLASSES, MERGES, VOCABULARY = bpe.class_table(), bpe.Merges(RANKS), bpe.Vocabulary(RANKS)
ALPHABET = ["'", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "''", " ", "  ", "\n", "\t", "\xa0", "　", "a", "b", "s", "re", "l", "r", "v", "1", "½", "é", "日", "́", "\U0001f600", "!", "-", "\x1c", "\x85", "​"]


def packed(text):
    return np.array(TIKTOKEN.encode_ordinary(text), "<u4").tobytes()


def encoded(texts, most=1000):
    data, offsets = utf8(pa.array(texts))
    out = []
    for a, b in blocks(offsets, most):
        out += zip(*bpe.encode_block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], CLASSES, MERGES))
    return out


def test_random_texts_as_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 50))) for _ in range(4000)] + ["a" * 3000, "é日" * 900, "ab" * 600 + " " * 50 + "!" * 700, "", " "]
    for text, (ids, starts, heads) in zip(texts, encoded(texts)):
        assert ids == packed(text), text
        assert VOCABULARY.decode(np.frombuffer(ids, "<u4"), starts, heads) == text.encode()
        if len(heads) > 2:  # some slices alone, by the offsets retained for them
            a, b = sorted(rng.sample(range(len(heads)), 2))
            part = VOCABULARY.decode(np.frombuffer(ids, "<u4")[heads[a] : heads[b]], starts[a:b], heads[a:b] - heads[a])
            assert part == text.encode()[starts[a] : starts[b]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text_as_the_library(texts):
    assert [e[0] for e in encoded(texts, 30)] == [packed(t) for t in texts] if texts else True


def test_scan_equals_a_loop():
    symbols = np.random.default_rng(0).integers(0, 12, 1000).astype(np.uint8)
    state, want = 0, []
    for s in symbols:
        state = bpe._FLAT[6 * s + state]
        want.append(state)
    assert bpe.scan(symbols).tolist() == want


def test_bpe_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    got = queries.QUERIES["op3_byte_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, text = packed(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_awkward_rows(spark):
    shipped = bpe.ship(spark, RANKS_PATH)
    docs = documents(spark)
    got = bpe.decode(bpe.encode(docs, shipped), shipped).collect()
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), bytes(r["body"]).decode()) for r in got) == sorted((str(i), packed(t or ""), t or "") for i, t in ROWS)
    assert bpe.encode(docs.limit(0), shipped).count() == 0


def test_words_as_the_tokenizer():
    whole = Tokenizer.from_file(WORDS_PATH)
    rng, words = random.Random(6), packing.WordIds(WORDS_PATH)
    alphabet = [*ALPHABET, "\x0b", "\x0c", "İ", "ẞ", "Σ", "á", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "T", "T\u0308", "K", "The", ",", ".", "***", "$$$", "\u212a"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)] + ["\x01 a \x01b \x01", "hello <|endoftext|> world", "a<|startoftext|>b<|endoftext|><|endoftext|>", "<|Endoftext|> <| endoftext |>"]
    check_words(words, whole, texts, 2000)


def check_words(words, whole, texts, most):
    data, offsets = utf8(pa.array(texts))
    got = [x for a, b in blocks(offsets, most) for x in words.encode_block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])]
    assert len(got) == len(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_word_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 25)
    words = packing.WordIds(WORDS_PATH)
    texts = [" ".join(f"word{(i * j) % 37}, And" for i in range(10)) for j in range(50)]
    monkeypatch.setattr(packing, "RECENT", 5)
    check_words(words, words.tokenizer, texts, 100)
    assert words.n_words <= 60


def test_words_that_share_a_hash(monkeypatch):
    real = packing.span_hash
    texts = ["one two three four five six seven", "eight nine ten", "one"] * 3
    for most in (1, 4, 1 << 20):
        monkeypatch.setattr(packing, "span_hash", lambda d, a, b, most=most: real(d, a, b) % np.uint64(most))
        words = packing.WordIds(WORDS_PATH)
        check_words(words, words.tokenizer, texts, 30)
        check_words(words, words.tokenizer, texts[::-1], 8)


def test_words_of_a_pattern_that_linear_hashes_confuse():
    whole, words = Tokenizer.from_file(WORDS_PATH), packing.WordIds(WORDS_PATH)
    for size in (64, 1024, 4096):
        check_words(words, whole, [" ".join(thue_morse(size)), *thue_morse(size)], 1 << 18)


def bin_by_bin(counts, width):
    """Best-two-fit one bin at a time, by trying all pairs."""
    left, bins = counts.tolist(), []
    while any(left[1:]):
        chosen, gap = [], width
        while fits := [n for n in range(1, gap + 1) if left[n]]:
            chosen.append(fits[-1])
            left[fits[-1]] -= 1
            gap -= fits[-1]
        if gap and len(chosen) > 1:
            small = chosen[-1]
            left[small] += 1
            pairs = [a + b for a in range(1, width) if left[a] for b in range(1, a + 1) if left[b] and (a != b or left[a] > 1) and a + b <= gap + small]
            if pairs and max(pairs) > small:
                total = max(pairs)
                a = next(a for a in range(1, width) if left[a] and total - a > 0 and left[total - a] and (2 * a != total or left[a] > 1))
                chosen[-1:] = [a, total - a]
                left[a] -= 1
                left[total - a] -= 1
            else:
                left[small] -= 1
        bins.append(sum(chosen))
    return bins


def test_plan_equals_filling_bin_by_bin():
    rng = np.random.default_rng(7)
    for width in (10, 37, 64):
        for _ in range(20):
            counts = rng.integers(0, 6, width + 1) * (rng.random(width + 1) < 0.6)
            counts[0] = 0
            plan = packing.best_two_fit(counts, width)
            assert (sum((t * np.bincount(c, minlength=width + 1) for c, t in plan), np.zeros(width + 1, int)) == counts).all()
            assert all(sum(c) <= width for c, _ in plan)
            assert sum(t for _, t in plan) == len(bin_by_bin(counts, width))


def test_packing_query(spark, sf_dir):
    whole = Tokenizer.from_file(WORDS_PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    got = queries.QUERIES["op4_best_two_fit"](spark, sf_dir).collect()
    want, total = {}, 0
    for i, t in texts.items():
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for p, a in enumerate(range(0, len(ids), 4096)):
            want[i, p] = (a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    assert check_gapless(got) <= -(-total // 4096) * 1.02 + 1


def check_gapless(rows):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_packing_awkward_rows(spark):
    docs = documents(spark, [*ROWS, *((100 + i, "tie tie tie") for i in range(40))])
    cut = packing.packed_pieces(docs, WORDS_PATH)
    rows = cut.collect()
    assert check_gapless(rows) < 60 and sum(r["piece"] == 0 for r in rows) == len(ROWS) + 40
    for more in ({"rank_rows": 3}, {"rank_rows": 3, "max_buckets": 2}):
        small = packing.pack(cut.drop("sequence_id", "offset"), **more).collect()
        assert check_gapless(small) == check_gapless(rows)
    assert packing.packed_pieces(docs.limit(0), WORDS_PATH).count() == 0
