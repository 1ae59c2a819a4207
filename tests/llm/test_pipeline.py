import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gapweave.llm import pii, shared
from gapweave.llm.shared import table
from tests.llm.cases import documents
from tests.llm.test_langid import brute_rows
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_tokens import check_gapless


def test_run_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = brute_rows([(r["doc_id"], r["lang"], r["source"], None, None, r["text"]) for r in docs.collect()])
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if not judged[r["doc_id"]][5]}
    first = {}
    for i in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    ids = sorted(first.values())
    whole = brute_components(ids, [brute_fingerprint(texts[i]) for i in ids])
    ids = [i for i in ids if whole[i] == i]
    tokenizer, model, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), pii.trained(), {}
    for i in ids:
        text = pii.redact(texts[i], pii.find(texts[i], model)[1])
        tokens = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want |= {(i, a // 4096): (a, len(tokens[a : a + 4096]), zlib.crc32(tokens[a : a + 4096].tobytes())) for a in range(0, len(tokens), 4096)}
    before = shared.made()
    got = __spark_entry__.queries()["pipeline"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    check_gapless(got)
    assert shared.made() - before < 12  # the stages' scratch tables went


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_redaction_takes_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = {r["doc_id"]: r for r in corpus_pipeline.personal_data(spark, docs, sf_dir).collect()}
    for r in docs.collect():
        base, every = pii.find(r["text"], pii.trained())
        assert out[r["doc_id"]]["text"] == pii.redact(r["text"], every)
        assert not every or out[r["doc_id"]]["n_chars"] == len(out[r["doc_id"]]["text"])


def test_awkward_rows(spark, sf_dir):
    docs = documents(spark).withColumn("lang", F.lit("en"))
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.materialise(stage(spark, docs, sf_dir), "stage")
    got = [r["doc_id"] for r in docs.collect() if r["piece"] == 0]
    assert {1, 6, 10} <= set(got) and not set(got) & {2, 3, 4, 5, 7, 9, None}
    assert len(got) == len(set(got))  # of the rows that repeat doc_id and text one is left


def test_rows_that_repeat_a_doc_id_lose_no_text(spark, sf_dir):
    rows = [(1, "same text"), (5, "same text"), (5, "a unique text of some more words"), (5, "a  unique text of some more words"), (None, "same text"), (None, "no other has this")]
    docs = shared.materialise(documents(spark, rows).repartition(3), "rows")
    for stage in (corpus_pipeline.exact, corpus_pipeline.near):
        got = stage(spark, docs, sf_dir).collect()
        assert sorted((str(r["doc_id"]), " ".join(r["text"].split())) for r in got) == [("1", "same text"), ("5", "a unique text of some more words"), ("None", "no other has this")]
        assert sorted(map(str, (tuple(r) for r in stage(spark, documents(spark, rows), sf_dir).select("doc_id", "key", "u").collect()))) == ["(1, 1, 'u')", "(5, 1, 'u')", "(None, 1, 'u')"]


def test_dropped_rows_by_either_join(spark):
    docs = shared.numbered(shared.materialise(documents(spark), "rows"))
    dropped = docs.filter("doc_id in (1, 6)")
    small, large = shared.without(docs, dropped), shared.without(docs, dropped, most=0)
    assert sorted(map(str, (r["doc_id"] for r in small.collect()))) == sorted(map(str, (r["doc_id"] for r in large.collect())))
    assert small.count() == docs.count() - 2 and small.columns == documents(spark).columns
