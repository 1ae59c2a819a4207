"""A corpus cleaned, deduplicated, redacted and packed, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but
the last return the columns of documents. Decisions go by row: of rows that repeat a doc_id each has its own, and of rows
that repeat doc_id and text the first stage of the two deduplications keeps one. Rows with a null doc_id are
rows like others; beside equal or near texts with a doc_id they go. Null and empty texts go in the
first stage, having no language. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapweave.llm import langid, shared
from gapweave.llm.exactdedup import exact_duplicates
from gapweave.llm.packing import packed_pieces
from gapweave.llm.pii import redact_documents
from gapweave.llm.simhash import kept_rows, near_duplicates

#: SQL has no form for the stages; tests compare run() with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus declares. Rejected ones go: those without a letter, those that no
    language's model explains better than chance (other languages, codes, junk), and those without a clear language."""
    docs = shared.numbered(shared.tune(docs))
    rows = langid.of_documents(docs, shared.ROW)
    judged = langid.identify(rows, langid.fit(rows, langid.sample(rows)), shared.ROW)
    return shared.without(docs, judged.filter("rejected"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the smallest doc_id."""
    docs = shared.numbered(shared.tune(docs))
    return shared.without(docs, exact_duplicates(docs, carry=shared.ROW).filter("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest doc_id."""
    docs = shared.numbered(shared.tune(docs))
    found = shared.materialise(near_duplicates(docs, carry=shared.ROW), "near-duplicates")
    return shared.without(docs, found.join(kept_rows(found, shared.ROW), list(shared.ROW), "left_anti"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts."""
    return redact_documents(shared.tune(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    import public_tokenizers

    return packed_pieces(shared.tune(docs), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("exact_dedup", exact), ("simhash_near_dedup", near), ("pii", personal_data), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again by the next."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark = shared.made()
        docs = shared.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        shared.discard_since(spark, mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
