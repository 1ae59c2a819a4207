"""Queries of the text operators: personal data, licenses and repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.shared import table


def op1_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"), with_text=False).drop("redacted")


def op6_winnowed_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op7_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.substring import kept_words

    found = kept_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_semi_markov_pii, op6_winnowed_licenses, op7_fixed_block_anchors)}
