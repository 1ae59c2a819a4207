"""Queries of the filters: language, quality rules and URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapweave.llm.shared import table


def op5_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm import langid

    pages = langid.of_pages(table(spark, sf_dir, "pages"))
    rows = langid.without_markup(pages)
    model = langid.fit(rows, langid.sample(pages))
    return langid.identify(rows, model).withColumnRenamed("id", "page_id")


def op8_ngram_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_path_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.urltree import judge

    return judge(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op5_evidence_fusion, op8_ngram_likelihood_ratio, op9_path_template_tree)}
