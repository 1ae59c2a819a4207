"""The registered queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm import queries_filters, queries_text, queries_tokens, sql
from gapweave.llm.shared import table


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gapweave.llm.exactdedup import exact_duplicates

    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {f.__name__: f for f in (op2_simhash_near_dedup, op10_exact_dedup)} | queries_tokens.QUERIES | queries_text.QUERIES | queries_filters.QUERIES

ORACLE_SQL = {"op9_path_template_tree": sql.path_template_tree(), "op10_exact_dedup": sql.EXACT_DEDUP}
