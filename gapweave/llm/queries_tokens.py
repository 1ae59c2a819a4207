"""Queries of the token operators: BPE round trip and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.shared import table


def op3_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    from gapweave.llm import bpe

    if ranks_path is None:
        import public_tokenizers

        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    shipped = bpe.ship(spark, ranks_path)
    whole = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), shipped), shipped)
    return whole.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("body", 256).alias("decoded_sha256"))


def op4_best_two_fit(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    from gapweave.llm.packing import packed_pieces

    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return packed_pieces(table(spark, sf_dir, "documents"), tokenizer_path)


QUERIES = {f.__name__: f for f in (op3_byte_bpe, op4_best_two_fit)}
