"""Query op3: all documents encoded and decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.bpe import encode
from strata.llm.registry import register, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Number and digests of the ids and of the decoded text of each document, and the ids if asked for."""
    out = encode(docs, tokenizer, decoded_col="decoded")
    return out.select(
        "doc_id", *["ids"] * with_ids, F.size("ids").cast("long").alias("n_tokens"),
        _digest(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        _digest(F.col("decoded")).alias("decoded_sha256"))


@register("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), tokenizer_path())
