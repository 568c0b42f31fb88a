"""Query op2: token counts of all documents, before and after edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.registry import register, table
from strata.llm.storage import stored
from strata.llm.tokencount import apply, build

# What the query's edits insert: a word, an ending, white space, digits, and nothing.
INSERTED = (" and more", "'s", "  \n", "2024", "")


def files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def edits_of(text: Column, name: Column) -> Column:
    """Five edits at places that follow from the id: each removes up to 15 characters and inserts a string."""
    length = F.coalesce(F.char_length(text), F.lit(0))
    return F.array(*[F.struct(
        F.lit(i).alias("seq"), F.pmod(F.crc32(F.concat(name.cast("string"), F.lit(f":{i}"))), length + 1).cast("int").alias("start"),
        F.pmod(F.crc32(F.concat(F.lit(f"{i}:"), name.cast("string"))), F.lit(16)).cast("int").alias("removed"),
        F.lit(s).alias("inserted")) for i, s in enumerate(INSERTED)])


@register("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = files()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees, _ = stored(build(docs, ranks, pattern), "trees")
    before = trees.withColumnRenamed("n_tokens", "tokens_before").withColumn("edits", edits_of(F.col("text"), F.col("doc_id")))
    after = apply(before, "edits", ranks, pattern)
    return after.select("doc_id", F.col("tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"),
                        F.char_length("text").cast("long").alias("n_chars_edited"), "encoded")
