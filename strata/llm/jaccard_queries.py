"""Query op10: all documents joined on their shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.jaccard import join
from strata.llm.registry import register, table


@register("op10_ngram_jaccard_join")
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
