"""Query op9: near duplicates of all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.neardup import deduplicate
from strata.llm.registry import register, table


@register("op9_embedding_near_dedup")
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "embeddings"))
