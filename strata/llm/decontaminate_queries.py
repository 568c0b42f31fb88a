"""Query op7: benchmark items in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.decontaminate import find
from strata.llm.registry import register, table


@register("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.item").alias("item_id"), "leak.similarity", "leak.start", "leak.end")
