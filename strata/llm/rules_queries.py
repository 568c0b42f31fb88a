"""Query op12: quality rules for all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.registry import fold, register, table
from strata.llm.rules import apply, train


@register("op12_quality_rules")
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), ~fold(4))
    return apply(docs, model).drop("text")
