"""Query op5: quality of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.quality import score, train
from strata.llm.registry import fold, register, table


@register("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = train(docs, table(spark, sf_dir, "labels"), ~fold(4))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(fold(4), F.lit(False)).alias("held_out"), "score", "text_score", "page_score", "keep")
