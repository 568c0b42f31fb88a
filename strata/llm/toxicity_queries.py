"""Query op4: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.registry import fold, register, table
from strata.llm.toxicity import score, train


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), ~fold(4))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold(4), F.lit(False)).alias("held_out"), "score", "predicted",
                      "toxic_words", F.size("spans").alias("n_spans"))
