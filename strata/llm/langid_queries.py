"""Query op6: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.langid import identify, train
from strata.llm.registry import fold, register, table


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~fold(4))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold(4), F.lit(False)).alias("held_out"), "lang_pred", "score", "share")
