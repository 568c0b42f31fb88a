"""Query op8: language-model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.lm import score
from strata.llm.registry import fold, register, table


@register("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fold(7))
