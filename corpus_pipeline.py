"""Documents to token ids: language, quality, near copies, benchmark passages, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps with the columns of ``documents``; the last one
returns the encoded documents. Its output is written as Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.cluster import checkpointed
from strata.llm import bpe_queries, decontaminate, jaccard, langid, quality
from strata.llm.registry import fold, register, table
from strata.llm.storage import stored

# A document stays if its language is told with this score or more.
LANGUAGE_FROM = 0.5

# Stages that learn, or follow links of any length, can't be put into SQL; they are tested against brute force.
ORACLE_SQL = None


def _rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The text (and columns) of each row beside the row itself, so that no column of the input is in the way."""
    return docs.select(F.struct("*").alias("_row"), "text", *columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, or whose language isn't clear; NULL and empty texts go with them.

    Without any language to learn from nothing can be rejected but texts without letters.
    """
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    if lettered.where(~fold(4) & F.col("lang").isNotNull()).isEmpty():
        return lettered
    said = langid.identify(_rows(lettered), langid.train(docs, ~fold(4)))
    return said.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LANGUAGE_FROM)).select("_row.*")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained classifiers reject. Without labels nothing is rejected."""
    labels = table(spark, sf_dir, "labels")
    known = labels.where(~fold(4) & F.col("quality").isNotNull())
    if known.join(docs.where("text is not null").select("doc_id"), "doc_id", "left_semi").isEmpty():
        return docs
    model = quality.train(docs, labels, ~fold(4))
    return quality.score(_rows(docs, "lang", "source"), model).where("keep").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: that with the smallest id, NULL last; of equal ids that with the
    lowest hash of the text.

    A document is an id with a text, so rows that repeat an id with other texts are judged by their texts, and rows that
    repeat both are one.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    rows = _rows(docs, "doc_id").withColumn("_key", key)
    joined = jaccard.join(docs.select(key.alias("_key"), "text"), "_key").where(F.col("_key") == F.col("component_id"))
    one = Window.partitionBy("_key").orderBy("text")
    # The key holds NULL ids, so it is compared as a whole.
    first = checkpointed(joined.select(F.col("_key").alias("_first")).distinct())
    return (rows.join(first, rows["_key"].eqNullSafe(first["_first"]), "left_semi")
            .withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return decontaminate.clean(_rows(docs), table(spark, sf_dir, "benchmark")).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the documents that are left, with the digests of ids and decoded text."""
    return bpe_queries.digests(docs, bpe_queries.tokenizer_path(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("bpe", encode),
]


@register("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return docs
