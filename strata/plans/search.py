"""Vector queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.cluster import scratch_path
from strata.operators import vector_index, vector_store, vectors
from strata.plans.registry import register, table

# The query vector: the collection's own vector 0 with its sign pattern shifted, so that no row equals it.
_QUERY_SQL = "(SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE) + 0.05) AS q FROM embeddings WHERE vec_id = 0)"


def _query(spark: SparkSession, sf: str) -> Sequence[float]:
    first = table(spark, sf, "embeddings").filter("vec_id = 0").first()["embedding"]
    return [x + 0.05 for x in first]


def _sql(score: str, order: str, where: str = "", limit: int = 10, extra: str = "") -> str:
    return f"""
        SELECT vec_id, label, round(score, 6) AS score FROM (
            SELECT vec_id, label, {score} AS score
            FROM (SELECT *, CAST(embedding AS DOUBLE[]) AS v FROM embeddings {extra}), {_QUERY_SQL})
        {where} ORDER BY score {order}, vec_id LIMIT {limit}
    """


_COSINE, _DOT, _EUCLID = ("list_cosine_similarity(v, q)", "list_dot_product(v, q)", "list_distance(v, q)")


def _search(spark: SparkSession, sf: str, metric: str, **options) -> DataFrame:
    frame = options.pop("frame", table(spark, sf, "embeddings"))
    out = vectors.search(frame, _query(spark, sf), metric=metric, id_col="vec_id", vector_col="embedding",
                         payload=["label"], **options)
    return out.withColumn("score", F.round("score", 6))


@register("vector_search_cosine", _sql(_COSINE, "DESC"))
def vector_search_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "Cosine")


@register("vector_search_dot", _sql(_DOT, "DESC"))
def vector_search_dot(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "Dot")


@register("vector_search_euclid", _sql(_EUCLID, "ASC"))
def vector_search_euclid(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "Euclid")


@register("vector_search_threshold", f"""
    SELECT 'cosine' AS metric, * FROM ({_sql(_COSINE, "DESC", "WHERE score >= 0.1", 100)})
    UNION ALL SELECT 'euclid', * FROM ({_sql(_EUCLID, "ASC", "WHERE score <= 1.4", 100)})
""")
def vector_search_threshold(spark: SparkSession, sf: str) -> DataFrame:
    near = _search(spark, sf, "cosine", limit=100, threshold=0.1).withColumn("metric", F.lit("cosine"))
    close = _search(spark, sf, "euclid", limit=100, threshold=1.4).withColumn("metric", F.lit("euclid"))
    return near.union(close)


@register("vector_search_filtered", _sql(_COSINE, "DESC", extra="WHERE label = 3"))
def vector_search_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "cosine", frame=table(spark, sf, "embeddings").filter("label = 3"))


@register("vector_search_batch", """
    SELECT query_id, match_vec_id, round(score, 6) AS score, rank FROM (
        SELECT a.vec_id AS query_id, b.vec_id AS match_vec_id, list_cosine_similarity(a.v, b.v) AS score,
               CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.vec_id)
                    AS INTEGER) AS rank
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a,
             (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b)
    WHERE rank <= 5
""")
def vector_search_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Five nearest neighbours of every vector."""
    collection = table(spark, sf, "embeddings")
    queries = collection.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    out = vectors.search_many(collection, queries, 5, "cosine", "vec_id", "embedding")
    return out.withColumn("score", F.round("score", 6))


@register("vector_upsert", """
    SELECT vec_id, label, round(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM (
        SELECT vec_id, label, embedding AS v FROM embeddings WHERE label <> 3
        UNION ALL SELECT vec_id, label + 200, list_transform(embedding, lambda x: CAST(x * 3 AS FLOAT))
        FROM embeddings WHERE label = 3
        UNION ALL SELECT vec_id + 1000000000, label + 200, list_transform(embedding, lambda x: CAST(x * 3 AS FLOAT))
        FROM embeddings WHERE label = 4)
""")
def vector_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stored collection filled and then updated: vectors of one label are replaced, and those of another come in under
    new ids; each update is sent twice, and the later version counts."""
    given = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    dim = given.select(F.max(F.size("embedding"))).first()[0]
    collection = vector_store.create(spark, scratch_path(spark, "collection"), given.schema.simpleString()[7:-1], dim,
                                     "cosine", 16, "vec_id", "embedding")
    collection.upsert(given)

    def update(version: int) -> DataFrame:
        moved = F.expr(f"transform(embedding, x -> CAST(x * {version + 1} AS FLOAT))")
        new_id = F.expr("CASE WHEN label = 4 THEN vec_id + 1000000000 ELSE vec_id END")
        return given.filter("label IN (3, 4)").select(
            new_id.alias("vec_id"), moved.alias("embedding"), (F.col("label") + 100 * version).alias("label"),
            F.lit(version).alias("version"))

    collection.upsert(update(1).union(update(2)), ["version"])
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return collection.read().select("vec_id", "label", F.round(total, 6).alias("total"))


@register("vector_store_search", _sql(_EUCLID, "ASC", extra="WHERE label <> 3"))
def vector_store_search(spark: SparkSession, sf: str) -> DataFrame:
    """Search of what was inserted into a stored collection, by its own metric and with a condition on the payload."""
    given = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    query = _query(spark, sf)
    collection = vector_store.create(spark, scratch_path(spark, "collection"), given.schema.simpleString()[7:-1], len(query),
                                     "euclid", 16, "vec_id", "embedding")
    collection.upsert(given)
    return collection.search(query, 10, payload=["label"], where=F.col("label") != 3).withColumn("score", F.round("score", 6))


@register("vector_search_ann")
def vector_search_ann(spark: SparkSession, sf: str) -> DataFrame:
    """Ten neighbours of every twentieth vector from a stored index that is probed in part; tests measure the recall."""
    given = table(spark, sf, "embeddings")
    path = scratch_path(spark, "index")
    vector_index.build(given, path, id_col="vec_id", vector_col="embedding")
    asked = given.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return vector_index.Index(spark, path).search_many(asked, 10).withColumn("score", F.round("score", 6))


@register("embed_batch")
def embed_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a vector of 256 dimensions and length one (zero without words)."""
    return vectors.embed(table(spark, sf, "documents"), "text").select("doc_id", "vector")


@register("semantic_search")
def semantic_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten documents nearest to the text of the first one."""
    documents = table(spark, sf, "documents")
    text = documents.agg(F.min_by("text", "doc_id")).first()[0]
    out = vectors.semantic_search(documents, "text", text, 10, 256, "doc_id", ["lang", "source"])
    return out.withColumn("score", F.round("score", 6))
