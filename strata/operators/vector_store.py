"""Stored vector collections: settings kept with the rows, upserts that touch only the directories they must.

A collection is a folder: ``settings`` (dimensions, metric, number of buckets, names of id and vector) and ``rows``, one
directory per bucket of the id's hash. An upsert reads and replaces the directories of its ids and no others. Replacing
is Spark's dynamic overwrite: a failed job leaves the rows as they were, and one writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from strata.cluster import scratch_path
from strata.operators import vectors

_SETTINGS = "dim int, metric string, buckets int, id_col string, vector_col string"


def create(spark: SparkSession, path: str, schema: str, dim: int, metric: str = "cosine", buckets: int = 64,
           id_col: str = "id", vector_col: str = "vector") -> Collection:
    """A new, empty collection. ``schema`` names all columns; a folder that holds one already is refused."""
    missing = {id_col, vector_col} - set(spark.createDataFrame([], schema).columns)
    if missing:
        raise ValueError(f"the schema lacks {', '.join(sorted(missing))}")
    row = (dim, vectors.metric_name(metric), buckets, id_col, vector_col)
    spark.createDataFrame([row], _SETTINGS).coalesce(1).write.mode("errorifexists").parquet(f"{path}/settings")
    none = spark.createDataFrame([], schema).coalesce(1)
    none.write.parquet(f"{path}/schema")
    none.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/rows")
    return Collection(spark, path)


class Collection:
    def __init__(self, spark: SparkSession, path: str) -> None:
        row = spark.read.schema(_SETTINGS).parquet(f"{path}/settings").first()
        self.spark, self.path = spark, path
        self.dim, self.metric, self.buckets, self.id_col, self.vector_col = row
        self.schema = spark.read.parquet(f"{path}/schema").schema

    def bucket(self, id_col: Column) -> Column:
        return F.pmod(F.xxhash64(id_col), F.lit(self.buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows as stored, all or those of some buckets; other directories are not listed."""
        kinds = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(kinds).parquet(f"{self.path}/rows")
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(list(buckets)))
        return rows.select(*self.schema.names)

    def upsert(self, updates: DataFrame, order_by: Sequence[str] = ()) -> int:
        """Replace rows by id and add new ones, as ``vectors.upsert`` does; the number of directories that were touched.

        Only those directories are read, merged and replaced. Their numbers, at most ``buckets``, pass through the driver.
        """
        updates = vectors.with_ids(updates, self.schema[self.id_col].dataType, self.id_col)
        touched = [r[0] for r in updates.select(self.bucket(F.col(self.id_col))).distinct().collect()]
        if not touched:
            return 0
        merged = vectors.upsert(self.read(touched), updates, self.dim, order_by, self.id_col, self.vector_col)
        # The new rows are put down before the old ones are replaced, so no job reads what it overwrites.
        path = scratch_path(self.spark, "merged")
        merged.write.parquet(path)
        rows = self.spark.read.schema(self.schema).parquet(path).withColumn("bucket", self.bucket(F.col(self.id_col)))
        (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/rows"))
        return len(touched)

    def get(self, ids: Sequence) -> DataFrame:
        """Rows with these ids; only their directories are read."""
        if not ids:
            return self.read([])
        asked = self.spark.createDataFrame([(i,) for i in ids], ["i"]).select(
            self.bucket(F.col("i").cast(self.schema[self.id_col].dataType))).distinct().collect()
        return self.read([r[0] for r in asked]).where(F.col(self.id_col).isin(list(ids)))

    def search(self, query: Sequence[float], limit: int = 10, threshold: float | None = None,
               payload: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """The best vectors by the collection's metric, of all rows or of those that ``where`` holds for."""
        if len(query) != self.dim:
            raise ValueError(f"expected {self.dim} dimensions, got {len(query)}")
        rows = self.read() if where is None else self.read().where(where)
        return vectors.search(rows, query, limit, self.metric, threshold, self.id_col, self.vector_col, payload)
