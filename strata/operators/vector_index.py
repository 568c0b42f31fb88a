"""Approximate nearest neighbours: inverted lists with product-quantised residuals and exact re-ranking.

Vectors of length one are listed under their nearest few centres. What is left of a vector after its centre is cut into
parts, each replaced by the number of the nearest entry of a codebook, so a list holds a few bytes per vector. A search
looks at the lists nearest to a query, adds up looked-up products, and ranks the best candidates by their exact cosine.

Centres and codebooks are fitted on a bounded sample; every vector is listed. An index is a folder: its model, and one
directory per list, of which a search opens those that it probes.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.operators.vectors import cosine, usable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that centres and codebooks are fitted on, and on which the number of lists to probe is measured.
SAMPLE, TRIALS = 20_000, 256
# A task holds about so many codes of a list, and so many queries that probe it.
LIST_BLOCK, QUERY_BLOCK = 1 << 16, 1024


class Model(NamedTuple):
    """``centres`` (lists x dims), ``books`` (parts x entries x dims of a part), and how many lists to probe."""

    centres: np.ndarray
    books: np.ndarray
    probes: int


def _unit(x: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _nearest(x: np.ndarray, to: np.ndarray, count: int) -> np.ndarray:
    far = (to ** 2).sum(1) - 2 * x @ to.T
    return far.argmin(axis=1)[:, None] if count == 1 else np.argsort(far, axis=1, kind="stable")[:, :count]


def _centres(x: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds over a sample; a centre that loses all its rows takes a row drawn anew."""
    out = x[rng.choice(len(x), min(count, len(x)), replace=False)]
    for _ in range(rounds):
        own = _nearest(x, out, 1)[:, 0]
        sums = np.zeros_like(out)
        np.add.at(sums, own, x)
        sizes = np.bincount(own, minlength=len(out))
        out = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], x[rng.integers(len(x), size=len(out))])
    return out


def _encode(residuals: np.ndarray, books: np.ndarray) -> np.ndarray:
    parts, _, width = books.shape
    cut = residuals.reshape(len(residuals), parts, width)
    return np.stack([_nearest(cut[:, j], books[j], 1)[:, 0] for j in range(parts)], axis=1).astype(np.uint8)


def fit(x: np.ndarray, lists: int, parts: int, copies: int, recall: float, seed: int) -> Model:
    """Fit on rows of a sample. The number of lists to probe is the least with which the ten nearest rows of a few
    hundred sampled ones are listed as often as ``recall`` asks for."""
    rng = np.random.default_rng(seed)
    x = _unit(x)
    centres = _centres(x, lists, rng)
    residuals = x - centres[_nearest(x, centres, 1)[:, 0]]
    width = x.shape[1] // parts
    books = np.stack([_centres(residuals[:, j * width:(j + 1) * width], 256, rng) for j in range(parts)])
    asked = x[rng.choice(len(x), min(TRIALS, len(x)), replace=False)]
    wanted = np.argsort(-(asked @ x.T), axis=1, kind="stable")[:, :10]
    place = np.argsort(_nearest(asked, centres, len(centres)), axis=1)
    listed = _nearest(x, centres, copies)
    # The first of the probed lists in which each wanted row stands.
    first = np.stack([place[i][listed[wanted[i]]].min(axis=1) for i in range(len(asked))])
    probes = 1 + int(np.quantile(first, recall, method="higher"))
    return Model(centres, books, probes)


def _lister(model: Model, copies: int, id_col: str, vector_col: str, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column(vector_col)))
            near = _nearest(x, model.centres, copies)
            for c in range(near.shape[1]):
                codes = _encode(x - model.centres[near[:, c]], model.books)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near[:, c], pa.int32()), pa.array([r.tobytes() for r in codes], pa.binary())],
                    names)

    return run


def build(df: DataFrame, path: str, lists: int = 64, parts: int = 16, copies: int = 2, recall: float = 0.95,
          id_col: str = "id", vector_col: str = "vector", payload: Sequence[str] = (), seed: int = 7) -> None:
    """Write an index of all usable vectors (see ``usable``; one without a direction is near to nothing and listed too).

    ``parts`` must divide the dimensions. Fitted on at most ``SAMPLE`` rows, those with the lowest hashes of their ids.
    """
    whole = df.where(usable(F.col(vector_col))).select(
        id_col, F.col(vector_col).cast("array<double>").alias(vector_col), *[c for c in payload if c != id_col])
    sample = whole.orderBy(F.xxhash64(id_col)).limit(SAMPLE).select(vector_col).toArrow().column(0).combine_chunks()
    if not len(sample):
        raise ValueError("no vector to fit an index on")
    x = _matrix(sample)
    if x.shape[1] % parts:
        raise ValueError(f"{parts} parts do not divide {x.shape[1]} dimensions")
    model = fit(x, lists, parts, copies, recall, seed)
    schema = T.StructType([*whole.schema.fields, T.StructField("list", T.IntegerType()), T.StructField("code", T.BinaryType())])
    listed = whole.mapInArrow(_lister(model, copies, id_col, vector_col, schema.names), schema)
    listed.hint("rebalance", "list").write.partitionBy("list").option("compression", "zstd").parquet(f"{path}/lists")
    spark = df.sparkSession
    spark.createDataFrame(
        [(model.centres.tolist(), model.books.tolist(), model.probes, copies, id_col, vector_col)],
        "centres array<array<double>>, books array<array<array<double>>>, probes int, copies int, id_col string, vector_col string"
    ).coalesce(1).write.parquet(f"{path}/model")


class Index:
    """A written index."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        row = spark.read.parquet(f"{path}/model").first()
        self.model = Model(np.array(row.centres), np.array(row.books), row.probes)
        self.id_col, self.vector_col = row.id_col, row.vector_col
        self.lists = spark.read.parquet(f"{path}/lists")

    def probed(self, queries: DataFrame, probes: int | None = None, query_id: str = "query_id",
               query_vector: str = "vector") -> DataFrame:
        """Rows ``_query, _q, list``: each query once for each list to look at. Broken queries (see ``usable``) ask nothing."""
        count, centres = min(probes or self.model.probes, len(self.model.centres)), self.model.centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    near = _nearest(_unit(_matrix(batch.column("_q"))), centres, count)
                    rows = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1])))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(near.ravel(), pa.int32())], ["_query", "_q", "list"])

        asked = queries.where(usable(F.col(query_vector))).groupBy(F.col(query_id).alias("_query")).agg(
            F.min(F.col(query_vector).cast("array<double>")).alias("_q"))
        return asked.mapInArrow(run, T.StructType([*asked.schema.fields, T.StructField("list", T.IntegerType())]))

    def search_many(self, queries: DataFrame, limit: int = 10, probes: int | None = None, candidates: int = 100,
                    query_id: str = "query_id", query_vector: str = "vector") -> DataFrame:
        """Rows ``query_id, match_<id>, score, rank``: of ``candidates`` vectors per query, those ``limit`` with the
        highest exact cosine; ties go to the smaller id.

        Lists meet the queries that probe them in blocks, by equality of list, part of the list and share of the
        queries, so neither a long list nor a crowd of queries lands in one task. Only listed codes are shuffled.
        """
        asked = self.probed(queries, probes, query_id, query_vector)
        # One row per list: how many parts it is cut into, and into how many shares its queries.
        sizes = self.lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_BLOCK).cast("int").alias("_parts"))
        crowd = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("_shares"))
        plan = F.broadcast(sizes.join(crowd, "list"))  # at most one row per list
        left = asked.join(plan, "list").withColumn("_share", F.pmod(F.xxhash64("_query"), F.col("_shares")).cast("int"))
        left = left.select("list", "_query", "_q", "_share", F.explode(F.expr("sequence(0, _parts - 1)")).alias("_part"))
        codes = self.lists.select("list", F.col(self.id_col).alias("_id"), "code").join(plan, "list")
        codes = codes.withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")).select(
            "list", "_id", "code", "_part", F.explode(F.expr("sequence(0, _shares - 1)")).alias("_share"))
        kinds = [asked.schema["_query"].dataType, codes.schema["_id"].dataType]
        near = left.groupBy("list", "_part", "_share").cogroup(codes.groupBy("list", "_part", "_share")).applyInArrow(
            _products(self.model, candidates, *map(to_arrow_type, kinds)), T.StructType([
                T.StructField("_query", kinds[0]), T.StructField("_id", kinds[1]), T.StructField("list", T.IntegerType()),
                T.StructField("_near", T.DoubleType())]))
        near = near.groupBy("_query", "_id").agg(F.max(F.struct("_near", "list")).alias("_best"))
        best = Window.partitionBy("_query").orderBy(F.desc("_best"), "_id")
        short = near.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= candidates).select(
            "_query", "_id", F.col("_best.list").alias("list"))
        vectors = self.lists.select("list", F.col(self.id_col).alias("_id"), F.col(self.vector_col).alias("_v"))
        whole = short.join(vectors, ["list", "_id"]).join(asked.groupBy("_query").agg(F.first("_q").alias("_q")), "_query")
        scored = whole.select("_query", "_id", cosine(F.col("_q"), F.col("_v")).alias("score"))
        order = Window.partitionBy("_query").orderBy(F.desc("score"), "_id")
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select(
            F.col("_query").alias(query_id), F.col("_id").alias(f"match_{self.id_col}"), "score", "rank")

    def search(self, query: Sequence[float], limit: int = 10, probes: int | None = None, candidates: int = 100) -> DataFrame:
        """The same for one query: only the directories of its lists are opened."""
        q = _unit(np.asarray([query], np.float64))
        count = min(probes or self.model.probes, len(self.model.centres))
        some = Index.__new__(Index)
        some.model, some.id_col, some.vector_col = self.model, self.id_col, self.vector_col
        some.lists = self.lists.where(F.col("list").isin([int(k) for k in _nearest(q, self.model.centres, count)[0]]))
        asked = self.lists.sparkSession.createDataFrame([(0, [float(v) for v in query])], "query_id int, vector array<double>")
        return some.search_many(asked, limit, probes, candidates).select(f"match_{self.id_col}", "score", "rank")


def _products(model: Model, keep: int, query_type: pa.DataType, id_type: pa.DataType) -> Callable:
    """Best ``keep`` codes of one part of a list for each query of one share."""

    def run(asked: pa.Table, listed: pa.Table) -> pa.Table:
        kinds = {"_query": query_type, "_id": id_type, "list": pa.int32(), "_near": pa.float64()}
        if not asked.num_rows or not listed.num_rows:
            return pa.table({c: pa.array([], k) for c, k in kinds.items()})
        parts, _, width = model.books.shape
        number = asked.column("list")[0].as_py()
        codes = np.frombuffer(b"".join(listed.column("code").to_pylist()), np.uint8).reshape(-1, parts)
        q = _unit(_matrix(asked.column("_q").combine_chunks()))
        near = np.repeat((q @ model.centres[number])[:, None], len(codes), axis=1)
        for j in range(parts):
            near += (q[:, j * width:(j + 1) * width] @ model.books[j].T)[:, codes[:, j]]
        take = min(keep, len(codes))
        at = np.argpartition(-near, take - 1, axis=1)[:, :take]
        return pa.table({
            "_query": asked.column("_query").take(pa.array(np.repeat(np.arange(len(q)), take))).cast(query_type),
            "_id": listed.column("_id").take(pa.array(at.ravel())).cast(id_type),
            "list": pa.array(np.full(at.size, number), pa.int32()),
            "_near": pa.array(np.take_along_axis(near, at, axis=1).ravel())})

    return run
