"""Vector tables: upsert, exact and approximate search, embeddings.

Scores are computed block by block with NumPy inside the tasks that scan the vectors; each task keeps its own best k,
so only k rows per task and query are ever shuffled, and the vectors are not.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from strata.operators.silver import deduplicate

# Tasks receive the scan functions of this module by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ("cosine", "dot", "euclid")

# A cell of a batch search holds so many queries and vectors at least: 4,096 vectors of 1536 doubles are 50 MB. Large
# tables have larger blocks, as far as their numbers fit this room, so that fewer copies of each vector are shuffled.
LEAST_BLOCK, _BLOCK_NUMBERS, _BLOCKS = 4096, 1 << 21, 24
_QUERIES_AT_ONCE = 256
_ROW_BLOCK = 4096
# Cosines of vectors whose lengths lie between these can be looked through in single precision first.
_SHORT, _LONG = 1e-100, 1e100


def metric_name(metric: str) -> str:
    """Metric by name, upper or lower case."""
    if metric.lower() not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRICS)}")
    return metric.lower()


def checked_vector(vector: Column, dim: int) -> Column:
    """The vector, or an error when its length is not the collection's."""
    return F.when(F.size(vector) == dim, vector).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(vector).cast("string"))))


def with_ids(rows: DataFrame, id_type: T.DataType, id_col: str = "id") -> DataFrame:
    """Rows with an id each. Where ids are text, rows without one get the md5 of all their columns; other ids must be given."""
    given = F.col(id_col).cast(id_type)
    if isinstance(id_type, T.StringType):
        return rows.withColumn(id_col, F.coalesce(given, F.md5(F.to_json(F.struct("*")))))
    return rows.withColumn(id_col, F.when(given.isNotNull(), given).otherwise(F.raise_error(F.lit(f"{id_col} is missing"))))


def upsert(collection: DataFrame, updates: DataFrame, dim: int, order_by: Sequence[str] = (), id_col: str = "id",
           vector_col: str = "vector") -> DataFrame:
    """Replace rows by id and add new ones; of several updates with one id the last by ``order_by`` wins."""
    named = with_ids(updates, collection.schema[id_col].dataType, id_col)
    named = named.withColumn(vector_col, checked_vector(F.col(vector_col), dim))
    latest = deduplicate(named, [id_col], order_by).select(*collection.columns)
    replaced = named.select(id_col).distinct()
    return collection.join(replaced, id_col, "left_anti").select(*collection.columns).union(latest)


def usable(vector: Column) -> Column:
    """Whether there is a vector, without an element that is NULL or not finite."""
    bad = F.exists(vector.cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def unusable(df: DataFrame, vector_col: str = "vector") -> DataFrame:
    """Rows that searches set aside."""
    return df.filter(~usable(F.col(vector_col)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of one length; 0 if one has no direction."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda s, t: s * t), F.lit(0.0), lambda acc, v: acc + v)

    sizes = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(sizes > 0, dot(a, b) / sizes).otherwise(0.0)


def _scores(block: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Scores (queries x rows); larger is better, distances come out negative."""
    if metric == "euclid":
        sizes = (queries ** 2).sum(1)[:, None] + (block ** 2).sum(1)[None, :]
        square = sizes - 2.0 * queries @ block.T
        near = square < 1e-6 * sizes
        if near.any():  # the expanded form loses digits for near-equal vectors
            q, r = np.nonzero(near)
            square[q, r] = ((queries[q] - block[r]) ** 2).sum(1)
        scores = -np.sqrt(np.maximum(square, 0.0))
    else:
        scores = queries @ block.T
        if metric == "cosine":
            norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(block, axis=1)[None, :]
            scores = np.divide(scores, norms, out=np.zeros_like(scores), where=norms > 0)
    return _rounded(scores)


def _rounded(scores: np.ndarray) -> np.ndarray:
    """Equal vectors may differ in the last bits by their place in a block; 40 bits are kept so that they tie."""
    bits = np.ascontiguousarray(scores).view(np.int64)
    return ((bits + (1 << 11)) & ~np.int64((1 << 12) - 1)).view(np.float64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten()
    if len(flat) != len(column) * dim:
        raise ValueError(f"expected vectors of {dim} dimensions")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _top_in_task(
    ids: pa.Array, queries: np.ndarray, metric: str, k: int, id_col: str, vector_col: str, keep: list[str],
    schema: pa.Schema, threshold: float | None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scan function: best k rows of a task for every query of the block.

    The best so far are one table with the query's number and the score. Every block of vectors adds the rows that
    reach the query's floor, its k-th best score, and the table is cut back to k rows per query.
    """
    dim = queries.shape[1]
    order = [("_q", "ascending"), ("_score", "descending"), (id_col, "ascending")]

    def cut(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """First k rows per query, and each row's place within its query."""
        table = table.take(pc.sort_indices(table, sort_keys=order))
        q = table.column("_q").to_numpy()
        place = np.arange(len(q)) - np.searchsorted(q, q)
        return table.filter(pa.array(place < k)), place[place < k]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        floor = np.full(len(ids), -np.inf if threshold is None else threshold)
        for batch in batches:
            batch = batch.filter(batch.column(vector_col).is_valid())
            for start in range(0, batch.num_rows, _ROW_BLOCK):
                part = batch.slice(start, _ROW_BLOCK)
                part = part.take(pc.sort_indices(part.column(id_col)))
                matrix = _matrix(part.column(vector_col), dim)
                whole = np.isfinite(matrix).all(axis=1)
                if not whole.all():
                    part, matrix = part.filter(pa.array(whole)), matrix[whole]
                scores = _scores(matrix, queries, metric)
                if part.num_rows > k:
                    floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
                passing = scores >= floor[:, None]
                # Many equal scores at the floor: the rows are in id order, so a stable sort finds the k to keep.
                for q in np.nonzero(passing.sum(axis=1) > 2 * k)[0]:
                    first = np.argsort(-scores[q], kind="stable")[:k]
                    passing[q] = False
                    passing[q, first] = True
                    passing[q] &= scores[q] >= floor[q]
                q, row = np.nonzero(passing)
                if not len(q):
                    continue
                found = pa.Table.from_batches([part.select(keep)]).take(pa.array(row))
                found = found.append_column("_score", pa.array(scores[q, row])).append_column("_q", pa.array(q))
                best, place = cut(found if best is None else pa.concat_tables([best, found]))
                full = best.filter(pa.array(place == k - 1))
                full_q = full.column("_q").to_numpy()
                floor[full_q] = np.maximum(floor[full_q], full.column("_score").to_numpy())
        if best is not None:
            named = best.append_column("_query", ids.take(best.column("_q").combine_chunks()))
            yield from named.select(schema.names).cast(schema).combine_chunks().to_batches()

    return scan


def _task_tops(df: DataFrame, ids: Sequence, query_type: T.DataType, queries: np.ndarray, metric: str, k: int,
               id_col: str, vector_col: str, payload: Sequence[str], threshold: float | None) -> DataFrame:
    keep = [id_col, *[c for c in payload if c != id_col]]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("_score", T.DoubleType()),
                           T.StructField("_query", query_type)])
    if k < 1:
        return df.select(*keep, F.lit(0.0).alias("_score"), F.lit(None).cast(query_type).alias("_query")).limit(0)
    scan = _top_in_task(pa.array(ids, type=to_arrow_type(query_type)), queries, metric, k, id_col, vector_col, keep,
                        to_arrow_schema(schema), threshold)
    return df.select(vector_col, *keep).mapInArrow(scan, schema)


def search(
    df: DataFrame, query: Sequence[float], limit: int = 10, metric: str = "cosine", threshold: float | None = None,
    id_col: str = "id", vector_col: str = "vector", payload: Sequence[str] = (),
) -> DataFrame:
    """The ``limit`` best vectors with ``score``, best first; ties go to the smaller id.

    ``threshold`` drops worse results: a smallest score, or for euclid a largest distance. Vectors with an element that
    is NULL or not finite are set aside, see ``unusable``; a query with one raises.
    """
    name = metric_name(metric)
    if not np.isfinite(np.asarray(query, dtype=np.float64)).all():
        raise ValueError("the query vector holds a NULL or a number that is not finite")
    bound = None if threshold is None else (-threshold if name == "euclid" else threshold)
    tops = _task_tops(df, [0], T.IntegerType(), np.asarray([query], dtype=np.float64), name, limit, id_col, vector_col,
                      payload, bound)
    score = -F.col("_score") if name == "euclid" else F.col("_score")
    ranked = tops.orderBy(F.desc("_score"), id_col).limit(limit)
    return ranked.select(id_col, score.alias("score"), *[c for c in payload if c != id_col])


def search_many(
    df: DataFrame, queries: DataFrame, limit: int = 10, metric: str = "cosine", id_col: str = "id",
    vector_col: str = "vector", query_id: str = "query_id", query_vector: str = "vector",
    query_block: int | None = None, vector_block: int | None = None,
) -> DataFrame:
    """The ``limit`` best vectors for every query, with ``rank``; ties go to the smaller id.

    Spark deals queries and vectors into blocks by hash; each pair of blocks is one cell, met by equality of both block
    numbers, and keeps its best ``limit`` per query; the cells of a query are merged by rank. So all pairs are scored,
    but only vectors, once per block of queries, and a few rows per cell and query are shuffled. Blocks grow with the
    tables up to a fixed room, unless ``query_block`` and ``vector_block`` say how many rows they hold. Nothing passes
    through the driver but counts. Queries that share an id count once; vectors that share an id stay apart and are dealt
    by what they hold, so an id with many vectors is no hot cell. Broken queries and vectors are set aside, see
    ``unusable``.
    """
    name = metric_name(metric)
    id_type, match_type = queries.schema[query_id].dataType, df.schema[id_col].dataType

    def numbers(rows: DataFrame, vector: str) -> Column:
        """The vectors as they are if they are floats, which take half the room of doubles."""
        narrow = getattr(rows.schema[vector].dataType, "elementType", None) == T.FloatType()
        return F.col(vector) if narrow else F.col(vector).cast("array<double>")

    def blocks(rows: DataFrame, given: int | None) -> int:
        count, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("_vector"))).first()
        size = given or max(LEAST_BLOCK, min(_BLOCK_NUMBERS // max(1, dim or 1), math.ceil(count / _BLOCKS)))
        return max(1, math.ceil(count / size))

    asked = queries.filter(usable(F.col(query_vector))).groupBy(F.col(query_id).alias("_query")).agg(
        F.min(numbers(queries, query_vector)).alias("_vector"))
    held = df.filter(usable(F.col(vector_col))).select(F.col(id_col).alias("_id"), numbers(df, vector_col).alias("_vector"))
    query_blocks, vector_blocks = blocks(asked, query_block), blocks(held, vector_block)

    def block(count: int, *by: str) -> Column:
        return F.pmod(F.xxhash64(*by), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = asked.withColumn("_i", block(query_blocks, "_query")).withColumn("_j", every(vector_blocks))
    right = held.withColumn("_j", block(vector_blocks, "_id", "_vector")).withColumn("_i", every(query_blocks))
    cells = left.groupBy("_i", "_j").cogroup(right.groupBy("_i", "_j")).applyInArrow(
        _cell_tops(name, limit, to_arrow_type(id_type), to_arrow_type(match_type)), T.StructType([
            T.StructField("_query", id_type), T.StructField("_id", match_type), T.StructField("_score", T.DoubleType())]))
    window = Window.partitionBy("_query").orderBy(F.desc("_score"), "_id")
    score = -F.col("_score") if name == "euclid" else F.col("_score")
    return cells.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= limit).select(
        F.col("_query").alias(query_id), F.col("_id").alias(f"match_{id_col}"), score.alias("score"), "rank")


def _cell_tops(metric: str, limit: int, query_type: pa.DataType, id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best ``limit`` vectors of a block for each query of a block."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows or limit < 1:
            return pa.table({"_query": pa.array([], query_type), "_id": pa.array([], id_type), "_score": pa.array([], pa.float64())})
        held = held.take(pc.sort_indices(held.column("_id")))
        first = asked.column("_vector").combine_chunks()
        queries, block = (_matrix(c.column("_vector").combine_chunks(), len(first[0])) for c in (asked, held))
        q, row, found = _best_pairs(queries, block, metric, limit)
        return pa.table({"_query": asked.column("_query").take(pa.array(q)).cast(query_type),
                         "_id": held.column("_id").take(pa.array(row)).cast(id_type),
                         "_score": pa.array(found)})

    return run


def _best_pairs(queries: np.ndarray, block: np.ndarray, metric: str, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of queries and rows of the best ``limit`` rows for each query, and their scores; ties go to the first row.

    Each query has a floor, the least that its ``limit``-th best row so far scores, and only pairs that reach it are
    looked at. Cosines are looked through in single precision with twice the most that rounding can take, and pairs that
    may reach the floor are scored in double precision.
    """
    lengths = [np.linalg.norm(x, axis=1) for x in (queries, block)]
    screened = metric == "cosine" and all(((x == 0) | ((x > _SHORT) & (x < _LONG))).all() for x in lengths)
    margin, at_once = 0.0, max(1, _BLOCK_NUMBERS // max(1, queries.shape[1]))
    if screened:
        margin = (queries.shape[1] + 16) * 2.0 ** -23
        units = [np.divide(x, n[:, None], out=np.zeros_like(x), where=n[:, None] > 0).astype(np.float32)
                 for x, n in zip((queries, block), lengths)]

    def exact(q: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Cosines of pairs, each computed alike wherever its vectors stand."""
        out = np.zeros(len(q))
        for a in range(0, len(q), at_once):
            some, other = q[a:a + at_once], row[a:a + at_once]
            sizes = lengths[0][some] * lengths[1][other]
            np.divide(np.einsum("ij,ij->i", queries[some], block[other]), sizes, out=out[a:a + at_once], where=sizes > 0)
        return _rounded(out)

    best = []
    for start in range(0, len(queries), _QUERIES_AT_ONCE):
        stop = min(start + _QUERIES_AT_ONCE, len(queries))
        floor = np.full(stop - start, -np.inf)
        q, row, found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for first in range(0, len(block), _ROW_BLOCK):
            part = slice(first, first + _ROW_BLOCK)
            seen = units[0][start:stop] @ units[1][part].T if screened else _scores(block[part], queries[start:stop], metric)
            if first == 0 and seen.shape[1] >= limit:
                tops, fold = seen, seen.shape[1] // max(256, limit)
                if fold > 1:  # the best of each of many groups: of these, the last to count is no better than of all
                    width = seen.shape[1] // fold
                    tops = seen[:, :fold * width].reshape(len(seen), fold, width).max(axis=1)
                floor = np.partition(tops, -limit, axis=1)[:, -limit] - margin
            # The least single number may round up past the bound, so it is taken one step lower.
            bound = (floor - margin).astype(seen.dtype)
            if screened:
                bound = np.nextafter(bound, np.float32(-np.inf))
            at = np.flatnonzero(~(seen < bound[:, None]))  # numbers too large to compare stay in, and come last
            if not len(at):
                continue
            new_q, new_row = np.divmod(at, seen.shape[1])
            scores = exact(new_q + start, new_row + first) if screened else seen[new_q, new_row]
            q, row, found = (np.concatenate(x) for x in ((q, new_q), (row, new_row + first), (found, scores)))
            order = np.lexsort((row, -found, q))
            q, row, found = q[order], row[order], found[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, row, found, place = (x[place < limit] for x in (q, row, found, place))
            last = place == limit - 1
            floor[q[last]] = np.maximum(floor[q[last]], found[last])
        best.append((q + start, row, found))
    return tuple(np.concatenate(x) for x in zip(*best))


def embed(
    df: DataFrame, text_col: str, dim: int = 256, model: Callable[[list[str]], Sequence[Sequence[float]]] | None = None,
    output: str = "vector",
) -> DataFrame:
    """Text to vectors. ``model`` maps a list of whole texts to vectors and runs batch by batch in the tasks.

    Without a model: hashed word counts scaled to length one, all in the JVM.
    """
    if model is not None:
        @F.pandas_udf("array<double>")
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([list(map(float, v)) for v in model(texts.fillna("").tolist())])

        return df.withColumn(output, apply(F.col(text_col)))
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    counted = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_counts").transform(df.withColumn("_words", words))
    unit = Normalizer(inputCol="_counts", outputCol="_unit").transform(counted)
    return unit.withColumn(output, vector_to_array("_unit")).drop("_words", "_counts", "_unit")


def semantic_search(
    df: DataFrame, text_col: str, query: str, limit: int = 10, dim: int = 256, id_col: str = "id",
    payload: Sequence[str] = (), model: Callable[[list[str]], Sequence[Sequence[float]]] | None = None,
) -> DataFrame:
    """The documents nearest to a text, with their payload."""
    asked = df.sparkSession.range(1).select(F.lit(query).alias("q"))
    vector = embed(asked, "q", dim, model).first()["vector"]
    return search(embed(df, text_col, dim, model), vector, limit, "cosine", None, id_col, "vector", payload)
