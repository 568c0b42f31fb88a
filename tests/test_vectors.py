"""Vector search against brute force."""

from __future__ import annotations

import os

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from strata.operators import vector_index, vector_store, vectors
from strata.plans import QUERIES
from tests.conftest import rows


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(600, 16)).round(3)
    points[200:400] = points[5]          # a third of the collection is one vector
    points[400] = 0.0
    return points


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in v], f"p{i}") for i, v in enumerate(data)],
                                 "id long, vector array<double>, name string").repartition(5).cache()


def brute(data, query, metric, k):
    if metric == "euclid":
        score = -np.linalg.norm(data - query, axis=1)
    else:
        score = data @ query
        if metric == "cosine":
            norms = np.linalg.norm(data, axis=1) * np.linalg.norm(query)
            score = np.divide(score, norms, out=np.zeros_like(score), where=norms > 0)
    order = np.lexsort((np.arange(len(data)), -score.round(9)))[:k]
    return [(int(i), abs(round(float(score[i]), 6)) if metric == "euclid" else round(float(score[i]), 6)) for i in order]


@pytest.mark.parametrize("metric", ["Cosine", "dot", "EUCLID"])
@pytest.mark.parametrize("k", [1, 10, 1000])
def test_search(frame, data, metric, k):
    query = data[5] + 0.01
    got = vectors.search(frame, list(query), k, metric, payload=["name"]).collect()
    want = brute(data, query, metric.lower(), k)
    assert {r["id"] for r in got} == {i for i, _ in want}
    assert [round(r["score"], 6) for r in got] == pytest.approx([s for _, s in want], abs=2e-6)
    assert all(r["name"] == f"p{r['id']}" for r in got)


def test_threshold_and_errors(frame, data):
    query = list(data[7])
    near = vectors.search(frame, query, 1000, "cosine", threshold=0.3)
    assert near.count() == sum(1 for _, s in brute(data, data[7], "cosine", 1000) if s >= 0.3)
    close = vectors.search(frame, query, 1000, "euclid", threshold=4.0)
    assert close.count() == sum(1 for _, s in brute(data, data[7], "euclid", 1000) if s <= 4.0)
    with pytest.raises(ValueError):
        vectors.search(frame, query, metric="manhattan")
    with pytest.raises(Exception, match="dimensions"):
        vectors.search(frame, query[:3]).collect()


def test_search_ignores_missing_vectors_and_empty_tables(spark, frame, data):
    hole = frame.withColumn("vector", F.when(F.col("id") != 7, F.col("vector")))
    assert 7 not in {r["id"] for r in vectors.search(hole, list(data[7]), 600).collect()}
    assert vectors.search(frame.limit(0), list(data[7])).count() == 0


@pytest.mark.parametrize("metric,query_block,vector_block", [("cosine", 4096, 4096), ("euclid", 7, 100), ("dot", 1000, 33)])
def test_search_many_in_blocks(spark, frame, data, metric, query_block, vector_block):
    """However queries and vectors are cut, the answer is that of comparing all of them; ties go to the smaller id."""
    picked = [0, 5, 17, 399, 401] + list(range(410, 440))
    asked = [(f"q{i}", [float(x) for x in data[i] + 0.02]) for i in picked] + [("none", None), ("nan", [float("nan")] * len(data[0]))]
    queries = spark.createDataFrame(asked + asked[:3], "query_id string, vector array<double>")
    twice = frame.unionByName(frame.withColumn("id", F.col("id") + 100000))
    got = vectors.search_many(twice, queries, 4, metric, query_block=query_block, vector_block=vector_block).collect()
    assert len(got) == 4 * len(picked)
    for i in picked[:8]:
        mine = [m for _, m in sorted((r["rank"], r["match_id"]) for r in got if r["query_id"] == f"q{i}")]
        best = brute(np.concatenate([data, data]), data[i] + 0.02, metric, 4)
        assert mine == [m if m < len(data) else m - len(data) + 100000 for m, _ in best]
    assert vectors.search_many(frame, queries.limit(0), 4).count() == 0
    assert vectors.search_many(frame.limit(0), queries, 4).count() == 0
    assert vectors.search_many(frame, queries, 0).count() == 0


def test_batch_search_is_a_join_of_blocks(spark, frame):
    queries = frame.withColumnRenamed("id", "query_id")
    plan = vectors.search_many(frame, queries, 4)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # cut before the shuffle too


def test_upsert(spark):
    old = spark.createDataFrame([("a", [1.0, 0.0], "x"), ("b", [0.0, 1.0], "y")], "id string, vector array<double>, tag string")
    new = spark.createDataFrame([("b", [2.0, 2.0], "old", 1), ("b", [3.0, 3.0], "new", 2), (None, [5.0, 5.0], "gen", 1)],
                                "id string, vector array<double>, tag string, seq int")
    out = {r["tag"]: r for r in vectors.upsert(old, new, 2, ["seq"]).collect()}
    assert set(out) == {"x", "new", "gen"} and out["new"]["vector"] == [3.0, 3.0] and len(out["gen"]["id"]) == 32
    numbered = old.withColumn("id", F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="id is missing"):
        vectors.upsert(numbered, new.withColumn("id", F.lit(None).cast("bigint")), 2, ["seq"]).collect()
    with pytest.raises(Exception, match="expected 3 dimensions"):
        vectors.upsert(old, new, 3, ["seq"]).collect()


def test_collection_touches_only_its_directories(spark, tmp_path):
    path = str(tmp_path / "c")
    collection = vector_store.create(spark, path, "id string, vector array<float>, tag string", 2, "Euclid", 8)
    assert collection.read().count() == 0 and collection.upsert(collection.read()) == 0
    first = spark.createDataFrame([(f"k{i}", [float(i), 1.0], "old") for i in range(200)], "id string, vector array<float>, tag string")
    assert collection.upsert(first) == 8

    def files():
        return {os.path.join(d, f): os.path.basename(d) for d, _, fs in os.walk(f"{path}/rows") for f in fs if f.endswith(".parquet")}

    before = files()
    update = spark.createDataFrame([("k5", [0.0, 0.0], "a", 1), ("k5", [5.0, 1.5], "b", 2), (None, [9.0, 9.0], "made", 1)],
                                   "id string, vector array<float>, tag string, seq int")
    touched = vector_store.Collection(spark, path).upsert(update, ["seq"])
    after = files()
    kept = {f: d for f, d in before.items() if f in after}
    assert len(set(before.values()) - set(kept.values())) == touched <= 2 and len(set(kept.values())) == 8 - touched
    stored = vector_store.Collection(spark, path)
    assert (stored.dim, stored.metric, stored.buckets) == (2, "euclid", 8) and stored.read().count() == 201
    assert [(r.tag, r.vector) for r in stored.get(["k5"]).collect()] == [("b", [5.0, 1.5])]
    assert [r.id for r in stored.search([5.0, 1.5], 1, payload=["tag"], where=F.col("tag") != "made").collect()] == ["k5"]
    assert {r.tag: len(r.id) for r in stored.read().where("tag = 'made'").collect()} == {"made": 32}
    scan = stored.read([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan or "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        stored.search([1.0, 2.0, 3.0])
    with pytest.raises(Exception, match="expected 2 dimensions"):
        stored.upsert(spark.createDataFrame([("z", [1.0], "t")], first.schema))
    with pytest.raises(ValueError):
        vector_store.create(spark, str(tmp_path / "d"), "id string, v array<float>", 2)


@pytest.mark.parametrize("blocks", [None, (20, 5)])
def test_index_finds_nine_of_ten_and_probes_few(spark, tmp_path, monkeypatch, blocks):
    """Every twentieth vector against all of them."""
    if blocks:
        monkeypatch.setattr(vector_index, "LIST_BLOCK", blocks[0])
        monkeypatch.setattr(vector_index, "QUERY_BLOCK", blocks[1])
    collection = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    holes = collection.unionByName(collection.limit(3).withColumns({"vec_id": F.col("vec_id") + 10 ** 6, "embedding": F.lit(None)}))
    path = str(tmp_path / "index")
    vector_index.build(holes, path, id_col="vec_id", vector_col="embedding", payload=["label"])
    index = vector_index.Index(spark, path)
    assert index.model.probes <= 32 and index.lists.select("vec_id").distinct().count() == collection.count()
    asked = collection.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    exact = {(r.query_id, r.match_vec_id): r.score for r in vectors.search_many(
        collection, asked, 10, id_col="vec_id", vector_col="embedding").collect()}
    near = index.search_many(asked, 10).collect()
    assert len(near) == len(exact) and len({(r.query_id, r.match_vec_id) for r in near}) == len(near)
    found = [exact[r.query_id, r.match_vec_id] for r in near if (r.query_id, r.match_vec_id) in exact]
    assert len(found) >= 0.9 * len(exact)
    assert all(abs(exact.get((r.query_id, r.match_vec_id), r.score) - r.score) < 1e-9 for r in near)
    if not blocks:
        one = collection.where("vec_id = 20").first().embedding
        got = index.search(one, 10)
        assert [r.match_vec_id for r in got.collect()] == [r.match_vec_id for r in sorted(near, key=lambda r: r["rank"]) if r.query_id == 20]
        assert "list" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        with pytest.raises(ValueError):
            vector_index.build(collection, str(tmp_path / "no"), parts=7, id_col="vec_id", vector_col="embedding")


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "The cat sat"), (2, "the CAT sat!"), (3, "Ärger über Öl"), (4, ""), (5, None)], "id int, t string")
    out = {r["id"]: np.asarray(r["vector"]) for r in vectors.embed(df, "t", 64).collect()}
    assert np.allclose(out[1], out[2]) and all(len(v) == 64 for v in out.values())
    assert np.linalg.norm(out[1]) == pytest.approx(1.0) and np.linalg.norm(out[3]) == pytest.approx(1.0)
    assert not out[4].any() and not out[5].any()
    mine = vectors.embed(df, "t", model=lambda texts: [[len(t), 1.0] for t in texts])
    assert rows(mine, "id", "vector")[0] == (1, [11.0, 1.0])


def test_semantic_search(spark):
    df = spark.createDataFrame([(1, "red apples and pears"), (2, "fast cars on roads"), (3, "green apples")], "id int, t string")
    assert vectors.semantic_search(df, "t", "apples red", 2, payload=["t"]).first()["id"] == 1


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclid"])
def test_broken_vectors_do_not_push_out_good_ones(spark, metric):
    data = [(i, [float(i % 7), 1.0, float(i)]) for i in range(100)]
    broken = [(500, [float("nan"), 1.0, 1.0]), (501, [None, 1.0, 1.0]), (502, [float("inf"), 1.0, 1.0]), (503, None)]
    df = spark.createDataFrame(data + broken, "id long, vector array<double>").coalesce(1)
    good = df.filter("id < 500")
    for k in (1, 3, 10):
        got = [r.id for r in vectors.search(df, [1.0, 2.0, 3.0], k, metric).collect()]
        assert got == [r.id for r in vectors.search(good, [1.0, 2.0, 3.0], k, metric).collect()] and len(got) == k
    assert sorted(r.id for r in vectors.unusable(df).collect()) == [500, 501, 502, 503]
    with pytest.raises(ValueError):
        vectors.search(df, [float("nan"), 1.0, 1.0])


def murmur3(data: bytes) -> int:
    """The 32-bit hash by its published definition, seed 42, as a signed number."""
    h, mask = 42, 0xFFFFFFFF

    def scrambled(k: int) -> int:
        k = k * 0xCC9E2D51 & mask
        return (k << 15 | k >> 17) * 0x1B873593 & mask

    for i in range(0, len(data) - 3, 4):
        h ^= scrambled(int.from_bytes(data[i:i + 4], "little"))
        h = (h << 13 | h >> 19) * 5 + 0xE6546B64 & mask
    h ^= scrambled(int.from_bytes(data[len(data) // 4 * 4:], "little")) if len(data) % 4 else 0
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_embeddings_and_neighbours_of_documents_equal_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {}
    for i, text in texts.items():
        v = np.zeros(256)
        for w in regex.findall(r"[\p{L}\p{N}]+", (text or "").lower()):
            v[murmur3(w.encode()) % 256] += 1
        want[i] = v / (np.linalg.norm(v) or 1.0)
    got = {r.doc_id: np.asarray(r.vector) for r in QUERIES["embed_batch"](spark, sf).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)
    first = min(texts)
    best = sorted(((-round(float(want[first] @ v), 6), i) for i, v in want.items()))[:10]
    near = QUERIES["semantic_search"](spark, sf).collect()
    assert [(-r.score, r.doc_id) for r in near] == best


@pytest.mark.parametrize("metric", vectors.METRICS)
def test_batch_search_looks_closely_at_few_pairs(metric, monkeypatch):
    """Pairs below a query's floor are neither sorted nor, for cosines, scored in double precision; results stay exact."""
    rng = np.random.default_rng(5)
    block = rng.normal(size=(3000, 16)) * rng.choice([1e-30, 1.0, 1e20] if metric == "cosine" else [1.0], size=(3000, 1))
    block[100:130], block[2000] = block[7], 0.0
    queries = np.concatenate([block[::10], np.zeros((1, 16))])
    looked, sort = [], np.lexsort
    monkeypatch.setattr(vectors, "_ROW_BLOCK", 512)
    monkeypatch.setattr(np, "lexsort", lambda keys: looked.append(len(keys[0])) or sort(keys))
    monkeypatch.setattr(np, "argsort", None)
    q, row, score = vectors._best_pairs(queries, block, metric, 5)
    monkeypatch.undo()
    assert sum(looked) < 0.1 * len(queries) * len(block)
    whole = vectors._scores(block, queries, metric)
    at = np.argsort(-whole, axis=1, kind="stable")[:, :5]
    assert q.tolist() == np.repeat(np.arange(len(queries)), 5).tolist()
    assert np.allclose(score.reshape(-1, 5), np.take_along_axis(whole, at, axis=1), rtol=1e-9, atol=1e-12)
    if metric == "cosine":
        assert row.reshape(-1, 5).tolist() == at.tolist()


def test_batch_search_blocks_grow_with_the_tables(spark, frame, data, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_BLOCK", 10)
    monkeypatch.setattr(vectors, "_BLOCKS", 3)
    queries = frame.withColumnRenamed("id", "query_id").withColumn("vector", F.col("vector").cast("array<float>"))
    found = vectors.search_many(frame, queries, 4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    dealt = regex.findall(r"pmod\(xxhash64\([^)]*\), (\d+)\)", plan)
    assert dealt == ["3", "3"], plan
    near = {(r.query_id, r["rank"]): r.match_id for r in found.collect()}
    for i in range(410, 430):
        assert [near[i, k] for k in (1, 2, 3, 4)] == [m for m, _ in brute(data, data[i].astype(np.float32), "cosine", 4)]
