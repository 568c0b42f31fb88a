"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np

from strata.llm import neardup
from strata.llm.neardup_queries import op9_embedding_near_dedup
from tests.llm.test_jaccard import roots


def brute(rows):
    """(n_links, component_id) of each row by its place."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        x = x / np.abs(x).max()
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v in rows]
    near = [(i, j) for i, a in enumerate(units) for j, b in enumerate(units[:i])
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9]
    root = roots(range(len(rows)), near)
    degree = [sum(i in p for p in near) for i in range(len(rows))]
    least = {}
    for i, (name, _) in enumerate(rows):
        least[root[i]] = min(least.get(root[i], name), name)
    return sorted((rows[i][0], degree[i], least[root[i]]) for i in range(len(rows)))


def check(spark, rows, kind="float"):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, node int, vec string")
    got = neardup.deduplicate(frame.repartition(3)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_groups_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_BLOCK", 32)
    rng = np.random.default_rng(0)
    rows, n = [], 0
    for size in [120, 25, 9, 3, 2, 2] + [1] * 150:
        base = rng.normal(size=24)
        for _ in range(size):
            rows.append((n, (base + rng.normal(size=24) * 0.12).astype(np.float32).tolist()))
            n += 1
    rows += [(1000 + i, rows[0][1]) for i in range(80)]
    check(spark, rows)


def test_link_between_dense_groups(spark):
    rng = np.random.default_rng(1)
    u, v, w = np.linalg.qr(rng.normal(size=(24, 3)))[0].T

    def copies(centre, toward, bridge, first):
        """Two hundred copies near a centre, and one further towards the other group, linked with one there."""
        far = [centre * math.cos(bridge) + toward * math.sin(bridge)]
        return [(first + i, x.astype(np.float32).tolist())
                for i, x in enumerate(far + [centre + rng.normal(size=24) * 0.005 for _ in range(200)])]

    # Centres are 34 degrees apart, the two bridging vectors 25 degrees: the only link, at 0.906.
    other = u * math.cos(math.radians(34)) + v * math.sin(math.radians(34))
    back = (u - (u @ other) * other) / np.linalg.norm(u - (u @ other) * other)
    rows = copies(u, v, math.radians(4.5), 0) + copies(other, back, math.radians(4.5), 1000)
    rows += copies(w, u, math.radians(3), 2000)
    rows += [(5000 + i, x.astype(np.float32).tolist()) for i, x in enumerate(rng.normal(size=(150, 24)))]
    check(spark, rows)


def test_links_between_components(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_WIDE", 16)
    monkeypatch.setattr(neardup, "_BLOCK", 2)
    rng = np.random.default_rng(2)
    angle = np.concatenate([rng.uniform(a, b, n) for a, b, n in ((0, 4, 40), (28, 32, 12), (55, 58, 30), (100, 104, 50), (190, 191, 11))])
    root = np.repeat([0, 40, 52, 82, 132], [40, 12, 30, 50, 11])
    angle[[3, 45, 60, 90]] = [4, 28.5, 54, 104]  # 0-40 and 40-52 are linked, the others too far apart
    vecs = [[math.cos(math.radians(d)), math.sin(math.radians(d))] for d in angle]
    nodes = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "node long, vec array<double>")
    roots = spark.createDataFrame([(i, int(r)) for i, r in enumerate(root)], "node long, root long")
    got = neardup._links_between_components(nodes, roots).collect()
    assert all(np.dot(vecs[r.a], vecs[r.b]) >= 0.9 for r in got)
    assert {tuple(sorted((int(root[r.a]), int(root[r.b])))) for r in got} == {(0, 40), (40, 52)}


def test_audit_counts_nodes_and_not_links(spark):
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    vecs = [axes[0] + rng.normal(size=64) * 0.002 for _ in range(200)]
    vecs += [axes[1 + i // 2] + rng.normal(size=64) * 0.002 for i in range(100)]  # fifty pairs
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "node long, vec array<double>")
    hot = [(i, 0) for i in range(200)]
    pairs = [(200 + i, 200 + i // 2 * 2) for i in range(100)]
    kinds = "node long, root long"
    assert neardup.audit(nodes, spark.createDataFrame(hot + pairs, kinds)) == 1.0
    assert neardup.audit(nodes, spark.createDataFrame(hot, kinds)) == 0.0
    assert abs(neardup.audit(nodes, spark.createDataFrame(hot + pairs[:80], kinds)) - 0.8) < 1e-9


def test_search_that_fails_is_made_whole(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_WIDE", 16)
    monkeypatch.setattr(neardup, "MOST_ROUNDS", 3)
    monkeypatch.setattr(neardup, "audit", lambda nodes, roots: 0.5)
    grouped = neardup._grouped
    monkeypatch.setattr(neardup, "_grouped", lambda members: grouped(members).where("pmod(xxhash64(least(a, b), greatest(a, b)), 3) = 0"))
    rng = np.random.default_rng(4)
    rows = []
    for size in [20, 4, 3, 2, 2, 2] + [1] * 30:
        base = rng.normal(size=24)
        rows += [(len(rows) + i, (base + rng.normal(size=24) * 0.12).astype(np.float32).tolist()) for i in range(size)]
    check(spark, rows)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0]), (10, [1e300, 1e299]), (11, [1e-300, 0.0]), (12, [-1.0, 0.0])]
    check(spark, rows, "double")


def test_empty_table(spark):
    assert neardup.deduplicate(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_query_and_audit(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in op9_embedding_near_dedup(spark, sf).collect())
    assert got == brute(rows)
    nodes = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1)], "node long, vec array<double>, copies long")
    assert neardup.audit(nodes, spark.createDataFrame([], "node long, root long")) == 0.0
    assert neardup.audit(nodes, spark.createDataFrame([(1, 1), (2, 1)], "node long, root long")) == 1.0


def test_audit_has_evidence_where_links_are_rare(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(400, 16))
    vecs[399] = vecs[7] + 0.01
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "node long, vec array<double>")
    monkeypatch.setattr(neardup, "AUDITED", 8)
    assert neardup.audit(nodes, spark.createDataFrame([], "node long, root long")) == 0.0
    assert neardup.audit(nodes, spark.createDataFrame([(7, 7), (399, 7)], "node long, root long")) == 1.0
    assert neardup.audit(nodes.where("node < 399"), spark.createDataFrame([], "node long, root long")) == 1.0
