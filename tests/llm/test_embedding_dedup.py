from __future__ import annotations

import math

import numpy as np

from wakeline.llm import embedding_dedup, queries

SCHEMA = "vec_id long, embedding array<float>, label int, size int, copies string"


def brute(rows, least=0.98):
    """Links and components by comparing all vectors of a label."""
    links, parent = {i: set() for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_label = {}
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = np.array(v, dtype=np.float64)
        if x.any():
            by_label.setdefault(label, []).append((i, x / np.linalg.norm(x)))
    for own in by_label.values():
        ids, x = [i for i, _ in own], np.array([x for _, x in own])
        for a, b in zip(*np.nonzero(x @ x.T >= least)):
            if a != b:
                links[ids[a]].add(ids[b])
                p, q = sorted((root(ids[a]), root(ids[b])))
                parent[q] = p
    return links, {i: root(i) for i in parent}


def check(found, rows, recall):
    found = {r["vec_id"]: r for r in found}
    links, component = brute(rows)
    assert set(found) == set(links)
    assert all(found[i]["n_links"] <= len(links[i]) for i in links)
    total = sum(map(len, links.values()))
    assert sum(r["n_links"] for r in found.values()) >= recall * total
    assert np.mean([found[i]["component_id"] == component[i] for i in links]) >= recall
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())
    return total


def test_query(spark):
    path = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table]
    check(queries.QUERIES["op9_vector_forest"](spark, path).collect(), rows, 1.0)


def test_recall_of_vectors_just_close_enough(spark):
    """Copies of the vectors at cosines from 0.98 up, in labels of very different sizes."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rng, rows = np.random.default_rng(2), []
    for r in table:
        v = np.array(r["embedding"], dtype=np.float64)
        label = 0 if r["vec_id"] % 3 else int(r["label"])
        rows.append((r["vec_id"], v.tolist(), label))
        if r["vec_id"] % 2:
            noise = rng.standard_normal(len(v))
            noise *= rng.uniform(0.05, 0.2) * np.linalg.norm(v) / np.linalg.norm(noise)
            rows.append((10**6 + r["vec_id"], (v + noise).astype(np.float32).tolist(), label))
    total = check(embedding_dedup.near_vectors(frame(spark, rows)).collect(), rows, 0.95)
    assert total > 1000


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA).repartition(3)


def test_deep_trees_and_large_leaves(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF_MOST", 16)
    monkeypatch.setattr(embedding_dedup, "FITTED", 2)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 16))
    rows = []
    for i in range(600):
        v = base[i % 60] + 0.02 * rng.standard_normal(16)
        rows.append((i, v.astype(np.float32).tolist(), i % 2))
    found = {r["vec_id"]: r for r in embedding_dedup.near_vectors(frame(spark, rows)).collect()}
    links, _ = brute(rows)
    total = sum(map(len, links.values()))
    assert sum(r["n_links"] for r in found.values()) >= 0.9 * total
    assert all(found[i]["n_links"] <= len(links[i]) for i in links)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2.0, 0.01], 0), (4, [1.0, 0.0], 1),
        (5, None, 0), (6, [0.0, 0.0], 0), (7, [1.0, None], 0), (8, [1.0, nan], 0),
        (9, [inf, 1.0], 0), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 0), (12, [], 0),
        (13, [-1.0, 0.0], 0), (None, [1.0, 0.0], 0),
    ]
    found = embedding_dedup.near_vectors(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    linked = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert linked[1] == (2, 1, True) and linked[2] == (2, 1, False) and linked[3] == (2, 1, False)
    for i in range(4, 14):
        assert linked[i] == (0, i, True)
    assert linked[None] == (0, None, True)
    twice = embedding_dedup.near_vectors(frame(spark, rows[:1] * 2)).collect()
    assert [(r["n_links"], r["component_id"]) for r in twice] == [(1, 1)] * 2
    assert embedding_dedup.near_vectors(frame(spark, [])).count() == 0
    assert embedding_dedup.near_vectors(frame(spark, rows[4:6])).count() == 2
