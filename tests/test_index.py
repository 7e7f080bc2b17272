"""The vector index: recall against exact neighbours, split lists, odd rows, and what is saved and added."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import points, store_queries, vector_index, vectors
from docloom.operators.vectors import nearest

SCHEMA = "vec_id long, embedding array<float>"


def recall(found, exact):
    want = {(r.query_id, r.vec_id) for r in exact.collect()}
    return sum((r.query_id, r.vec_id) in want for r in found.collect()) / len(want)


def test_recall_of_the_query(spark):
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        index = vector_index.build(store_queries.vectors(spark, sf))
        assert index.probes < len(index.centres)
        assert recall(store_queries.index_search(spark, sf), store_queries.QUERIES["vector_knn"](spark, sf)) >= 0.9


def clustered(seed=3, n=3000, dim=16, hot=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    of = np.where(rng.random(n) < hot, 0, rng.integers(0, 20, n))
    return centres[of] + 0.3 * rng.normal(size=(n, dim))


def test_hot_lists_are_split_and_all_lists_are_exact(spark):
    m = clustered()
    rows = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(m)], SCHEMA)
    index = vector_index.build(rows, lists=12, part_rows=100)
    sizes = index.blocks.select("list", "part", F.size("rows").alias("n")).collect()
    assert sum(r.n for r in sizes) == len(m) and max(r.n for r in sizes) < 200 and max(r.part for r in sizes) >= 3
    asked = rows.where("vec_id % 20 = 0")
    exact = nearest(asked, rows, 5)
    assert sorted(map(tuple, index.search(asked, 5, 12).collect())) == sorted(map(tuple, exact.collect()))
    assert recall(index.search(asked, 5), exact) >= 0.9
    assert recall(index.search(asked, 5, 1), exact) < 1


def test_saved_added_and_odd_rows(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (None, [0.0, 2.0]), (5, [-1.0, 0.5]), (6, [3.0, 0.1])] + [(k, [float(k), 1.0]) for k in range(10, 40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", list string")
    index = vector_index.build(df)
    held = sorted((r.vec_id or 0) for r in index.members().collect())
    assert held == sorted(r[0] or 0 for r in rows if r[1] and any(r[1]))
    index.save(str(tmp_path / "index"))
    again = vector_index.load(spark, str(tmp_path / "index"))
    asked = spark.createDataFrame([(99, [2.0, 0.0]), (98, [0.0, 0.0])], SCHEMA)
    n = len(again.centres)
    best = again.search(asked, 2, n).orderBy("place").collect()
    assert [(r.query_id, r.vec_id, r.distance) for r in best] == [(99, 1, 0.0), (99, 1, 0.0)]
    more = again.add(spark.createDataFrame([(70, [2.0, 0.0])], SCHEMA))
    assert more.members().count() == len(held) + 1
    assert {r.vec_id for r in more.search(asked, 3, n).collect()} == {1, 70}
    empty = vector_index.build(df.limit(0))
    assert empty.search(asked, 3).count() == 0 and empty.members().count() == 0


def test_fit_keeps_every_list_in_use():
    sample = vector_index._units(np.repeat(np.eye(4), 10, axis=0).tolist())
    centres = vector_index.fit(sample, 4)
    assert set((sample @ centres.T).argmax(axis=1)) == {0, 1, 2, 3}
    assert np.allclose(np.linalg.norm(centres, axis=1), 1)
    with pytest.raises(ValueError):
        vector_index.fit(sample, 41)


def test_blocks_of_many_pairs_ties_and_vectors_made_once(spark, monkeypatch):
    """A worker is sent few pairs of blocks at a time, a model is asked once for each text, and ties go by id."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "TILE", 64)
    sent, staged = [], vectors.Staged

    def seen(df, label, batch_rows=None):
        sent.append((label, batch_rows))
        return staged(df, label, batch_rows)

    monkeypatch.setattr(vectors, "Staged", seen)
    asked = spark.sparkContext.accumulator(0)

    def model(texts):
        asked.add(len(texts))
        return [[float(len(t) % 5), float(len(t) % 3), 1.0] for t in texts]

    rows = points.embed(spark.range(300).selectExpr("id as vec_id", "repeat('x', int(id)) as text"), "text", model).select("vec_id", "embedding")
    found = {(r.query_id, r.place): (r.vec_id, r.distance) for r in nearest(rows.where("vec_id % 20 = 0"), rows, 4).collect()}
    assert asked.value == 300 + 15
    assert ("nearest", vectors.BATCH_PAIRS) in sent
    m = np.array([[k % 5, k % 3, 1.0] for k in range(300)], float)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(0, 300, 20):
        best = sorted((float(np.round(1 - u[q] @ u[k], 6)) + 0.0, k) for k in range(300))[:4]
        assert [found[q, place] for place in range(1, 5)] == [(k, d) for d, k in best]


def test_the_fit_holds_no_large_matrix_and_draws_the_same_sample(spark):
    """The driver's memory is bounded by slices, and what is drawn by a cut of the hash is what the least hashes are."""
    import tracemalloc

    sample = vector_index._units(np.random.default_rng(1).normal(size=(8000, 16)))
    tracemalloc.start()
    centres = vector_index.fit(sample, 500, rounds=2)
    probes = vector_index.fit_probes(sample, centres, 5, 0.96)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 1 < probes < 500 and peak < 40e6
    rows = spark.createDataFrame([(k % 700 if k < 1000 else k, [float(k), 1.0]) for k in range(3000)], SCHEMA)
    n, drawn = vector_index._drawn(rows, 200, 11)
    least = rows.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(200).collect()
    assert n == 3000 and sorted(drawn[:, 0].tolist()) == sorted(r.embedding[0] for r in least)
    few = spark.createDataFrame([(1, [float(k), 1.0]) for k in range(100)], SCHEMA)
    assert len(vector_index._drawn(few, 50, 11)[1]) == 50


def test_no_block_of_vectors_is_broadcast(spark, monkeypatch):
    """Vectors written for each of their lists, or equal ones, are small in files, by which Spark judges what it may send through the driver."""
    plans, best = [], vectors.best_of_blocks

    def seen(paired, k):
        paired.collect()
        plans.append(paired._jdf.queryExecution().toString())
        return best(paired, k)

    monkeypatch.setattr(vector_index, "best_of_blocks", seen)
    monkeypatch.setattr(vectors, "best_of_blocks", seen)
    rows = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(clustered(n=800))], SCHEMA)
    asked = rows.where("vec_id % 20 = 0")
    near = vector_index.build(rows, lists=12).search(asked, 5, 6)
    exact = nearest(asked, rows, 5)
    assert len(plans) == 2 and recall(near, exact) > 0.6
    for plan in plans:
        lines = plan.partition("== Physical Plan ==")[2].splitlines()
        assert sum("SortMergeJoin" in x for x in lines) >= 1
        for i, line in enumerate(lines):
            if (at := line.find("BroadcastExchange")) >= 0:
                under = list(itertools.takewhile(lambda x: x[: at + 1].strip(" :+-") == "", lines[i + 1 :]))
                assert under and not any("collect_list" in x or "_rows#" in x for x in under)
