"""The embedder, ranked sentences, rare terms and graphs of nodes against plain versions."""

import json
import math
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from docloom.operators import embedder, relations, sentences, text_queries, vector_index
from docloom.operators.vectors import nearest
from docloom.sources import node_graph

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def test_near_copies_are_nearest(spark, texts, tmp_path):
    """Every document with a twentieth of its words changed, and near copies among the documents themselves, are found in nine of ten cases."""
    rng = random.Random(4)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = embedder.fit(docs, "text")
    model.save(spark, str(tmp_path / "model"))
    again = embedder.load(spark, str(tmp_path / "model"))
    assert again(["two words"]) == model(["two words"]) and model([None, " "]) == [[0.0] * embedder.DIM] * 2
    long = {i: t for i, t in texts.items() if len(t.split()) >= 20}
    changed = {i: " ".join("swapped" if rng.random() < 0.05 else w for w in t.split()) for i, t in long.items()}
    vectors = dict(zip(texts, model(list(texts.values()))))
    rows = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    asked = spark.createDataFrame(list(zip(changed, model(list(changed.values())))), "vec_id long, embedding array<float>")
    found = {r.query_id: r.vec_id for r in vector_index.build(rows).search(asked, 1).collect()}
    same = lambda a, b: texts[a] == texts[b] or len(shingles(texts[a]) & shingles(texts[b])) >= 0.8 * len(shingles(texts[a]) | shingles(texts[b]))
    assert sum(same(i, found[i]) for i in changed) >= 0.9 * len(changed)
    ids = sorted(long)
    twins = {a: b for a in ids for b in ids if a != b and texts[a] != texts[b] and same(a, b)}
    two = {}
    for r in nearest(rows, rows, 6).collect():
        two.setdefault(r.query_id, []).append(r.vec_id)
    assert twins and sum(any(x != a and same(a, x) for x in two[a]) for a in twins) >= 0.9 * len(twins)


def shingles(text, n=5):
    words = text.split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))}


def test_query_of_passages(spark):
    got = text_queries.text_neighbours(spark, SF).collect()
    items = {r["item_id"]: r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    assert {r.query_id for r in got} == set(items) and all(r.place <= 5 for r in got)


def plain_points(text):
    """The same weights by a dense matrix."""
    found = sentences.split(text)
    if not found:
        return []
    held = [set(re.findall(r"\w{4,}", s.lower())) for s in found]
    words = sorted(set().union(*held))
    m = np.array([[w in h for w in words] for h in held], float).reshape(len(held), len(words))
    step = (m / np.maximum(1, m.sum(1, keepdims=True))) @ (m / np.maximum(1, m.sum(0))).T if words else np.zeros((len(held), len(held)))
    x = np.full(len(held), 1 / len(held))
    for _ in range(sentences.STEPS):
        x = (1 - sentences.DAMPING) / len(held) + sentences.DAMPING * (x @ step)
    n = min(len(found), max(3, min(5, math.ceil(len(found) / 10))))
    best = sorted(range(len(found)), key=lambda k: (-round(x[k], 12), k))[:n]
    return [found[k] for k in sorted(best)]


def test_ranked_sentences(spark, texts):
    got = {r.doc_id: r for r in text_queries.ranked_summaries(spark, SF).collect()}
    for i, text in texts.items():
        want = plain_points(text)
        assert (got[i].summary, got[i].n_points) == ("|".join(want), len(want)), i
    assert sentences.ranked(None) == sentences.ranked(" \n ") == [] and sentences.ranked("One only") == ["One only"]
    hub = "Alpha betas gammas. Unrelated thing here. Alpha delta. Betas delta. Gammas delta. Other words entirely."
    assert "Alpha betas gammas." in sentences.ranked(hub) and len(sentences.ranked(hub)) == 3
    assert sentences.ranked("Same words. " * 5 + "Then more.") == ["Same words.", "Then more."]
    assert 3 <= len(sentences.ranked(". ".join(f"word{k} shared" for k in range(5000)))) <= 5


def test_relations_with_odd_rows(spark):
    rows = [(1, "Kestrel falcon common"), (2, "the KESTREL common again"), (3, None), (4, "kestrel common"), (5, "falcon falcon éclair common"), (6, "éclair falcon common")] + [(k, "common") for k in range(10, 30)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, text string, n int")
    rare = relations.rare_terms(df, "id", "text")
    assert sorted({r.term for r in rare.collect()}) == ["falcon", "kestrel", "éclair"]  # 'common' is in too many, 'again' in one
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (5, 6), (6, None), (10, 11)], "from_id long, to_id long")
    got = sorted(map(tuple, relations.related(pairs, rare).collect()))
    assert got == [(1, 2, 1, "kestrel"), (5, 6, 2, "éclair, falcon")]
    assert relations.related(pairs, relations.rare_terms(df.limit(0), "id", "text")).count() == 0


def test_node_graphs(spark, tmp_path):
    whole = {"directed": True, "nodes": [{"id": "a", "type": "class", "embedding": [1, 0.5], "more": {"deep": [1, {"x": 2}]}}, {"name": "no id"}, {"id": 7}], "links": [{"source": "a", "target": 7, "kind": "calls"}, {"source": "a"}]}
    (tmp_path / "g.json").write_text(json.dumps(whole, indent=2))
    graph = node_graph.load(spark, str(tmp_path / "g.json"))
    nodes = {r.entity_id: r for r in graph.nodes.selectExpr("entity_id", "type", "embedding", "try_variant_get(attributes, '$.more.deep[1].x', 'int') AS deep").collect()}
    assert nodes["a"].type == "class" and nodes["a"].embedding == [1.0, 0.5] and nodes["a"].deep == 2 and nodes["7"].embedding is None and len(nodes) == 2
    assert [(r.source, r.target) for r in graph.edges.collect()] == [("a", "7")]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.json").write_text('{"id": "a"}\nbroken\n{"source": "a", "target": "b"}\n')
    lines = node_graph.load(spark, str(tmp_path / "lines"), lines=True)
    assert (lines.nodes.count(), lines.edges.count()) == (1, 1)
    (tmp_path / "bad.json").write_text("{")
    assert node_graph.load(spark, str(tmp_path / "bad.json")) is None and node_graph.load(spark, str(tmp_path / "none.json")) is None


def test_texts_near_to_others_are_embedded_once(spark, monkeypatch):
    """Each text is turned into a vector once, and its buckets are those of hashlib's digests."""
    import hashlib

    from docloom.operators import embedder, vectors
    from docloom.operators.text_queries import embedded

    grams = ["ab", "ab", "c", "ab ab", "ab c"]
    plain = {}
    for g in grams:
        at = int(hashlib.md5(g.encode()).hexdigest()[:5], 16) % embedder.BUCKETS
        plain[at] = plain.get(at, 0) + 1
    assert embedder.buckets("AB ab c") == plain and embedder.buckets("") == {}
    sf, calls = "/root/testdata/sf0.001", spark.sparkContext.accumulator(0)

    def model(texts):
        calls.add(len(texts))
        return [[1.0, float(len(t))] for t in texts]

    near = vectors.nearest(embedded(spark, sf, model, "benchmark", "item_id"), embedded(spark, sf, model, "documents", "doc_id"), 2)
    assert near.count() == 2 * spark.read.parquet(f"{sf}/benchmark.parquet").count()
    assert calls.value == sum(spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("benchmark", "documents"))
