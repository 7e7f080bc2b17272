"""The hash tree: the registered query against a plain version, what moves when weights change, and odd rows."""

import hashlib
import math
import zlib

import pyarrow.parquet as pq
import pytest

from docloom.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def plain_shard(doc_id, node):
    """Descend by comparing weighted draws."""
    key = "" if doc_id is None else str(doc_id)
    while not isinstance(node, tuple):
        score = {}
        for name, child in node.items():
            if w := sharding.weight(child):
                u = (int(hashlib.md5(f"{name}/{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                score[name] = -math.log(u) / w
        node = node[min(score, key=lambda n: (score[n], n))]
    return node[0]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string")


def test_query_equals_plain(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    df = queries.QUERIES["op12_hash_tree"](spark, SF)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(docs)
    for i, text in docs.items():
        raw, r = text.encode(), got[i]
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (plain_shard(i, queries.SHARDS), plain_shard(i, queries.GROWN))
        assert r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in got.values() if r.shard == s) == list(range(sum(r.shard == s for r in got.values())))


def test_no_python_on_the_main_path(spark):
    plan = queries.QUERIES["op12_hash_tree"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


TREE = {"a": {"a0": {"s0": (0, 1), "s1": (1, 3)}, "a1": {"s2": (2, 2)}}, "b": {"b0": {"s3": (3, 2), "s4": (4, 0)}}}


@pytest.mark.parametrize("weights", [{"s0": 5}, {"s2": 0}, {"s3": 6}, {"s4": 2}])
def test_movement_is_confined(spark, weights):
    """Only rows that enter a child that gained, or leave one that lost, move; others keep their place."""

    def change(node):
        return {n: (c[0], weights.get(n, c[1])) if isinstance(c, tuple) else change(c) for n, c in node.items()}

    def path(shard, node, so_far=()):
        for n, c in node.items():
            if isinstance(c, tuple) and c[0] == shard:
                return (*so_far, n)
            if not isinstance(c, tuple) and (found := path(shard, c, (*so_far, n))):
                return found
        return None

    after = change(TREE)
    up = sharding.weight(after) > sharding.weight(TREE)
    changed = set(path(next(TREE_leaf for TREE_leaf, name in ((c[0], n) for r in TREE.values() for k in r.values() for n, c in k.items()) if name in weights), TREE))
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    rows = sharding.place(sharding.place(df, "doc_id", TREE, "old"), "doc_id", after, "new").collect()
    moved = [(path(r.old, TREE), path(r.new, TREE)) for r in rows if r.old != r.new]
    assert moved
    for old, new in moved:
        fork = next(k for k, (x, y) in enumerate(zip(old, new)) if x != y)
        assert (new if up else old)[fork] in changed  # where the paths part, one side is the subtree that changed


def test_weights_are_met(spark):
    rows = sharding.place(spark.range(40_000).withColumnRenamed("id", "doc_id"), "doc_id", TREE, "shard").groupBy("shard").count().collect()
    share = {r.shard: r["count"] / 40_000 for r in rows}
    assert set(share) == {0, 1, 2, 3} and all(abs(share[s] - w / 8) < 0.01 for s, w in ((0, 1), (1, 3), (2, 2), (3, 2)))


def test_growth_takes_rows_only_into_the_new_shard(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    for n in (1, 3, 8, 9, 12):
        df = sharding.place(df, "doc_id", sharding.layout(n), f"of{n}")
    for a, b in ((8, 9), (9, 12)):
        moved = df.where(f"of{a} <> of{b}")
        assert moved.count() and moved.where(f"of{b} < {a}").count() == 0


def test_odd_rows(spark):
    """Null ids and texts, repeated rows dealt in pieces, clashing names, a long text, an empty table."""
    rows = [(None, None, "x")] * 3 + [(7, "a", "x")] * 50 + [(7, "b", None), (8, "", "y"), (9, "ä" * 500_000, "z"), (-1, "a", "z")]
    got = sharding.assign(frame(spark, rows), sharding.layout(8), range_rows=5, piece=7).collect()
    assert len(got) == len(rows) and all(r.grown_shard is None for r in got)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    for i in (None, 7, 8, 9, -1):
        assert {r.shard for r in got if r.doc_id == i} == {plain_shard(i, sharding.layout(8))}
    assert {(r.size, r.text_crc32) for r in got if r.doc_id is None} == {(1, 0)}
    assert [r.size for r in got if r.doc_id == 9] == [1_000_001]
    assert sharding.assign(frame(spark, []), sharding.layout(8)).count() == 0
    with pytest.raises(ValueError):
        sharding.place(frame(spark, []), "doc_id", {"a": {"s": (0, 0)}}, "shard")
