"""The prefix trie: the registered query and small forests against a plain version, with stacks cut at every place."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docloom.llm import prefixtrie, queries

SF = "/root/testdata/sf0.001"


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), key, role, text))
    told = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = told.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def plain_nodes(built):
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = sum(saved[x] for x in children[path]) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(path))))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def share():
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6


def test_query_equals_plain(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    assert found(queries.QUERIES["op11_prefix_trie"](spark, SF)) == plain_nodes(plain_rebuilt(rows))


def test_rebuilt_with_odd_rows(spark):
    """Null turns, roles, texts and ids, absent heads, ties, repeated turns, a long text, a clashing column, negative ids."""
    rows = [(100, 1, "user", "b"), (100, None, "user", "a"), (100, 2, None, None), (100, 2, "bot", "x"), (101, 1, "u", "own"), (None, 1, "u", "lost"), (250, 3, "u", "y"), (251, 3, "u", "y"), (251, 3, "u", "y")]
    rows += [(105, k, "u", "long" * 50_000 if k == 3 else "é") for k in range(9)] + [(-7, 1, "u", "n"), (-100, 1, "u", "m")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, keys int")
    assert found(prefixtrie.nodes(prefixtrie.rebuilt(df, share()))) == plain_nodes(plain_rebuilt(rows))
    assert prefixtrie.nodes(prefixtrie.rebuilt(df.limit(0), share())).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_forests_cut_anywhere(spark, ranges):
    """Many equal, nested and empty arrays, and more ranges than arrays: each cut falls in open paths."""
    rng = random.Random(ranges)
    built = {k: [("r", "abcdefg"[: rng.choice([1, 1, 2, 3])]) for _ in range(rng.choice([0, 1, 2, 2, 5, 9]))] for k in range(90)}
    built |= {k: built[89] for k in range(90, 130)} | {k: [] for k in range(130, 160)} | {500: [("r", "zz")] * 300, 501: [("r", "zz")] * 299}
    rows = [(k, [hashlib.md5(t.encode()).digest() for _, t in x], [len(t) for _, t in x]) for k, x in built.items()]
    df = spark.createDataFrame(rows, "conv_id long, keys array<binary>, chars array<int>")
    assert found(prefixtrie.nodes(df, ranges=ranges)) == plain_nodes(built)
