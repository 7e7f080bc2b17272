"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A tree has regions, regions have racks, racks have shards; any depth will do. A row descends from the root: at each
node it draws a number for each child by hashing its id with the child's name, divides the negative logarithm by the
child's weight (the sum of the weights below it) and enters the child with the least quotient. Shards so get rows by weight,
and nothing but the tree and the id decides. A child whose weight rises only wins rows, one whose weight falls only
loses rows, and no other child exchanges rows with a third one, so what moves is confined to subtrees whose weights change. A shard
that comes as a region of its own takes rows only into itself (``layout``).

Rows of a shard are numbered from 0, without gaps, in the order of a hash of the id. The numbers are made from counts of
ranges of that hash and from ranks within a range, so neither a shard nor an id with many rows is ever sorted in one task: rows that
agree in id, size and checksum are one row with a count until their numbers are dealt, in pieces, to many tasks.

Defined results: a null id is the empty text, all such rows go to one shard; a null text has size 1 and the checksum of no
bytes; rows of one id stay together, those that are equal in all output columns get numbers of their own; very long
texts are only measured and never shuffled; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import texts
from docloom.session import Staged

#: A node maps names to nodes; a leaf is (shard, weight).
Tree = Mapping[str, "Tree | tuple[int, int]"]
#: Hash ranges a shard at least, rows that a range should hold at most, and equal rows that are numbered in one go.
RANGES, RANGE_ROWS, PIECE = 64, 50_000, 50_000
_BITS = 52


def layout(shards: int, base: int = 8) -> Tree:
    """The tree of so many shards of weight 1: the first ``base`` in racks of two and regions of two racks, each later one
    as a region of its own, so that one more shard takes rows only into itself."""
    tree: dict[str, dict] = {}
    for s in range(min(shards, base)):
        tree.setdefault(f"region{s // 4}", {}).setdefault(f"rack{s // 2}", {})[f"shard{s}"] = (s, 1)
    for s in range(base, shards):
        tree[f"region_of_{s}"] = {f"rack_of_{s}": {f"shard{s}": (s, 1)}}
    return tree


def weight(node: Tree | tuple[int, int]) -> int:
    return node[1] if isinstance(node, tuple) else sum(weight(child) for child in node.values())


def _draw(key: Column, name: str) -> Column:
    """A number in (0, 1), of 52 bits, from an id and a child's name."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{name}/"), key).cast("binary")), 1, _BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << _BITS))


def _child(key: Column, node: Tree) -> Column:
    """The name of the child that a row enters; children of weight 0 get nothing."""
    open_to = {name: weight(child) for name, child in node.items() if weight(child) > 0}
    if len(open_to) == 1:
        return F.lit(next(iter(open_to)))
    draws = [F.struct((-F.ln(_draw(key, name)) / F.lit(float(w))).alias("score"), F.lit(name).alias("name")) for name, w in open_to.items()]
    return F.array_min(F.array(*draws))["name"]


def place(df: DataFrame, id_col: str, tree: Tree, out: str) -> DataFrame:
    """``df`` with the shard (int) of each row. Names must differ all over the tree. One projection a level, no shuffle."""
    if weight(tree) <= 0:
        raise ValueError("no shard has weight")
    key, at = F.coalesce(F.col(id_col).cast("string"), F.lit("")), "__at"
    df = df.withColumn(at, _child(key, tree))
    level = {name: child for name, child in tree.items() if weight(child) > 0}
    while any(not isinstance(child, tuple) for child in level.values()):
        chosen, below = F.col(at), {}
        for name, node in level.items():
            if isinstance(node, tuple):
                below[name] = node
            else:
                chosen = F.when(F.col(at) == name, _child(key, node)).otherwise(chosen)
                below |= {n: c for n, c in node.items() if weight(c) > 0}
        df, level = df.withColumn(at, chosen), below
    shard = F.create_map(*[F.lit(x) for name, leaf in level.items() for x in (name, leaf[0])])
    return df.withColumn(out, shard[F.col(at)].cast("int")).drop(at)


def assign(df: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS, piece: int = PIECE) -> DataFrame:
    """doc_id, size (bytes of the text plus 1), text_crc32, shard, slot (from 0 in each shard), grown_shard (the shard in
    the tree ``grown``, null without one)."""
    raw = F.col("text").cast("binary")
    rows = texts(df, id_col, text_col).select("doc_id", (F.octet_length("text") + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    counted = place(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "doc_id", tree, "shard")
    counted = place(counted, "doc_id", grown, "grown_shard") if grown else counted.withColumn("grown_shard", F.lit(None).cast("int"))
    order = F.md5(F.concat_ws("/", F.lit("slot"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32"))
    held = Staged(counted.withColumn("order", order), "shard-rows").df
    ranges = max(RANGES, -(-held.count() // range_rows))
    held = held.withColumn("part", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("int"))
    sums = held.groupBy("shard", "part").agg(F.sum("n").alias("in_part"))  # a row for each range of each shard
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = held.withColumn("rank", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["shard", "part"]).withColumn("first", F.col("start") + F.col("rank"))
    kept = ["doc_id", "size", "text_crc32", "shard", "grown_shard"]
    pieces = ranked.select(*kept, (F.col("first") + F.col("n")).alias("end"), F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1, F.lit(piece).cast("long"))).alias("from")).repartition("from", "shard")
    return pieces.select(*kept, F.explode(F.sequence(F.col("from"), F.least(F.col("from") + F.lit(piece), F.col("end")) - 1)).alias("slot"))
