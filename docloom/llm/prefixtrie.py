"""Prefix trie of conversations, from globally sorted turn arrays.

Every conversation becomes the array of its turns, a digest of 16 bytes and a length each; texts are not shuffled. The
arrays are sorted over all partitions by range. In a partition one pass compares each array with the one before it: the
length of their common prefix (LCP) tells which nodes end and which begin, and a stack holds those that are open. A node is the
interval of arrays between the two; it is closed, with its sums over its subtree, when the LCP falls below its depth.

Nodes on the path of a partition's first or last array may go on in the next partitions. They leave the pass as open stacks,
one row a depth, and are stitched in the order of the partitions by a second pass of the same kind, which sees only such rows:
two paths a partition, however many conversations there are. Children whose parent was open get its id by a join on partition and
depth, so that the root is no hot key.

A range holds about ``RANGE_TURNS`` turns, which bounds what a task keeps. Equal arrays are told apart by their id and so fall into
several ranges; their ids then pass the stitching as one piece of text a range, as SHA-256 has to read them in order.

Defined results: null roles and texts are empty; turns with the same number follow each other by digest; rows without
conversation id belong to none and are left out; long texts are hashed where they stand; repeated rows are turns of their
own; an empty table has no nodes; other columns are not looked at. A conversation is one row of about 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.llm.common import record_batch
from docloom.session import Staged

RANGE_TURNS = 200_000
_NODE = "depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: ``place`` is twice the partition, plus 1 on the path of its last array; ``open`` nodes reach the partition's end. ``key`` and ``chars`` are of
#: a node's last turn, ``ends`` lists ids whose text may go on in the next partition. ``up`` is the parent's place, null if its id is known.
_SWEPT = f"{_NODE}, parent_conv_id long, up int, place int, open boolean, key binary, chars long, ends binary"
_STITCHED = f"{_NODE}, up int, places array<int>"
_NO_ENDS = hashlib.sha256().hexdigest()
_FLUSH = 20_000
#: Rows of open stacks in a batch: those of a range's own ends carry the ids of up to a range.
_PATH_ROWS = 512


def rebuilt(df: DataFrame, share: Column, group: int = 100, most: int = 5) -> DataFrame:
    """(conv_id, keys array<binary>, chars array<int>) of each conversation c: the first ``share`` turns (at most ``most``) of conversation
    c - c % group (the remainder has the sign of c), then its own after as many. One shuffle, by that group, of digests only."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    conv = F.col("conv_id").cast("long")
    turns = df.where(conv.isNotNull()).select(conv.alias("conv_id"), (conv - conv % group).alias("head"), F.struct(F.col("turn"), key.alias("key"), F.length(text).alias("chars")).alias("t"))
    own = turns.repartition("head").groupBy("head", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    first = F.first(F.when(F.col("conv_id") == F.col("head"), F.slice("own", 1, most)), ignorenulls=True)
    both = own.withColumn("lead", first.over(Window.partitionBy("head"))).withColumn("h", F.least(share, F.lit(most)).cast("int"))
    lead = F.coalesce(F.slice("lead", F.lit(1), F.col("h")), F.slice("own", 1, 0))
    both = both.select("conv_id", F.concat(lead, F.slice("own", F.col("h") + 1, F.size("own"))).alias("turns"))
    return both.select("conv_id", F.transform("turns", lambda t: t["key"]).alias("keys"), F.transform("turns", lambda t: t["chars"]).alias("chars"))


class _Open:
    """A node on the stack. ``n_leaves`` and ``saved`` sum over closed children."""

    __slots__ = ("depth", "key", "chars", "start", "first", "low", "n", "n_children", "n_leaves", "saved", "ids", "digest", "rows", "places", "sha")

    def __init__(self, depth: int, key: bytes, chars: int, start: int = 0, first: bool = False):
        self.depth, self.key, self.chars, self.start, self.first = depth, key, chars, start, first
        self.low, self.n, self.n_children, self.n_leaves, self.saved = 1 << 63, 0, 0, 0, 0
        self.ids: list[int] = []
        self.digest, self.rows, self.places, self.sha = None, [], [], None

    def close(self, parent: _Open | None) -> dict:
        """The finished node; its sums go to the parent."""
        leaves, saved = self.n_leaves if self.n_children else 1, self.saved + (self.n - 1) * self.chars
        if parent is not None:
            parent.n_children, parent.n_leaves, parent.saved = parent.n_children + 1, parent.n_leaves + leaves, parent.saved + saved
        return {"depth": self.depth, "conv_id": self.low, "n_convs": self.n, "n_children": self.n_children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": self.digest or _NO_ENDS}


def _joined(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def _sweep(arrays: Iterator[tuple[int, list[bytes], list[int]]], part: int) -> Iterator[dict]:
    """Rows of ``_SWEPT`` from (conv_id, keys, chars) in the order of keys and id."""
    stack: list[_Open] = []
    before: list[bytes] | None = None
    length = at = 0  # of the first array; the place of the next one

    def leave(node: _Open, is_open: bool, ends: list[int]) -> dict:
        """A node of the first or the last path, as far as this partition knows it."""
        own = {"depth": node.depth, "conv_id": node.low, "n_convs": node.n, "n_children": node.n_children, "n_leaves": node.n_leaves, "saved_tokens": node.saved, "ends_sha256": node.digest}
        return own | {"place": 2 * part + (not node.first), "open": is_open, "key": node.key, "chars": node.chars, "ends": _joined(ends) if ends else None}

    def pop() -> Iterator[dict]:
        node = stack.pop()
        parent = stack[-1] if stack else None
        node.n = at - node.start
        if parent is not None:
            parent.low = min(parent.low, node.low)
        if node.first:
            yield leave(node, False, node.ids)
            return
        yield from (row | {"parent_conv_id": node.low} for row in node.rows)
        row = node.close(parent)
        if parent.first:
            yield row | {"up": 2 * part}
        else:
            parent.rows.append(row)

    for conv, keys, chars in arrays:
        if before is None:
            stack, length, shared = [_Open(0, b"", 0, 0, True)], len(keys), 0
        elif keys == before:
            shared = len(keys)
        else:
            shared, most = 0, min(len(keys), len(before))
            while shared < most and keys[shared] == before[shared]:
                shared += 1
            top = stack[-1]  # the ids that end there are complete
            if top.ids and not (top.first and top.depth == length):
                top.digest, top.ids = hashlib.sha256(_joined(top.ids)).hexdigest(), []
            while len(stack) > shared + 1:
                yield from pop()
        for depth in range(len(stack), len(keys) + 1):
            stack.append(_Open(depth, keys[depth - 1], chars[depth - 1], at, before is None))
        stack[-1].ids.append(conv)
        stack[-1].low = min(stack[-1].low, conv)
        before, at = keys, at + 1
    while stack:  # these reach the end
        node = stack.pop()
        node.n = at - node.start
        if stack:
            stack[-1].low = min(stack[-1].low, node.low)
        yield from (row | {"up": 2 * part + 1} for row in node.rows)
        yield leave(node, True, node.ids)


def _stitch(rows: Iterator[dict]) -> Iterator[dict]:
    """Rows of ``_STITCHED`` from rows of first and last paths in the order of place and depth."""
    stack: list[_Open] = []

    def pop() -> dict:
        node = stack.pop()
        parent = stack[-1] if stack else None
        if node.sha is not None:
            node.digest = node.sha.hexdigest()
        return node.close(parent) | {"up": parent.places[0] if parent else None, "places": node.places}

    def add(node: _Open, row: dict) -> None:
        node.low, node.n = min(node.low, row["conv_id"]), node.n + row["n_convs"]
        node.n_children, node.n_leaves, node.saved = node.n_children + row["n_children"], node.n_leaves + row["n_leaves"], node.saved + row["saved_tokens"]
        node.digest = row["ends_sha256"] or node.digest
        node.places.append(row["place"])
        if row["ends"] is not None:
            if node.sha is None:
                node.sha = hashlib.sha256()
            else:
                node.sha.update(b",")
            node.sha.update(row["ends"])

    def push(row: dict) -> None:
        stack.append(_Open(row["depth"], row["key"], row["chars"]))
        add(stack[-1], row)

    for place, path in groupby(rows, key=lambda r: r["place"]):
        if place % 2:
            for row in path:
                push(row)
            continue
        path = list(path)
        shared = 0  # nodes that go on from the partitions before
        while shared < min(len(stack), len(path)) and stack[shared].key == path[shared]["key"]:
            shared += 1
        while len(stack) > shared:
            yield pop()
        for node, row in zip(stack, path):
            add(node, row)
        for row in path[shared:]:
            push(row)
        reach = sum(row["open"] for row in path)
        while len(stack) > reach:
            yield pop()
    while stack:
        yield pop()


def _batches(rows: Iterator[dict], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + len(row.get("ends") or b"") // 256
        if size >= _FLUSH:
            yield record_batch({f.name: [r.get(f.name) for r in held] for f in arrow}, arrow)
            held, size = [], 0
    yield record_batch({f.name: [r.get(f.name) for r in held] for f in arrow}, arrow)


def _swept(ordered: DataFrame) -> DataFrame:
    arrow = to_arrow_schema(StructType.fromDDL(_SWEPT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "keys", "chars"))))
        yield from _batches(_sweep(arrays, TaskContext.get().partitionId()), arrow)

    return ordered.mapInArrow(run, _SWEPT)


def _stitched(ordered: DataFrame) -> DataFrame:
    arrow = to_arrow_schema(StructType.fromDDL(_STITCHED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_stitch(row for b in batches for row in b.to_pylist()), arrow)

    return ordered.mapInArrow(run, _STITCHED)


def nodes(arrays: DataFrame, range_turns: int = RANGE_TURNS, ranges: int | None = None) -> DataFrame:
    """The trie of (conv_id, keys, chars), one row a node: conv_id (the least member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Each id comes once."""
    spark = arrays.sparkSession
    held = Staged(arrays, "trie-arrays")
    turns = held.df.agg(F.coalesce(F.sum(F.size("keys") + 1), F.lit(0))).first()[0]
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // range_turns))
    ordered = held.df.repartitionByRange(ranges, "keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    swept = Staged(_swept(ordered), "trie-swept")
    held.drop()
    paths = swept.df.where("place is not null").select("place", "depth", "open", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "chars", "ends")
    stitched = Staged(_stitched(paths.repartition(1).sortWithinPartitions("place", "depth")), "trie-paths", _PATH_ROWS).df
    own = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ids = stitched.select(F.explode("places").alias("up"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up_conv_id"))
    closed = swept.df.where("place is null")
    known = closed.where("up is null").select(*own, "parent_conv_id")
    waiting = closed.where("up is not null").select(*own, "up").unionByName(stitched.select(*own, "up")).join(ids, ["up", "depth"], "left")
    out = known.unionByName(waiting.select(*own, F.col("up_conv_id").alias("parent_conv_id")))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
