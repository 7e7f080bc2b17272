"""Spelling variants: words within one edit of each other, by merging light subtrees of a trie, and the form each word goes back to.

Words are counted in Spark. Those that matter are sorted over all partitions by range; the words of a range are one part of the trie.
At each node of the trie the child with the most words is heavy, the others and a word that ends there are light, so a word leaves
the heavy path at most log2(words) times. Two words that differ by one edit part at one node, and one of the two is light there.
So at each node the light subtrees are merged into the heavy one with one character changed: with the light child's character replaced
by the heavy one's (merged into the heavy child), with it skipped (merged into the node), and with the heavy one's put before it; among themselves
the light ones are merged with it replaced by a blank. Terminals that coincide are pairs, each found once.

Nodes all of whose words are in one range are merged there. Nodes on the path of a range's first or last word may have words elsewhere: their
children are counted in Spark, so that every range takes the same child for the heavy one, and terminals whose place is in
another range are looked up by a join. Only two paths a range are of that kind. A range holds about ``RANGE_CHARS`` characters.

Defined results: a null text has no words, a null id is the empty text; texts and words of any length are taken whole; rows of one id are counted
each; ties of a count go to the smallest word; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.llm.common import record_batch, texts
from docloom.session import Staged

MIN_CHARS, MIN_COUNT, TIMES = 7, 2, 10
#: Of so many runs one loses a character: fixed by the query's contract.
SPOILT = 31
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Words that a task counts before it hands them on; characters in a range; rows for the join that a range holds before they go to Arrow.
HELD, RANGE_CHARS, SENT = 200_000, 2_000_000, 20_000
_PATHS = "word string, n long, part int, node binary, side int, depth int, child string, size long"
#: ``cnt`` near words, the best of them as (minus its count, itself); or a terminal to be found elsewhere (``key``), or to be merged with others (``blank``).
_FOUND = "word string, n long, cnt long, neg long, near string, key string, blank string"


def spoilt(doc_id: str, run: str, start: int | None = None) -> str:
    """The run as it is counted: a checksum of the id and the run says whether a character is missing, and which."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()) if start is None else start)
    return run if h % SPOILT else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = HELD) -> DataFrame:
    """(word, n) of all words of at least ``MIN_CHARS`` characters that occur at least ``MIN_COUNT`` times."""
    schema = "word string, n long"
    arrow, runs = to_arrow_schema(StructType.fromDDL(schema)), re.compile(f"{LETTERS}{{{MIN_CHARS},}}")

    def out(counts: Counter) -> pa.RecordBatch:
        return record_batch({"word": list(counts), "n": list(counts.values())}, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                lowered = text.as_py().encode().lower().decode()  # of bytes: A to Z only
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall(lowered)).items():
                    word = spoilt("", word, start)
                    if len(word) >= MIN_CHARS:
                        counts[word] += n
                if len(counts) >= held:
                    yield out(counts)
                    counts = Counter()
        yield out(counts)

    found = texts(df, id_col, text_col).mapInArrow(run, schema)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _shared(a: str, b: str) -> int:
    """The length of the common prefix."""
    n, k = min(len(a), len(b)), 0
    while k + 64 <= n and a[k : k + 64] == b[k : k + 64]:
        k += 64
    while k < n and a[k] == b[k]:
        k += 1
    return k


def _with_neighbours(words: list[str]) -> tuple[list[int], list[int], list[int]]:
    """Of sorted words: the prefix shared with the one before, with the first and with the last."""
    lcp = [0, *(_shared(a, b) for a, b in zip(words, words[1:]))]
    first, last = [len(words[0])] * len(words), [len(words[-1])] * len(words)
    for i in range(1, len(words)):
        first[i] = min(first[i - 1], lcp[i])
    for i in range(len(words) - 2, -1, -1):
        last[i] = min(last[i + 1], lcp[i + 1])
    return lcp, first, last


def _path(words: list[str], reach: list[int], path: str, least: int) -> Iterator[tuple[bytes, int, str, int]]:
    """(name, depth, child, words of it) of the nodes on a path from depth ``least`` on; ``reach`` is how far each word goes along."""
    sizes: dict[int, Counter] = defaultdict(Counter)
    ends = Counter(reach)
    for word, depth in zip(words, reach):
        if least <= depth < len(word):
            sizes[depth][word[depth]] += 1
    further, name = sum(n for depth, n in ends.items() if depth >= least), hashlib.md5(path[:least].encode())
    for depth in range(least, len(path) + 1):
        further -= ends[depth]
        if depth < len(path) and further:
            sizes[depth][path[depth]] += further
        yield from ((name.digest(), depth, child, size) for child, size in (sizes[depth] or {None: 0}).items())  # a word may end there, and have its children in the next range
        name.update(path[depth : depth + 1].encode())


def _with_paths(ordered: DataFrame) -> DataFrame:
    """A range's words, and the children of the nodes on the paths of its first (side 0) and last word (side 1)."""
    arrow = to_arrow_schema(StructType.fromDDL(_PATHS))
    made = lambda n, columns: record_batch({f.name: columns.get(f.name, [None] * n) for f in arrow}, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = TaskContext.get().partitionId(), []
        for batch in batches:
            words += batch.column("word").to_pylist()
            yield made(batch.num_rows, {"word": batch.column("word"), "n": batch.column("n"), "part": [part] * batch.num_rows})
        if not words:
            return
        _, first, last = _with_neighbours(words)
        for side, path, reach, least in ((0, words[0], first, 0), (1, words[-1], last, first[-1] + 1)):
            rows = list(_path(words, reach, path, least))
            if rows:
                names, depths, children, sizes = zip(*rows)
                yield made(len(rows), {"part": [part] * len(rows), "node": names, "side": [side] * len(rows), "depth": depths, "child": children, "size": sizes})

    return ordered.mapInArrow(run, _PATHS)


def _nodes(words: list[str], lcp: list[int]) -> Iterator[tuple[int, list[int]]]:
    """(depth, starts of its children and its end) of each node with several children, in the order in which they end."""
    stack: list[tuple[int, list[int]]] = []
    for i in range(1, len(words) + 1):
        shared = lcp[i] if i < len(words) else -1
        start = i - 1
        while stack and stack[-1][0] > shared:
            depth, starts = stack.pop()
            yield depth, [*starts, i]
            start = starts[0]
        if stack and stack[-1][0] == shared:
            stack[-1][1].append(i)
        elif shared >= 0:
            stack.append((shared, [start, i]))


class _Merge:
    """Pairs among the sorted words of a range; what lies beyond it is left to the join, several rows a word, and kept in Arrow only."""

    def __init__(self, words: list[str], counts: list[int], arrow: pa.Schema):
        self.words, self.counts, self.arrow = words, counts, arrow
        self.at = {word: i for i, word in enumerate(words)}
        self.near = [0] * len(words)
        self.best = [-1] * len(words)
        self.waiting: dict[str, tuple[list[int], list[str]]] = {"key": ([], []), "blank": ([], [])}
        self.sent: dict[str, list[pa.RecordBatch]] = {"key": [], "blank": []}

    def pair(self, i: int, j: int) -> None:
        for a, b in ((i, j), (j, i)):
            self.near[a] += 1
            best = self.best[a]
            if best < 0 or (-self.counts[b], b) < (-self.counts[best], best):
                self.best[a] = b

    def send(self, kind: str, i: int, value: str) -> None:
        at, values = self.waiting[kind]
        at.append(i)
        values.append(value)
        if len(at) >= SENT:
            self.flush(kind)

    def flush(self, kind: str) -> None:
        at, values = self.waiting[kind]
        none = [None] * len(at)
        columns = {"neg": none, "near": none, "key": none, "blank": none} | {kind: values}
        self.sent[kind].append(record_batch({"word": [self.words[i] for i in at], "n": [self.counts[i] for i in at], "cnt": [0] * len(at)} | columns, self.arrow))
        self.waiting[kind] = ([], [])

    def table(self) -> pa.Table:
        """A row for each word, then those for the join: each kind together, so that a reader can skip the others."""
        for kind in self.waiting:
            self.flush(kind)
        none = [None] * len(self.words)
        neg, near = [None if b < 0 else -self.counts[b] for b in self.best], [None if b < 0 else self.words[b] for b in self.best]
        own = record_batch({"word": self.words, "n": self.counts, "cnt": self.near, "neg": neg, "near": near, "key": none, "blank": none}, self.arrow)
        return pa.Table.from_batches([own, *self.sent["key"], *self.sent["blank"]], schema=self.arrow)

    def look(self, i: int, key: str, inside: bool) -> None:
        """A terminal of the changed subtree: the word it coincides with, if it is in this range; sent on if it would be in another."""
        j = self.at.get(key)
        if j is not None:
            self.pair(i, j)
        elif not inside and len(key) >= MIN_CHARS and not self.words[0] <= key <= self.words[-1]:
            self.send("key", i, key)

    def light(self, i: int, depth: int, heavy: str, inside: bool) -> str | None:
        """Merge a light word into the heavy subtree and into the node's own; returns what follows its own character."""
        word = self.words[i]
        before, after = word[:depth], word[depth:]
        self.look(i, before + heavy + after, inside)
        if not after:
            return None
        rest = after[1:]
        self.look(i, before + heavy + rest, inside)
        if not rest or rest[0] != after[0]:  # else the two words part further down
            self.look(i, before + rest, inside)
        return rest

    def inner(self, lcp: list[int]) -> None:
        """Nodes whose words are all here."""
        for depth, starts in _nodes(self.words, lcp):
            if starts[0] == 0 or starts[-1] == len(self.words):
                continue
            children = [(lo, hi, self.words[lo][depth : depth + 1]) for lo, hi in zip(starts, starts[1:])]
            heavy = min(children, key=lambda c: (not c[2], c[0] - c[1], c[2]))
            rests: dict[str, list[int]] = defaultdict(list)
            for child in children:
                if child is not heavy:
                    for i in range(child[0], child[1]):
                        rest = self.light(i, depth, heavy[2], True)
                        if rest is not None:
                            rests[rest].append(i)
            for same in rests.values():  # at most one for each letter
                for k, i in enumerate(same):
                    for j in same[:k]:
                        self.pair(i, j)

    def outer(self, reach: list[int], path: str, heavy: dict[int, str], least: int) -> None:
        """Nodes on the path of the first or the last word."""
        strays = [d for d in sorted(heavy) if d < len(path) and heavy[d] != path[d]]
        for i, word in enumerate(self.words):
            if reach[i] < least:
                continue
            end = reach[i]
            mine = [d for d in strays if d < end]
            if end in heavy and heavy[end] != word[end : end + 1]:
                mine.append(end)
            for d in mine:
                rest = self.light(i, d, heavy[d], False)
                if rest is not None:
                    self.send("blank", i, word[:d] + "\0" + rest)


def _merged(words: DataFrame, heavy: DataFrame) -> DataFrame:
    """Rows of ``_FOUND`` from (part, word, n) and (of, side, depth, heavy), a range at a time."""
    arrow = to_arrow_schema(StructType.fromDDL(_FOUND))

    def run(own: pa.Table, paths: pa.Table) -> pa.Table:
        if not own.num_rows:
            return arrow.empty_table()
        own = own.sort_by("word")
        merge = _Merge(own.column("word").to_pylist(), own.column("n").to_pylist(), arrow)
        lcp, first, last = _with_neighbours(merge.words)
        merge.inner(lcp)
        children: tuple[dict, dict] = ({}, {})
        for side, depth, child in zip(*(paths.column(c).to_pylist() for c in ("side", "depth", "heavy"))):
            children[side][depth] = child
        merge.outer(first, merge.words[0], children[0], 0)
        merge.outer(last, merge.words[-1], children[1], first[-1] + 1)
        return merge.table()

    return words.groupBy("part").cogroup(heavy.groupBy("of")).applyInArrow(run, _FOUND)


def neighbours(counts: DataFrame, range_chars: int = RANGE_CHARS, ranges: int | None = None) -> DataFrame:
    """word, n, n_near (words within one edit) and best (neg: minus the count, near: the word) from distinct (word, n)."""
    spark = counts.sparkSession
    held = Staged(counts.select("word", F.col("n").cast("long").alias("n")), "spell-counts")
    chars = held.df.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).first()[0]
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // range_chars))
    ordered = held.df.repartitionByRange(ranges, "word").sortWithinPartitions("word")
    swept = Staged(_with_paths(ordered), "spell-paths").df
    words = swept.where("word is not null").select("word", "n", "part")
    paths = swept.where("node is not null").select("part", "node", "side", "depth", "child", "size")
    sizes = paths.where("child is not null").groupBy("node", "child").agg(F.sum("size").alias("size"))
    heavy = sizes.groupBy("node").agg(F.min_by("child", F.struct(-F.col("size"), "child")).alias("heavy"))
    known = paths.select("part", "node", "side", "depth").distinct().join(heavy, "node").select(F.col("part").alias("of"), "side", "depth", "heavy")
    found = Staged(_merged(words, known), "spell-found").df
    here = found.where("key is null and blank is null").select("word", "n", "cnt", F.when(F.col("near").isNotNull(), F.struct("neg", "near")).alias("best"))
    hits = found.where("key is not null").select(F.col("word").alias("a"), F.col("n").alias("an"), "key").join(held.df.select(F.col("word").alias("key"), F.col("n").alias("bn")), "key")
    side = lambda word, n, other, count: hits.select(F.col(word).alias("word"), F.col(n).alias("n"), F.lit(1).cast("long").alias("cnt"), F.struct((-F.col(count)).alias("neg"), F.col(other).alias("near")).alias("best"))
    groups = found.where("blank is not null").groupBy("blank").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("neg"), F.col("word").alias("near")))).alias("same")).where(F.size("same") > 1)  # one a letter at most
    members = groups.select("same", F.explode("same").alias("own")).select(F.col("own.near").alias("word"), (-F.col("own.neg")).alias("n"), (F.size("same") - 1).cast("long").alias("cnt"), F.when(F.col("own") == F.col("same")[0], F.col("same")[1]).otherwise(F.col("same")[0]).alias("best"))
    every = here.unionByName(side("a", "an", "key", "bn")).unionByName(side("key", "bn", "a", "an")).unionByName(members)
    return every.groupBy("word").agg(F.max("n").alias("n"), F.sum("cnt").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms are followed to the last by doubling. No form may lead back to its word."""
    now = Staged(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        after = now.df.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = now.df.join(after, "root")
        if further.isEmpty():
            return now.df
        again = Staged(now.df.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spell-roots")
        now.drop()
        now = again


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES) -> DataFrame:
    """word, form (its near word of largest count, if that is ``times`` its own), root (the last form), n, n_near, form_n. As a form's count
    is a multiple of its word's, no chain is longer than the digits of a count."""
    near = neighbours(word_counts(df, id_col, text_col))
    good = -F.col("best.neg") >= times * F.col("n")
    table = Staged(near.select("word", F.when(good, F.col("best.near")).alias("form"), "n", "n_near", F.when(good, -F.col("best.neg")).alias("form_n")), "spell-forms").df
    ends = roots(table.where("form is not null").select("word", "form"))
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
