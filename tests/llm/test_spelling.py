"""Spelling variants: the registered query and small vocabularies against a plain version, with ranges cut anywhere."""

import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from docloom.llm import queries, spelling

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_near(counts):
    """Words by each of their cuts: two that agree in one are within one edit."""
    by = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            by[k, w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for (_, rest), same in by.items():
        for w in same:
            near[w] |= same - {w}
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    return near


def plain_variants(counts):
    near, form = plain_near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def found(df):
    assert [(c, t) for c, t in df.dtypes] == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_plain(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    assert found(queries.QUERIES["op13_spelling_variants"](spark, SF)) == plain_variants(plain_counts(rows))


@pytest.mark.parametrize("ranges", [1, 4, 25])
def test_any_vocabulary_cut_anywhere(spark, ranges):
    """Dense words over few letters, prefixes of each other, runs of one letter, long words: pairs within and across ranges."""
    rng = random.Random(ranges)
    words = {"".join(rng.choice("aab") for _ in range(rng.choice([7, 7, 8, 8, 9]))) for _ in range(250)} | {"a" * k for k in (7, 8, 9, 11, 200, 201)} | {"x" * 300 + c + "é" * 9 for c in ("", "y", "z", "yy")}
    words |= {"stürmisch", "sturmisch", "stürmische", "stürmsch", "zzzzzzzz"}
    counts = {w: rng.randint(2, 50) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: r for r in spelling.neighbours(df, ranges=ranges).collect()}
    near = plain_near(counts)
    assert set(got) == words
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        assert (got[w].n, got[w].n_near, got[w].best and got[w].best.near, got[w].best and -got[w].best.neg) == (counts[w], len(near[w]), best, counts.get(best)), w


def test_chains_and_odd_rows(spark):
    """A chain of forms, ties, null ids and texts, a very long run, a small flush, an empty table, clashing names."""
    rows = [(None, "chainlink " * 3000, 1), (None, None, 1), (1, "", 1), (2, "chainlinx " * 200 + "CHAINLINX", 1), (3, "chainlimx " * 3, 1), (4, "w" * 100_000 + " " + "w" * 100_000 + "-" + "w" * 99_999, 1), (4, "tiesones tiesones tiesonez tiesonez", 1), (-5, "Été-Éternelle éternelle éternelle", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    want = plain_variants(plain_counts([r[:2] for r in rows]))
    assert found(spelling.variants(df)) == want
    assert {r[0]: r[2] for r in want}["chainlimx"] == "chainlink"
    counts = plain_counts([r[:2] for r in rows])
    assert {r.word: r.n for r in spelling.word_counts(df, held=2).collect()} == counts
    assert spelling.variants(df.limit(0)).count() == 0


class _Caught:
    """Takes the place of both frames of ``_merged`` and keeps the function that is run on each range."""

    def groupBy(self, name):
        return self

    def cogroup(self, other):
        return self

    def applyInArrow(self, run, schema):
        self.run = run


def test_rows_for_the_join_are_not_held_in_python(spark):
    """A range far below the root sends many rows a word to the join: what they take as Python values doesn't grow with them."""
    rng = random.Random(3)
    words = sorted({"abcdefgh" + "".join(rng.choice("stuvwxyz") for _ in range(6)) for _ in range(4000)})
    own = pa.table({"part": [0] * len(words), "word": words, "n": [2 + i % 7 for i in range(len(words))]})
    paths = pa.table({"side": [0] * 8, "depth": list(range(8)), "heavy": ["q"] * 8})
    caught = _Caught()
    spelling._merged(caught, caught)
    tracemalloc.start()
    rows = caught.run(own, paths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.num_rows == len(words) * (1 + 8 * 4)  # as the heavy child's with it put before, with it replaced, and without; and as a light one
    assert peak < 12_000_000
    got = rows.to_pydict()
    assert [w for w, k, b in zip(got["word"], got["key"], got["blank"]) if k is None and b is None] == words
    assert set(zip(got["word"], got["n"])) == set(zip(words, own["n"].to_pylist()))
    assert {k for w, k in zip(got["word"], got["key"]) if w == words[5] and k} == {words[5][:d] + x + words[5][d + len(y) :] for d in range(8) for x, y in (("q", ""), ("q", "-"), ("", "-"))}
    assert {b for w, b in zip(got["word"], got["blank"]) if w == words[5] and b} == {words[5][:d] + "\0" + words[5][d + 1 :] for d in range(8)}
