"""Near-duplicates by DartMinHash signatures, banded joins and an exact check.

A document is a weighted set: its shingles of five words (lower case, between white space), weighted by
count. Each unit of weight of an element has its own hashed sequence of darts: ranks that arrive at rate
one, each with a coordinate and a place within the unit (a dart beyond a fractional weight misses). Only
darts of rank below a bound that shrinks with the document's weight are thrown, about k (ln k + 6) in all;
the earliest per coordinate is the signature, so two documents agree in a coordinate with the probability
of their weighted Jaccard similarity. If a coordinate got no dart, the document's bound is doubled.

Texts of equal words are one node, named by its least id. Nodes that share a band meet the least node of the
bucket; these pairs get the exact similarity, links make components, and what a bucket's centre left open is
settled in blocks: a member x that is not linked to centre c can be linked to a linked member y only if
1 - J(c, x) <= 2 (1 - limit), as 1 - J is a metric. Nothing emits the pairs of a bucket.

Defined results: a text of one to four words is one shingle; texts without words (null ones too) are equal
to each other and to nothing else; rows with the same id are one document; rows whose id is null get the
class of an equal text, or null; very long texts are read whole; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import map_batches, texts
from docloom.llm.graph import components
from docloom.session import Staged

WORDS, LIMIT, BANDS, ROWS, BLOCK = 5, 0.8, 25, 4, 512
#: Cells that are thrown at once, and rows of an Arrow batch where rows carry texts or cells.
_CELLS, _BATCH = 1 << 17, 500
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C2
    x = (x ^ (x >> np.uint64(29))) * _C3
    return x ^ (x >> np.uint64(32))


def shingles(words: list[str], size: int = WORDS) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words; fewer words are one run."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = h[:n] + np.uint64(size)
    for j in range(1, size):
        out = _mix(out * _C1 + h[j : j + n])
    return out


def cells(words: list[str], size: int = WORDS) -> np.ndarray:
    """One hash per unit of weight: shingles numbered by occurrence, sorted. Jaccard over cells is the
    weighted Jaccard of the shingle counts."""
    found, counts = np.unique(shingles(words, size), return_counts=True)
    number = np.arange(counts.sum(), dtype=np.uint64) - np.repeat(np.cumsum(counts) - counts, counts).astype(np.uint64)
    return np.sort(_mix(np.repeat(found, counts) + number * _C1))


def throw(cell: np.ndarray, part: np.ndarray, owner: np.ndarray, bound: np.ndarray, k: int, best: np.ndarray) -> None:
    """Throw the darts of each cell up to its bound; ``part`` is the covered part of the unit, ``best`` keeps
    the earliest dart of each owner and coordinate (rank in the upper 32 bits, name below)."""
    rank, turn = np.zeros(len(cell)), 0
    while len(cell):
        turn += 1
        h = _mix(cell + np.uint64(turn * int(_C1) % (1 << 64)))
        rank = rank - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        flying = rank < bound
        cell, part, owner, bound, rank, h = cell[flying], part[flying], owner[flying], bound[flying], rank[flying], h[flying]
        name = _mix(h ^ _C2)
        value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (name & np.uint64(0xFFFFFFFF))
        at = owner * k + ((name >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        hit = slice(None) if part.min(initial=1.0) >= 1 else (_mix(name) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < part
        np.minimum.at(best, at[hit], value[hit])


def signatures(sets: list[np.ndarray], k: int, weights: list[np.ndarray] | None = None) -> np.ndarray:
    """One row of ``k`` values per weighted set; unit weights unless given. An empty set has all values empty."""
    if weights is not None:
        pieces = []
        for ids, w in zip(sets, weights, strict=True):
            units = np.ceil(w).astype(np.int64)
            number = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
            pieces.append((_mix(np.repeat(ids, units) + number.astype(np.uint64) * _C1), np.minimum(1.0, np.repeat(w, units) - number)))
        sets, parts = [p[0] for p in pieces], [p[1] for p in pieces]
    else:
        parts = [np.ones(len(s)) for s in sets]
    best = np.full(len(sets) * k, _EMPTY)
    todo, aim = [i for i, s in enumerate(sets) if len(s)], k * (math.log(k) + 6)
    while todo:
        group: list[int] = []
        for n, i in enumerate(todo):
            group.append(i)
            if n + 1 == len(todo) or sum(len(sets[g]) for g in group) >= _CELLS:
                for start in range(0, max(len(sets[g]) for g in group), _CELLS):  # a very long set goes in slices
                    cut = [(sets[g][start : start + _CELLS], parts[g][start : start + _CELLS], g) for g in group]
                    lengths = [len(c) for c, _, _ in cut]
                    bound = np.repeat([aim / parts[g].sum() for g in group], lengths)
                    throw(np.concatenate([c for c, _, _ in cut]), np.concatenate([p for _, p, _ in cut]), np.repeat(group, lengths), bound, k, best)
                group = []
        todo = [i for i in todo if (best[i * k : (i + 1) * k] == _EMPTY).any()]
        aim *= 2
    return best.reshape(len(sets), k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band, different for different bands."""
    shaped = signature.reshape(len(signature), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1)) * _C1
    for r in range(rows):
        key = _mix(key * _C1 + shaped[:, :, r])
    return key.view(np.int64)


def signed(df: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, hi and lo (128-bit digest of the words), keys array<long> (empty without words). No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        ids, column = batch.column("doc_id"), batch.column("text")
        hi, lo, keys = [], [], []
        for start in range(0, len(column), 512):
            split = [t.lower().split() for t in column.slice(start, 512).to_pylist()]
            digests = [xxhash.xxh3_128_intdigest(" ".join(w)) for w in split]
            hi += [(d >> 64) - (1 << 63) for d in digests]
            lo += [(d & (1 << 64) - 1) - (1 << 63) for d in digests]
            made = band_keys(signatures([cells(w, size) for w in split], bands * rows), bands, rows)
            keys += [row if w else [] for w, row in zip(split, made, strict=True)]
        return {"doc_id": ids, "hi": hi, "lo": lo, "keys": pa.array(keys, pa.list_(pa.int64()))}

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, hi long, lo long, keys array<long>")


def _with_cells(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(node, cells array<long>) of the named documents."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"node": batch.column("doc_id"), "cells": [cells(t.lower().split(), size).view(np.int64) for t in batch.column("text").to_pylist()]}

    # The ids grow with the corpus, so they are merged in whatever their number, never broadcast.
    wanted = ids.select(F.col("node").alias("doc_id")).hint("merge")
    return map_batches(docs.join(wanted, "doc_id", "left_semi"), run, "node long, cells array<long>")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (center, node) with their similarity."""

    def run(batch: pa.RecordBatch) -> dict:
        one, two = batch.column("cells"), batch.column("cells2")
        values = [jaccard(one[i].values.to_numpy(), two[i].values.to_numpy()) for i in range(batch.num_rows)]
        return {"center": batch.column("center"), "node": batch.column("node"), "j": values}

    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("center"), F.col("cells").alias("cells2")), "center")
    return map_batches(both.select("center", "node", "cells", "cells2"), run, "center long, node long, j double")


def _cross_links(group: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Links between the probing and the built rows of a block whose labels differ; one link joins two labels."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    found = []
    builds = [(r.node, r.label, np.asarray(r.cells)) for r in group[group.build].itertuples()]
    for p in group[~group.build].itertuples():
        own = np.asarray(p.cells)
        for node, label, other in builds:
            x, y = find(p.label), find(label)
            if x != y and min(len(own), len(other)) >= limit * max(len(own), len(other)) and jaccard(own, other) >= limit:
                root[max(x, y)] = min(x, y)
                found.append((p.node, node))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _open_links(measured: DataFrame, labels: DataFrame, sets: DataFrame, limit: float, block: int) -> DataFrame | None:
    """Links that no centre shows, sought among the nodes that met the same centre. ``measured``: center, node, j."""
    at = measured.withColumn("far", F.col("j") < limit)
    near = 2 * limit - 1  # beyond this the centre's linked nodes are out of reach
    by_center = at.groupBy("center").agg(F.count_if("far").alias("n_far"), F.count_if(F.col("far") & (F.col("j") >= near)).alias("n_near"), F.count("*").alias("n"))
    open_centers = by_center.where("n_far >= 2 or (n_near >= 1 and n > n_far)")
    rows = at.join(open_centers, "center").where("far or n_near > 0").select("center", "node", "far", "n_far", (F.col("n") - F.col("n_far")).alias("n_linked"), "n_near")
    rows = Staged(rows.join(labels.withColumnRenamed("label", "known"), "node", "left").withColumn("label", F.coalesce("known", "node")).drop("known"), "open-rows")
    if rows.df.isEmpty():
        return None
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / block)).cast("int")
    cut = rows.df.withColumn("nf", blocks("n_far")).withColumn("nm", F.when(F.col("n_near") > 0, blocks("n_linked")).otherwise(0))
    cut = cut.withColumn("blk", F.pmod(F.xxhash64("node"), F.when(F.col("far"), F.col("nf")).otherwise(F.col("nm"))).cast("int"))
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    of = lambda kind, xs: F.transform(xs, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("other")))
    # A far node probes every block of linked nodes and, of the far ones, its own block and the later ones.
    to = F.explode(F.concat(of("m", upto(F.lit(0), F.col("nm") - 1)), of("f", upto(F.col("blk"), F.col("nf") - 1)))).alias("t")
    probes = cut.where("far").select("center", "node", "label", F.col("blk").alias("f"), to, F.lit(False).alias("build"))
    probes = probes.select("center", "node", "label", "f", "t.kind", F.col("t.other").alias("blk"), "build")
    last = F.when(F.col("far"), F.col("blk")).otherwise(F.col("nf") - 1)
    builds = cut.select("center", "node", "label", F.explode(upto(F.lit(0), last)).alias("f"), F.when(F.col("far"), F.lit("f")).otherwise(F.lit("m")).alias("kind"), "blk", F.lit(True).alias("build"))
    placed = probes.unionByName(builds).join(sets, "node")
    return placed.groupBy("center", "f", "kind", "blk").applyInPandas(lambda g: _cross_links(g, limit), "a long, b long").distinct()


def classes(df: DataFrame, limit: float = LIMIT, bands: int = BANDS, rows: int = ROWS, size: int = WORDS, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the least id of the class) for every row of ``df``."""
    docs = texts(df, id_col, text_col)
    marks = Staged(signed(docs, bands, rows, size), "dart-marks", _BATCH)
    named = marks.df.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"), F.first("keys").alias("keys"))
    nodes = Staged(named, "dart-nodes")
    member = marks.df.select("doc_id", "hi", "lo").join(nodes.df.select("hi", "lo", "node"), ["hi", "lo"]).select("doc_id", "node")
    member = Staged(member, "dart-members").df
    marks.drop()
    # Rows of one id with different words are one document; a null id names none.
    several = member.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
    same_id = member.join(several, "doc_id").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    keyed = nodes.df.where("node is not null").select("node", F.explode("keys").alias("key"))
    centers = keyed.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = Staged(keyed.join(centers, "key").where("node <> center").select("center", "node").distinct(), "dart-pairs")
    nodes.drop()
    wanted = pairs.df.select("node").unionByName(pairs.df.select(F.col("center").alias("node"))).distinct()
    sets = Staged(_with_cells(docs, wanted, size), "dart-cells", _BATCH)
    measured = Staged(_measured(pairs.df, sets.df), "dart-measured", _BATCH)
    links = measured.df.where(F.col("j") >= limit).select(F.col("center").alias("a"), F.col("node").alias("b")).unionByName(same_id)
    labels = Staged(components(links), "dart-labels")
    more = _open_links(measured.df, labels.df, sets.df, limit, block)
    if more is not None:
        more = Staged(more, "dart-more")
        if not more.df.isEmpty():
            labels = Staged(components(links.unionByName(more.df)), "dart-labels")
    sets.drop()
    final = member.join(labels.df, "node", "left")
    return final.select("doc_id", F.coalesce("label", "node").alias("class_id"))


def _first_of(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """One row for each value of ``key``: that with the least hash of its text, then the least as JSON."""
    order = F.struct(F.xxhash64(text_col), F.to_json(F.struct("*")))
    return df.groupBy(key).agg(F.min_by(F.struct("*"), order).alias("__row")).select("__row.*")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """``df`` with one row of each class, the one with the least id; of rows that share it the one with the least hash
    of its text. Of rows without id one of each text stays, unless a row with an id has that text."""
    found = classes(df, id_col=id_col, text_col=text_col, **options)
    extra = found.where("doc_id <> class_id").select(F.col("doc_id").alias(id_col)).distinct().hint("merge")
    kept = df.where(F.col(id_col).isNotNull()).join(extra, id_col, "left_anti").select(*df.columns)
    again = found.where("doc_id is not null").groupBy(F.col("doc_id").alias(id_col)).count().where("count > 1").select(id_col)
    if not again.isEmpty():
        again = again.hint("merge")
        kept = kept.join(again, id_col, "left_anti").select(*df.columns).unionByName(_first_of(kept.join(again, id_col, "left_semi").select(*df.columns), id_col, text_col))
    nameless = df.where(F.col(id_col).isNull())
    if not nameless.isEmpty():
        digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("__digest")
        held = df.where(F.col(id_col).isNotNull()).select(digest).distinct()
        rows = _first_of(nameless.select(digest, *df.columns).join(held, "__digest", "left_anti"), "__digest", text_col)
        kept = kept.unionByName(rows.select(*df.columns))
    return kept
