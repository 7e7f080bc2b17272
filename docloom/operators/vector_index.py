"""An inverted file over vectors: approximate nearest neighbours by cosine distance that read a few lists, not all rows.

Centroids are fitted by spherical k-means on at most ``SAMPLE_ROWS`` vectors, those with the least hash of their id; every vector of the
table is then assigned to the list of its nearest centroid. A list with more than ``PART_ROWS`` vectors is split into parts by hash of
the id, so a list that holds most of the rows is many blocks of bounded size. A query is compared with the vectors of the lists
whose centroids are nearest to it. Blocks of queries meet blocks of a list by joins on the list; there is no grid over all blocks.

Defined results: null vectors and vectors of length 0 have no direction and are in no list; ties go by id; an empty table gives
an index without lists, in which nothing is found; rows with the same id are entries of their own; other columns are not looked at.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.vectors import best_of_blocks, nearest
from docloom.session import Staged

#: Vectors that the fit sees; lists at most (their centroids go to every task); rows of a block of a list and of queries.
SAMPLE_ROWS, MOST_LISTS, PART_ROWS, QUERY_ROWS = 20_000, 2048, 4096, 1024
ROUNDS, SEED = 12, 11
#: Vectors that the driver compares with others at a time while it fits; rows that a Python worker is sent at a time.
FIT_ROWS, BATCH_ROWS = 128, 1024
#: Rows that are drawn for the sample beyond it, as a share: the cut by hash is made from an estimated count.
SPARE = 0.25
#: Probes are fitted so that ``PROBE_QUERIES`` vectors of the sample find this share of their nearest.
PROBE_QUERIES, WANTED = 1000, 0.96
_ASSIGNED = "vec_id long, list int, embedding array<float>"


def _units(vectors: list | np.ndarray) -> np.ndarray:
    m = np.array(vectors, np.float32).reshape(len(vectors), -1)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def fit(sample: np.ndarray, lists: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Unit centroids of unit vectors. A centroid that loses all its vectors moves to the vector that is worst served."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        own, served = np.zeros(len(sample), np.int64), np.zeros(len(sample), np.float32)
        for start in range(0, len(sample), FIT_ROWS):
            likeness = sample[start : start + FIT_ROWS] @ centres.T
            own[start : start + FIT_ROWS], served[start : start + FIT_ROWS] = likeness.argmax(axis=1), likeness.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=lists) == 0)
        sums[empty] = sample[served.argsort(kind="stable")[: len(empty)]]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-30), centres).astype(np.float32)
    return centres


def fit_probes(sample: np.ndarray, centres: np.ndarray, k: int, wanted: float) -> int:
    """The least number of lists by which queries of the sample find, on average, the share ``wanted`` of their k nearest vectors of it. Queries are
    taken ``FIT_ROWS`` at a time, so the driver holds no matrix of all queries and the sample."""
    k = min(k, len(sample))
    own = np.concatenate([(sample[start : start + FIT_ROWS] @ centres.T).argmax(axis=1) for start in range(0, len(sample), FIT_ROWS)])
    ranks = []
    for start in range(0, min(len(sample), PROBE_QUERIES), FIT_ROWS):
        asked = sample[start : min(start + FIT_ROWS, PROBE_QUERIES)]
        near = np.argpartition(-(asked @ sample.T), k - 1, axis=1)[:, :k]
        rank = np.argsort(np.argsort(-(asked @ centres.T), axis=1, kind="stable"), axis=1)  # of each list, from a query
        ranks.append(np.take_along_axis(rank, own[near], axis=1).ravel())
    found = np.sort(np.concatenate(ranks))
    return int(found[min(len(found) - 1, int(np.ceil(wanted * len(found))) - 1)]) + 1


def _near_lists(df: DataFrame, centres: np.ndarray, n: int, schema: str, keep_vector: bool) -> DataFrame:
    """vec_id, list (and embedding) for each of the ``n`` nearest centroids of each vector with a direction."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                vectors = batch.column("embedding").to_pylist()
                if not vectors:
                    continue
                m = _units(vectors)
                own = np.argsort(-(m @ centres.T), axis=1, kind="stable")[:, :n] if n > 1 else (m @ centres.T).argmax(axis=1)[:, None]
                rows = np.flatnonzero(np.abs(m).sum(axis=1) > 0)
                at = pa.array(np.repeat(rows, own.shape[1]))
                columns = {"vec_id": batch.column("vec_id").take(at), "list": pa.array(own[rows].ravel(), pa.int32())}
                if keep_vector:
                    columns["embedding"] = batch.column("embedding").take(at)
                yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    held = df.where("embedding is not null and size(embedding) > 0").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    return held.mapInArrow(run, schema)


@dataclass
class Index:
    """``blocks``: (list, part, rows array<struct<vec_id, embedding>>), at most about ``PART_ROWS`` rows each. ``probes``: lists that a search
    reads if it doesn't say how many."""

    centres: np.ndarray
    blocks: DataFrame
    probes: int = 1

    def members(self) -> DataFrame:
        """vec_id, list, part, embedding: every row of the index once."""
        return self.blocks.select("list", "part", F.explode("rows").alias("r")).select("r.vec_id", "list", "part", "r.embedding")

    def save(self, path: str) -> None:
        """Centroids and blocks as tables under ``path``."""
        spark = self.blocks.sparkSession
        self.blocks.write.mode("overwrite").parquet(f"{path}/blocks")
        spark.createDataFrame([(json.dumps(self.centres.tolist()), self.probes)], "centres string, probes int").write.mode("overwrite").parquet(f"{path}/centres")

    def add(self, rows: DataFrame, part_rows: int = PART_ROWS) -> Index:
        """The index with more rows, in new parts of the same lists; centroids stay."""
        more = _in_blocks(rows, self.centres, part_rows)
        upto = self.blocks.groupBy("list").agg(F.max("part").alias("upto"))
        shifted = more.join(upto, "list", "left").select("list", (F.col("part") + F.coalesce(F.col("upto") + 1, F.lit(0))).cast("int").alias("part"), "rows")
        return Index(self.centres, self.blocks.unionByName(shifted), self.probes)

    def search(self, queries: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
        """query_id, vec_id, place, distance (6 digits) of the k nearest rows in the ``probes`` lists nearest to each query (as many
        as were fitted, if not given); with as many probes as lists the result is exact, and all lists are read in large blocks, as no query need be dealt to each. Columns as in ``vectors.nearest``."""
        probes = min(len(self.centres), probes or self.probes)
        if not probes:
            return queries.sparkSession.createDataFrame([], "query_id long, vec_id long, place long, distance double")
        if probes == len(self.centres):
            return nearest(queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")), self.members().select("vec_id", "embedding"), k)
        wanted = Staged(_near_lists(queries, self.centres, probes, _ASSIGNED, True), "index-queries").df
        sizes = wanted.groupBy("list").agg(F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("blks"))  # one row a list
        dealt = wanted.join(F.broadcast(sizes), "list").withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("blks")))
        asked = dealt.groupBy("list", "blk").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("q_rows"))
        # Neither side may be broadcast, as Spark judges by the size of files, where a vector written for each of its lists takes hardly any room.
        return best_of_blocks(asked.join(self.blocks.withColumnRenamed("rows", "r_rows").hint("merge"), "list").select("q_rows", "r_rows"), k)


def _in_blocks(rows: DataFrame, centres: np.ndarray, part_rows: int) -> DataFrame:
    placed = Staged(_near_lists(rows, centres, 1, _ASSIGNED, True), "index-rows").df
    sizes = placed.groupBy("list").agg(F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts"))  # one row a list, MOST_LISTS at most
    dealt = placed.join(F.broadcast(sizes), "list").withColumn("part", F.pmod(F.xxhash64("vec_id", F.xxhash64("embedding")), F.col("parts")).cast("int"))
    return dealt.groupBy("list", "part").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("rows"))


def _drawn(usable: DataFrame, sample_rows: int, seed: int) -> tuple[int, np.ndarray]:
    """How many rows there are, and the vectors of the ``sample_rows`` with the least hash of their id. Only rows below a cut of the hash, about
    as many as are wanted, come near the driver: of each partition the least ``sample_rows`` would grow with the partitions. Too low a cut is raised."""
    hashed = usable.select(F.xxhash64("vec_id", F.lit(seed)).alias("h"), "vec_id", "embedding")
    n, ids = hashed.agg(F.count("*"), F.approx_count_distinct("h")).first()
    share = (1 + SPARE) * sample_rows / max(1, min(n, ids))
    while True:
        least = hashed if share >= 1 else hashed.where(F.col("h") <= int(share * 2**64) - 2**63)
        held = least.orderBy("h", "vec_id").limit(sample_rows).select("embedding").toArrow().column("embedding").combine_chunks()
        if share >= 1 or len(held) >= min(n, sample_rows):
            return n, held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1) if len(held) else np.zeros((0, 0))
        share *= 4


def build(rows: DataFrame, lists: int | None = None, sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS, seed: int = SEED, k: int = 5, wanted: float = WANTED) -> Index:
    """The index of all ``rows`` (vec_id, embedding): ``lists`` centroids (the square root of the number of rows if not given, and never more than
    the sample can tell apart) fitted on ``sample_rows`` of them, and as many probes as find the share ``wanted`` of the ``k`` nearest in the sample."""
    usable = rows.where("embedding is not null and size(embedding) > 0 and exists(embedding, x -> x <> 0)").select("vec_id", "embedding")
    n, drawn = _drawn(usable, sample_rows, seed)
    if not len(drawn):
        return Index(np.zeros((0, 0), np.float32), rows.sparkSession.createDataFrame([], "list int, part int, rows array<struct<vec_id:bigint,embedding:array<float>>>"))
    lists = min(lists or max(1, math.isqrt(n)), MOST_LISTS, max(1, len(drawn) // 8))
    units = _units(drawn)
    centres = fit(units, lists, seed=seed)
    return Index(centres, Staged(_in_blocks(rows, centres, part_rows), "index-blocks").df, fit_probes(units, centres, k, wanted))


def load(spark: SparkSession, path: str) -> Index:
    """The index that ``save`` wrote."""
    held = spark.read.parquet(f"{path}/centres").first()
    return Index(np.array(json.loads(held.centres), np.float32), spark.read.parquet(f"{path}/blocks"), held.probes)
