"""Exact nearest neighbours by cosine distance, a block of queries against a block of vectors at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import Staged

#: Rows of a block on either side. A vector goes to as many tasks as there are blocks of queries, and k rows of each
#: query come back from each block of vectors, so large blocks are cheap; ``TILE`` distances are held at a time, of ``SLICE`` queries at most.
BLOCK, SLICE, TILE = 8192, 1024, 1 << 20
#: Rows that a Python worker is sent at a time: texts that a model turns into vectors, and pairs of blocks.
BATCH_ROWS, BATCH_PAIRS = 1024, 2
#: Distances count to 6 digits: two that differ by less may round alike.
_STEP = 1e-6
#: Stands for a null id within a task.
_NO_ID = -(1 << 63)


def _blocks(df: DataFrame, prefix: str) -> DataFrame:
    """Rows gathered into blocks of about ``BLOCK`` (by hash of the id). They are staged first, so that vectors that a model makes are made once."""
    held = Staged(df.select("vec_id", "embedding"), "vectors", BATCH_ROWS).df
    n = max(1, -(-held.count() // BLOCK))
    placed = held.where(F.size("embedding") > 0).withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    return placed.groupBy("blk").agg(F.collect_list(F.struct("vec_id", "embedding")).alias(f"{prefix}_rows")).withColumnRenamed("blk", f"{prefix}_blk")


def _unit(items: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of the rows of a block that have a direction, read off Arrow's buffers."""
    ids = items.field("vec_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    lists = items.field("embedding")
    sizes = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()}")
    m = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), -1)
    norm = np.linalg.norm(m, axis=1)
    return ids[norm > 0], m[norm > 0] / norm[norm > 0, None]


def _best(qm: np.ndarray, ids: np.ndarray, rm: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, ids and distances of the k best rows of each query; ties of rounded distances go by id."""
    like = qm @ rm.T
    if like.shape[1] > k:
        # Whatever rounds to at most the k-th distance is at most a step farther.
        least = np.partition(like, like.shape[1] - k, axis=1)[:, like.shape[1] - k]
        at, row = np.nonzero(like >= (least - 2 * _STEP)[:, None])
    else:
        at, row = (x.ravel() for x in np.indices(like.shape))
    distance, found = np.round(1 - like[at, row], 6), ids[row]
    order = np.lexsort((found, distance, at))
    at = at[order]
    first = np.searchsorted(at, np.arange(len(qm)))
    kept = order[np.arange(len(at)) - first[at] < k]
    return at[np.arange(len(at)) - first[at] < k], found[kept], distance[kept]


def best_of_blocks(paired: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, place, distance of the k best rows of each query, from rows (q_rows, r_rows) that pair a block of queries with
    a block of rows, each array<struct<vec_id, embedding>>. The best of each pair are staged, ``BATCH_PAIRS`` pairs in a worker at a time."""

    def run(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                (qi, qm), (ri, rm) = (_unit(batch.column(side)[n].values) for side in ("q_rows", "r_rows"))
                if not len(qi) or not len(ri):
                    continue
                rows = max(1, min(SLICE, TILE // len(ri)))
                for start in range(0, len(qi), rows):
                    at, ids, distance = _best(qm[start : start + rows], ri, rm, k)
                    yield pa.RecordBatch.from_arrays([pa.array(qi[start : start + rows][at]), pa.array(ids), pa.array(distance)], names=["query_id", "vec_id", "distance"])

    known = lambda c: F.nullif(F.col(c), F.lit(_NO_ID)).alias(c)
    best = paired.select("q_rows", "r_rows").mapInArrow(run, "query_id long, vec_id long, distance double")
    found = Staged(best, "nearest", BATCH_PAIRS).df.select(known("query_id"), known("vec_id"), "distance")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return found.withColumn("place", place.cast("long")).where(F.col("place") <= k).select("query_id", "vec_id", "place", (F.col("distance") + 0.0).alias("distance"))


def nearest(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, place, distance (6 digits) of the k nearest rows of each query; ties go by id. Null vectors, and
    zero vectors, have no distance and no neighbours. Both sides have vec_id and embedding, of one length. Blocks are
    bounded; of a pair of blocks only k rows a query go on. Blocks are joined by sorting: a broadcast would send what is small in files,
    as equal vectors are, through the driver whole."""
    q, r = _blocks(queries, "q"), _blocks(rows, "r")
    grid = q.select("q_blk").join(r.select("r_blk"), F.lit(True))  # pairs of blocks of the stated query set
    return best_of_blocks(grid.join(q.hint("merge"), "q_blk").join(r.hint("merge"), "r_blk").select("q_rows", "r_rows"), k)
