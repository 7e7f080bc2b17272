"""An embedder without a model server: hashed words and word pairs, weighted by how rare they are, under a signed random projection.

Every word and pair of words has a bucket by its digest. How many texts hold a bucket is counted in Spark over the whole corpus; there are
``BUCKETS`` counts, however large the corpus, so they fit the driver and every task. A text's vector is the sum of its buckets' rows of a
fixed matrix of signs, each weighted by the logarithms of its count in the text and of its rareness, at length 1. Texts that share
rare words point the same way; those with the same words in the same order have the same vector.

Defined results: only A to Z are lower-cased; a null or blank text has the zero vector, which is near to nothing; texts are read whole; buckets that the corpus
does not hold weigh as if one text held them.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    from _md5 import md5  # for texts of a few bytes faster than hashlib's
except ImportError:
    from hashlib import md5

BUCKETS, DIM, SEED = 1 << 18, 128, 7
_DIGITS = 5
#: Bits of three bytes beyond ``_DIGITS`` hex digits.
_SPARE_BITS = 24 - 4 * _DIGITS
_WORD = re.compile(r"[^ \t\n\r\f]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket(gram: str) -> int:
    """The first hex digits of the gram's MD5, within ``BUCKETS``."""
    return (int.from_bytes(md5(gram.encode()).digest()[:3]) >> _SPARE_BITS) % BUCKETS


def buckets(text: str) -> dict[int, int]:
    """How often a text has each bucket, by its words and pairs of neighbouring words."""
    words = _WORD.findall(text.translate(_FOLD))
    grams = Counter(words)
    grams.update(map(" ".join, zip(words, words[1:])))
    digests = b"".join([md5(gram.encode()).digest()[:3] for gram in grams])
    parts = np.frombuffer(digests, np.uint8).reshape(-1, 3).astype(np.int64)
    at = (((parts[:, 0] << 16) + (parts[:, 1] << 8) + parts[:, 2]) >> _SPARE_BITS) % BUCKETS
    held, own = np.unique(at, return_inverse=True)
    n = np.bincount(own, np.fromiter(grams.values(), float, len(grams)), len(held)).astype(np.int64)
    return dict(zip(held.tolist(), n.tolist()))


def frequencies(df: DataFrame, text_col: str) -> DataFrame:
    """(bucket, n): texts that hold each bucket. A task sends at most one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if (value := text.as_py()):
                    counts[list(buckets(value))] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["bucket", "n"])

    return df.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=2)
def _signs(dim: int, seed: int) -> np.ndarray:
    """The matrix of signs; each worker process makes it once."""
    return np.random.default_rng(seed).integers(0, 2, (BUCKETS, dim), np.int8) * np.int8(2) - np.int8(1)


@dataclass
class Embedder:
    """Called with texts, gives their vectors; use it where a plan asks for ``embed``."""

    weights: np.ndarray
    dim: int = DIM
    seed: int = SEED

    def __call__(self, texts: list[str]) -> list[list[float]]:
        signs, out = _signs(self.dim, self.seed), []
        for text in texts:
            found = buckets(text or "")
            at = np.fromiter(sorted(found), np.int64, len(found))
            tf = 1 + np.log(np.fromiter((found[b] for b in at.tolist()), float, len(at)))
            v = (tf * self.weights[at]) @ signs[at] if len(at) else np.zeros(self.dim)
            norm = float(np.linalg.norm(v))
            out.append((v / norm if norm else v).astype(np.float32).tolist())
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(self.weights.tolist()), self.dim, self.seed)], "weights string, dim int, seed int").write.mode("overwrite").parquet(path)


def fit(df: DataFrame, text_col: str, dim: int = DIM, seed: int = SEED) -> Embedder:
    """The embedder whose weights are those of a corpus."""
    n, counts = 0, np.ones(BUCKETS)
    n = df.where(F.length(text_col) > 0).count()
    for row in frequencies(df, text_col).toLocalIterator():  # BUCKETS rows at most
        counts[row.bucket] = row.n
    return Embedder(np.log((1 + n) / (1 + counts)) + 1 / (1 + math.log1p(n)), dim, seed)


def load(spark: SparkSession, path: str) -> Embedder:
    held = spark.read.parquet(path).first()
    return Embedder(np.array(json.loads(held.weights)), held.dim, held.seed)
