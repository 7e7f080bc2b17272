"""Document fingerprints by Order MinHash.

The k-mers of a text (k code points) are numbered by occurrence, so that repeats count. Each of ``m``
hash functions picks the ``l`` numbered k-mers with the smallest hashes, puts them back in text order and
hashes that tuple: one value of the fingerprint. Two texts agree in a value only if they share the k-mers
and their order, which makes the share of equal values sensitive to edit distance.

Defined results: a text of fewer than k code points is one k-mer of its own; a text with fewer than l
k-mers gives shorter tuples; a null text is empty, and all empty texts have the same fingerprint. Equal
hashes within a text are resolved by position. Rows of one id, and those without id (which come last), follow
each other by the hash of their text, so an id that many rows share is spread over ranges; an empty table gives
no rows; other columns are not looked at. Very long texts are read whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.llm.common import record_batch, texts

K, L, M = 8, 2, 64
_rng = np.random.default_rng(20240607)
_XOR, _ODD = _rng.integers(0, 1 << 32, 512, np.uint32), _rng.integers(0, 1 << 31, 512, np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def kmer_hashes(text: str, k: int = K) -> np.ndarray:
    """A 32-bit hash of each occurrence-numbered k-mer, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.uint32)
    k = min(k, len(points))
    n = len(points) - k + 1
    code = np.zeros(n, np.uint64)
    for j in range(k):
        code = code * np.uint64(0x100000001B3) + points[j : j + n] + np.uint64(1)
    code = _mix(code)
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    if len(starts) < n:  # numbers within runs of equal k-mers
        number = np.empty(n, np.uint64)
        number[order] = np.arange(n, dtype=np.uint64) - np.repeat(starts, np.diff(np.r_[starts, n])).astype(np.uint64)
        code = _mix(code + number * _MIX)
    return (code >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str, k: int = K, l: int = L, m: int = M) -> np.ndarray:  # noqa: E741
    """``m`` values of 32 bits; all zero for an empty text."""
    x = kmer_hashes(text, k)
    if not len(x):
        return np.zeros(m, np.uint32)
    at, top = np.empty((m, min(l, len(x))), np.int64), np.uint32(0xFFFFFFFF)
    work = np.empty_like(x)
    for j in range(m):
        np.bitwise_xor(x, _XOR[j], out=work)
        np.multiply(work, _ODD[j], out=work)
        for pick in range(at.shape[1]):
            best = int(work.argmin())
            at[j, pick], work[best] = best, top
    if at.shape[1] > 1 and len(x) > 1:
        at.sort(axis=1)  # back in text order
    value = np.full(m, at.shape[1], np.uint64)
    for pick in range(at.shape[1]):
        value = _mix(value * _MIX + x[at[:, pick]] + np.uint64(1))
    return (value >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many code points (or all) of the following one's beginning."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


#: Ranges are first cut so much finer and then joined to about equal bytes.
FINE = 4
_FIRST_ID = -(1 << 63)


def _cuts(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids at about every n-th part of the rows, ascending, and how often each is such an id; null ids count as the
    least id. An id that comes more than once has many rows, which are cut by the hash of their text."""
    ids = docs.select(F.coalesce("doc_id", F.lit(_FIRST_ID)).alias("doc_id"))
    found = ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.5 / n) if n > 1 else []
    limit = (1 << 63) - 1
    values, times = np.unique(np.array([max(_FIRST_ID, min(limit, int(c))) for c in found], np.int64), return_counts=True)
    return values, times


def _fine_places(ids: np.ndarray, hashes: np.ndarray, values: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Places of rows by descending id and, within an id, ascending hash: the more rows an id has, the more places."""
    if not len(values):
        return np.zeros(len(ids), np.int64)
    slots = np.where(times > 1, times, 0)
    offset = np.arange(len(values) + 1) + np.concatenate([[0], np.cumsum(slots)])
    at = np.searchsorted(values, ids)
    near = np.minimum(at, len(values) - 1)
    hot = (at < len(values)) & (values[near] == ids) & (times[near] > 1)
    unit = (hashes.astype(np.float64) + 2.0**63) / 2.0**64
    part = np.minimum(np.floor(unit * times[near]), times[near] - 1).astype(np.int64)
    up = offset[at] + np.where(hot, times[near] - part, 0)
    return offset[-1] - up


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """The rows in ranges of descending id, each range followed by a copy of the first row of the next one
    (``ahead`` true; after the last range comes the very first row). One shuffle of the texts, each range a
    partition of its own; the driver sees an id, a hash and a size for each of ``FINE`` times the ranges."""
    docs = texts(df, id_col, text_col).withColumn("h", F.xxhash64("text"))
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values, times = _cuts(texts(df, id_col, text_col), ranges * FINE)

    @F.arrow_udf("long")
    def fine(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(_fine_places(pc.fill_null(ids, _FIRST_ID).to_numpy(), hashes.to_numpy(), values, times))

    first = F.min(F.struct(F.isnull("doc_id").alias("none"), F.bitwise_not("doc_id").alias("down"), "h"))
    size = F.sum(F.length("text") + 64)
    parts = docs.groupBy(fine("doc_id", "h").alias("part")).agg(first.alias("first"), size.alias("size")).orderBy("part").collect()
    # Fine ranges are joined up to an even share of the bytes.
    share, place, filled = sum(r.size for r in parts) / ranges, {}, 0
    for r in parts:
        place[r.part] = min(ranges - 1, int(filled / share))
        filled += r.size
    numbers = {p: k for k, p in enumerate(dict.fromkeys(place.values()))}
    n = max(1, len(numbers))
    place_of = np.zeros(max(place, default=0) + 1, np.int64)
    first_none, first_id, first_h = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in reversed(parts):
        k = place_of[r.part] = numbers[place[r.part]]
        first_none[k], first_id[k], first_h[k] = r.first.none, 0 if r.first.none else ~r.first.down, r.first.h

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        none, own, h = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, _FIRST_ID).to_numpy(), hashes.to_numpy()
        at = place_of[np.minimum(_fine_places(own, h, values, times), len(place_of) - 1)]
        leads = (none == first_none[at]) & (none | (own == first_id[at])) & (h == first_h[at])
        both = np.stack([at, (at - 1) % n], axis=1)
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(1 + leads)]).astype(np.int32), both[np.stack([np.ones(len(at), bool), leads], axis=1)].astype(np.int32))

    sent = docs.select("doc_id", "text", "h", F.posexplode(places("doc_id", "h")).alias("ahead", "place")).withColumn("ahead", F.col("ahead") > 0)
    return sent.repartitionById(n, "place").sortWithinPartitions("place", "ahead", F.desc_nulls_last("doc_id"), "h", "text")


def compare_with_next(df: DataFrame, k: int = K, l: int = L, m: int = M, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:  # noqa: E741
    """Each row's fingerprint, its edited text's, and its likeness to that and to the next row's fingerprint."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    hexed = lambda x: x.astype(">u4").tobytes().hex()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next
        remembered: dict[str, np.ndarray] = {}
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in arrow}
            columns = (batch.column(c).to_pylist() for c in ("place", "ahead", "doc_id", "text"))
            for place, ahead, doc_id, text in zip(*columns, strict=True):
                if held is not None and held[0] != place:
                    held = None
                mark = remembered.get(text)
                if mark is None:
                    if len(remembered) > 64:
                        remembered.clear()
                    mark = remembered[text] = fingerprint(text, k, l, m)
                if held is not None:
                    _, own_id, own_text, own = held
                    changed = edited(own_text, text)
                    mark2 = fingerprint(changed, k, l, m)
                    row = (own_id, len(own_text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), hexed(own), hexed(mark2), likeness(own, mark2), likeness(own, mark))
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
                held = None if ahead else (place, doc_id, text, mark)
            if out["doc_id"]:
                yield record_batch(out, arrow)

    return with_next(df, id_col, text_col, ranges).mapInArrow(run, schema)
