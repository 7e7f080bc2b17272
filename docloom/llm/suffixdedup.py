"""Removal of repeated substrings by blockwise suffix sorting with a cover sample.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts anywhere else. A cover sample is a set
of positions such that two equal windows hold a sampled position at the same offset; sorting suffixes can then
stop at it and go by its rank. Sampled by position modulo a period, a cover takes a tenth of all positions;
here it is sampled by content (the leftmost least hash of ``GRAM`` bytes in each window), which has the same
property at a seventh of the density and lets Spark tell by joins which samples occur more than once.

1. Every sampled position sends its gram's hash and a hash of its context (all windows that hold the gram).
2. Joined counts sort positions into: gram met once (nothing to do), same context met twice (all its windows
   repeat), other contexts with that gram (their windows are to be compared).
3. The contexts of a gram, one of each kind, form a suffix bucket. Buckets are sorted a block at a time: ranks
   of the fixed cover (every ``STEP`` bytes of the context) first, then each suffix by the few bytes before
   that sample and after it and by its rank. Equal neighbours are repeated windows.
4. Marked windows return to their documents.

A bucket of more than ``HOT`` contexts is sorted in finer buckets, as a suffix bucket is by a longer prefix: of the windows
through a gram one half holds more bytes before it, the other half more bytes after it, and contexts meet again by
the bytes that all windows of a half share. Halves are halved until a bucket is small or its windows are all equal; so
no task holds more than a bucket of ``HOT`` contexts and a block. Copied contexts are settled by joins on hashes,
without comparing suffixes; only the differing contexts of a shared gram are sorted.

Defined results: null texts are empty; texts below ``WINDOW`` bytes stay as they are; exact copies remove each
other in full; repeated rows count as further places; rows are told apart by id and text, so ids may repeat or be
null; very long texts are read in slices; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.llm.common import map_batches, record_batch, texts
from docloom.session import Staged

WINDOW, GRAM, STEP = 200, 64, 8
SPAN = WINDOW - GRAM  # a window starts at most so far before its gram
CONTEXT = SPAN + WINDOW
SLICE, HOT, BLOCK = 1 << 16, 4096, 16_384
_VALUES = np.random.default_rng(2718).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_LENGTH = SLICE + 3 * CONTEXT
_POWER = np.cumprod(np.r_[np.uint64(1), np.full(_LENGTH, _BASE, np.uint64)])
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(_LENGTH, pow(_BASE, -1, 1 << 64), np.uint64)])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACE = np.uint64((1 << 17) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def cover_sample(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions of a text with the hash of the gram and of the context (clipped to the text)."""
    view, n, found = np.frombuffer(data, np.uint8), len(data), []
    for start in range(0, max(0, n - WINDOW + 1), SLICE):
        first, stop = max(0, start - SPAN), min(n, start + SLICE + CONTEXT)
        piece = view[first:stop]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_VALUES[piece] * _POWER[: len(piece)], out=sums[1:])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * _INVERSE[: len(piece) - GRAM + 1])
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width * 2 <= SPAN + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (SPAN + 1 - width)], least[SPAN + 1 - width :])
        windows = least[start - first : start - first + min(SLICE, n - WINDOW + 1 - start)]
        at = (windows & _PLACE).astype(np.int64)
        at = at[np.r_[True, at[1:] != at[:-1]]]
        left, right = np.minimum(at + first, SPAN), np.minimum(n - at - first, WINDOW)
        context = (sums[at + right] - sums[at - left]) * _INVERSE[at - left]
        context = _mix(context + _mix((left * 1000 + right).astype(np.uint64)))
        found.append((at + first, grams[at], context))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at, gram, context = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = np.r_[True, at[1:] != at[:-1]]
    return at[keep], gram[keep], context[keep]


def repeated_windows(bucket: np.ndarray, context: list[bytes], left: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each context, which of its windows (by offset from ``SPAN`` bytes before the gram, from ``first`` to ``last`` of
    its bucket) another context of the bucket has at the same offset. One block of suffix buckets."""
    m = len(bucket)
    bytes_of, length = np.zeros((m, CONTEXT + STEP), np.uint8), np.fromiter(map(len, context), np.int64, m)
    for i, (c, at) in enumerate(zip(context, SPAN - left, strict=True)):
        bytes_of[i, at : at + len(c)] = np.frombuffer(c, np.uint8)
    begin, end = SPAN - left, SPAN - left + length
    flags, rank, ranked = np.zeros((m, SPAN + 1), bool), None, -1
    name = bucket.astype(np.uint64).view(np.uint8).reshape(m, 8)
    for o in range(SPAN + 1):
        rows = np.flatnonzero((begin <= o) & (o + WINDOW <= end) & (first <= o) & (o <= last))
        if len(rows) < 2:
            continue
        s = -(-o // STEP) * STEP
        if ranked != s:  # rank of the cover sample: of the bucket's name and the long string from s on
            block = np.ascontiguousarray(np.concatenate([name, bytes_of[:, s : s + WINDOW - STEP]], axis=1))
            rank, ranked = np.unique(block.view(f"V{block.shape[1]}").ravel(), return_inverse=True)[1].ravel(), s
        ends = np.ascontiguousarray(np.concatenate([bytes_of[rows, o:s], bytes_of[rows, s + WINDOW - STEP : o + WINDOW]], axis=1))
        short, long = ends.view(np.uint64).ravel(), rank[rows]
        order = np.lexsort((short, long))
        same = (short[order][1:] == short[order][:-1]) & (long[order][1:] == long[order][:-1])
        hit = np.zeros(len(rows), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        flags[rows[hit], o] = True
    return flags


def _positions(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        out: list[list[np.ndarray]] = [[], [], []]
        counts = []
        for text in batch.column("text").to_pylist():
            got = cover_sample(text.encode("utf-8", "surrogatepass"))
            counts.append(len(got[0]))
            for store, values in zip(out, got, strict=True):
                store.append(values)
        at, gram, context = (np.concatenate(x) for x in out)
        repeat = lambda c: np.repeat(batch.column(c).to_numpy(), counts)
        return {"rid": repeat("rid"), "tkey": repeat("tkey"), "at": at.astype(np.int32), "gram": gram.view(np.int64), "ctx": context.view(np.int64)}

    return map_batches(docs, run, "rid long, tkey long, at int, gram long, ctx long")


def _contexts(docs: DataFrame, info: DataFrame) -> DataFrame:
    """The bytes of the contexts to compare, one of each kind."""
    schema = "gram long, rid long, tkey long, at int, whole boolean, n_ctx long, left int, context binary"

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("gram", "rid", "tkey", "at", "whole", "n_ctx", "left", "context")}
        for rid, tkey, text, sends in zip(*(batch.column(c).to_pylist() for c in ("rid", "tkey", "text", "sends")), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for s in sends:
                left = min(SPAN, s["at"])
                row = (s["gram"], rid, tkey, s["at"], s["whole"], s["n_ctx"], left, data[s["at"] - left : s["at"] + WINDOW])
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
        return out

    return map_batches(docs.join(info.where(F.size("sends") > 0).select("rid", "tkey", "sends"), ["rid", "tkey"]), run, schema)


_MARKS = "rid long, tkey long, at int, bits binary"


def _sorted_buckets(contexts: DataFrame, block: int) -> DataFrame:
    """Windows found by sorting: buckets arrive together and whole, and are sorted a block at a time."""
    arrow = to_arrow_schema(StructType.fromDDL(_MARKS))

    def settle(rows: pa.Table) -> pa.RecordBatch | None:
        left, first, last = (rows.column(c).to_numpy().astype(np.int64) for c in ("left", "first", "last"))
        flags = repeated_windows(rows.column("bucket").to_numpy(), rows.column("context").to_pylist(), left, first, last)
        hit = np.flatnonzero(flags.any(1) & ~rows.column("whole").to_numpy(zero_copy_only=False))
        if not len(hit):
            return None
        chosen, bits = rows.take(hit), np.packbits(flags[hit], axis=1)
        return record_batch({c: chosen.column(c).combine_chunks() for c in ("rid", "tkey", "at")} | {"bits": [b.tobytes() for b in bits]}, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block:
                rows = pa.Table.from_batches(held)
                bucket = rows.column("bucket").to_numpy()
                cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                if cut:
                    if (out := settle(rows.slice(0, cut))) is not None:
                        yield out
                    held, n = rows.slice(cut).to_batches(), len(rows) - cut
        if n and (out := settle(pa.Table.from_batches(held))) is not None:
            yield out

    spark = contexts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, _MARKS)


_BUCKETS = "bucket long, first int, last int, rid long, tkey long, at int, whole boolean, left int, context binary"


def _halved(large: DataFrame) -> DataFrame:
    """Each context in the buckets of the two halves of its bucket's windows, by the bytes that all windows of a half
    share; a context without these bytes has no window there."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("bucket", "first", "last", "rid", "tkey", "at", "whole", "left", "context")}
        for bucket, first, last, rid, tkey, at, whole, left, context in zip(*(batch.column(c).to_pylist() for c in out), strict=True):
            middle, begin = (first + last) // 2, SPAN - left
            for a, b in ((first, middle), (middle + 1, last)):
                if begin <= b and a + WINDOW <= begin + len(context):
                    name = xxhash.xxh3_64_intdigest(context[b - begin : a + WINDOW - begin], seed=(bucket + 1000 * a + b) & 0xFFFFFFFFFFFFFFFF) - (1 << 63)
                    for column, value in zip(out.values(), (name, a, b, rid, tkey, at, whole, left, context), strict=True):
                        column.append(value)
        return out

    return map_batches(large, run, _BUCKETS)


def _equal_windows(same: DataFrame) -> DataFrame:
    """Marks of contexts whose bucket has one window, which they all share."""

    def run(batch: pa.RecordBatch) -> dict:
        flags = np.zeros((batch.num_rows, SPAN + 1), bool)
        flags[np.arange(batch.num_rows), batch.column("first").to_numpy()] = True
        return {c: batch.column(c) for c in ("rid", "tkey", "at")} | {"bits": [b.tobytes() for b in np.packbits(flags, axis=1)]}

    return map_batches(same.where("not whole").select("rid", "tkey", "at", "first"), run, _MARKS)


def _bucket_marks(contexts: DataFrame, hot: int, block: int) -> list[Staged]:
    """Repeated windows of all buckets; those of more than ``hot`` contexts are halved first, at most eight times."""
    whole_range = contexts.withColumns({"bucket": F.col("gram"), "first": F.lit(0), "last": F.lit(SPAN)})
    marks, large = [Staged(_sorted_buckets(whole_range.where(F.col("n_ctx") <= hot), block), "cover-marks")], whole_range.where(F.col("n_ctx") > hot)
    while not large.isEmpty():
        parts = Staged(_halved(large), "cover-halves")
        sizes = parts.df.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        sized = Staged(parts.df.join(sizes, "bucket"), "cover-sized")
        parts.drop()
        marks.append(Staged(_equal_windows(sized.df.where("first = last")), "cover-marks"))
        marks.append(Staged(_sorted_buckets(sized.df.where((F.col("first") < F.col("last")) & (F.col("n") <= hot)), block), "cover-marks"))
        large = sized.df.where((F.col("first") < F.col("last")) & (F.col("n") > hot))
    return marks


def kept_bytes(data: bytes, whole: list[int], parts: list[tuple[int, bytes]]) -> tuple[bytes, int, int]:
    """The bytes left, the number removed and of runs removed, from positions whose windows all repeat and
    flags of single windows."""
    n = len(data)
    steps = np.zeros(n + 1, np.int64)
    for at in whole:
        steps[max(0, at - SPAN)] += 1
        steps[min(at, n - WINDOW) + WINDOW] -= 1
    for at, bits in parts:
        p = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=SPAN + 1)) + at - SPAN
        np.add.at(steps, p, 1)
        np.add.at(steps, p + WINDOW, -1)
    gone = np.cumsum(steps[:n]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept binary for every row of ``df``."""
    docs = texts(df, id_col, text_col).withColumn("rid", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("tkey", F.xxhash64("text"))
    found = Staged(_positions(docs.select("rid", "tkey", "text")), "cover-sample")
    seen = found.df.withColumn("name", F.xxhash64("rid", "tkey", "at"))
    kinds = Staged(seen.groupBy("gram", "ctx").agg(F.count("*").alias("n"), F.min("name").alias("chosen")), "cover-kinds")
    grams = kinds.df.groupBy("gram").agg(F.sum("n").alias("n_gram"), F.count("*").alias("n_ctx")).where("n_gram > 1").select("gram", "n_ctx")
    kinds2 = Staged(kinds.df.join(grams, "gram"), "cover-shared")
    kinds.drop()
    marked = seen.join(kinds2.df, ["gram", "ctx"]).withColumn("whole", F.col("n") > 1)
    sends = F.when((F.col("name") == F.col("chosen")) & (F.col("n_ctx") > 1), F.struct("at", "gram", "whole", "n_ctx"))
    info = Staged(marked.groupBy("rid", "tkey").agg(F.collect_set(F.when(F.col("whole"), F.col("at"))).alias("whole"), F.collect_list(sends).alias("sends")), "cover-info")
    found.drop(), kinds2.drop()
    contexts = Staged(_contexts(docs.select("rid", "tkey", "text"), info.df), "cover-contexts")
    found_marks = _bucket_marks(contexts.df, hot, block)
    marks = found_marks[0].df
    for more in found_marks[1:]:
        marks = marks.unionByName(more.df)
    per_doc = marks.groupBy("rid", "tkey").agg(F.collect_set(F.struct("at", "bits")).alias("parts"))
    known = Staged(info.df.select("rid", "tkey", "whole").join(per_doc, ["rid", "tkey"], "left"), "cover-known")
    contexts.drop(), info.drop()

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept")}
        for text, whole, parts in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "parts")), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            kept, removed, spans = kept_bytes(data, whole or [], [(p["at"], p["bits"]) for p in parts or []]) if whole or parts else (data, 0, 0)
            for column, value in zip(out.values(), (len(data), removed, spans, kept), strict=True):
                column.append(value)
        return {"doc_id": batch.column("doc_id")} | out

    joined = docs.join(known.df, ["rid", "tkey"], "left").select("doc_id", "text", "whole", "parts")
    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


