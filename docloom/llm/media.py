"""Media payloads in a content-defined chunk store.

A payload is cut where a rolling gear hash of its last 32 bytes has its top bits clear, so equal passages
give equal chunks wherever they stand. Chunk digests meet in a Spark join: the first occurrence of a digest
owns it, every other one is a reference. The store is a table of packs, one for each different payload,
with the ordered chunk list (the recipe) and the bytes of the chunks that it owns; each chunk's bytes are in
it once. Reading back fetches referenced chunks by digest, checks every digest and joins the chunks in order.

The medium of one payload is its pack as stored: the recipe and, after it, the compressed bytes of the chunks that
the pack owns. ``media_bytes`` and ``media_sha256`` are of these bytes as they are read.

A chunk that very many payloads share is one key of the joins by digest; there the side of the references is split by
the adaptive skew join, and only that chunk's bytes are copied to the parts.

Defined results: a null or empty text is a payload of blanks; equal texts share one pack; a payload may own a
chunk and refer to it again; a null id is carried through and repeated rows give repeated results; very long texts are
cut and hashed a block at a time; an empty table gives no rows; other columns are not looked at. A missing or damaged
chunk is an error, never a shorter payload.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import map_batches, texts
from docloom.session import Staged

UNIT = 192
MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 256, 10, 16384
LEVEL = 9
_WINDOW = 32
_GEAR = np.random.default_rng(77).integers(0, 1 << 32, 256, np.uint32)
_BLOCK = 1 << 20


def padded(text: str) -> tuple[int, bytes]:
    """The unpadded length and the payload: UTF-8, then blanks up to a positive multiple of ``UNIT``."""
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (-len(raw) % UNIT if raw else UNIT)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = h[i-1] * 2 + gear[data[i]] in 32 bits, by doubling the window five times."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks; a cut needs ``MEAN_BITS`` clear top bits, ``MIN_CHUNK`` and ``MAX_CHUNK`` bound the size."""
    view, marks = np.frombuffer(data, np.uint8), []
    for start in range(0, len(view), _BLOCK):
        lead = min(start, _WINDOW)
        h = gear_hash(view[start - lead : start + _BLOCK])[lead:]
        marks.append(np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + start + 1)
    ends, last = [], 0
    for mark in np.concatenate(marks).tolist() if marks else []:
        while mark - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if mark - last >= MIN_CHUNK and len(data) - mark >= 1:
            ends.append(mark)
            last = mark
    while len(data) - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    return [*ends, len(data)]


def chunks_of(data: bytes) -> list[bytes]:
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def feature(samples: np.ndarray, n_chunks: int) -> str:
    """Number of chunks, mean, deviation, crossings of the mean and eight amplitude shares of 8-bit samples."""
    x = samples.astype(np.int64)
    total, n = int(x.sum()), len(x)
    above = x * n > total
    crossings = int((above[1:] != above[:-1]).sum())
    bands = np.bincount(samples >> 5, minlength=8)
    return f"chunks={n_chunks};mean={total / n:.4f};std={x.std():.4f};crossings={crossings};bands=" + ",".join(map(str, bands.tolist()))


def _payloads(docs: DataFrame, with_bytes: bool) -> DataFrame:
    """pid (digest of the payload), n_bytes, recipe and, if asked for, the compressed payload."""

    def run(batch: pa.RecordBatch) -> dict:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        out: dict[str, list] = {"pid": [], "n_bytes": [], "recipe": [], "payload": []}
        for text in batch.column("text").to_pylist():
            n, data = padded(text)
            out["pid"].append(hashlib.sha256(data).digest()[:16] + n.to_bytes(8, "big"))
            out["n_bytes"].append(n)
            out["recipe"].append(b"".join(hashlib.sha256(c).digest() + struct.pack("<I", len(c)) for c in chunks_of(data)))
            out["payload"].append(pack(data) if with_bytes else None)
        return out | {"doc_id": batch.column("doc_id")}

    return map_batches(docs, run, "doc_id long, pid binary, n_bytes long, recipe binary" + (", payload binary" if with_bytes else ""))


def _listed(recipes: DataFrame) -> DataFrame:
    """(pid, place, digest) of every chunk, the recipe taken apart in SQL."""
    places = F.sequence(F.lit(0), (F.length("recipe") / 36).cast("int") - 1)
    at = F.explode(places).alias("place")
    return recipes.select("pid", "recipe", at).select("pid", "place", F.substring(F.col("recipe"), F.col("place") * 36 + 1, F.lit(32)).alias("digest"))


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Staged, Staged]:
    """Write the chunk store; returns the index (doc_id, pid) and the packs."""
    docs = texts(df, id_col, text_col)
    recipes = Staged(_payloads(docs, False), "media-recipes")
    listed = _listed(recipes.df.select("pid", "recipe"))
    owned = listed.groupBy("digest").agg(F.min(F.struct("pid", "place")).alias("owner"), F.max(F.struct("pid", "place")).alias("last"))
    owned = owned.where("owner <> last")  # a chunk that stands at one place of one payload is its own
    marks = listed.join(owned.select("digest", "owner"), "digest").withColumn("owns", F.struct("pid", "place") == F.col("owner"))
    pick = lambda cond: F.sort_array(F.collect_set(F.when(cond, F.col("place"))))
    marks = marks.groupBy("pid").agg(pick(F.col("owns")).alias("lent"), pick(~F.col("owns")).alias("borrowed"))
    marks = Staged(marks, "media-marks")
    each = _payloads(docs, True).groupBy("pid").agg(F.first("n_bytes").alias("n_bytes"), F.first("recipe").alias("recipe"), F.first("payload").alias("payload"))
    joined = each.join(marks.df, "pid", "left").select("pid", "n_bytes", "recipe", "payload", *(F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("lent", "borrowed")))

    def keep_owned(batch: pa.RecordBatch) -> dict:
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress
        rows = {c: batch.column(c).to_pylist() for c in ("recipe", "payload", "borrowed")}
        own = []
        for recipe, payload, borrowed in zip(*rows.values(), strict=True):
            if borrowed:
                data, without = unpack(payload), set(borrowed)
                payload = pack(b"".join(c for k, c in enumerate(_split(recipe, data)) if k not in without))
            own.append(payload)
        return {c: batch.column(c) for c in ("pid", "n_bytes", "recipe", "lent", "borrowed")} | {"own": own}

    packs = Staged(map_batches(joined, keep_owned, "pid binary, n_bytes long, recipe binary, lent array<int>, borrowed array<int>, own binary"), "media-packs")
    marks.drop()
    index = Staged(recipes.df.select("doc_id", "pid"), "media-index")
    recipes.drop()
    return index, packs


def _lengths(recipe: bytes) -> list[int]:
    return [n for (n,) in struct.iter_unpack("<32xI", recipe)]


def _split(recipe: bytes, data: bytes, without: frozenset | set = frozenset()) -> list[bytes]:
    """The chunks of a recipe that are not left out, from their joined bytes."""
    out, at = [], 0
    for k, n in enumerate(_lengths(recipe)):
        if k not in without:
            out.append(data[at : at + n])
            at += n
    return out


def rebuild(recipe: bytes, own: bytes, borrowed: dict[int, bytes]) -> bytes:
    """The payload from its own and borrowed chunks; every chunk is held against its digest."""
    mine, parts = iter(_split(recipe, own, borrowed.keys())), []
    for k in range(len(recipe) // 36):
        chunk = borrowed[k] if k in borrowed else next(mine)
        if hashlib.sha256(chunk).digest() != recipe[36 * k : 36 * k + 32]:
            raise ValueError(f"chunk {k} does not have its digest")
        parts.append(chunk)
    return b"".join(parts)


def read_back(packs: DataFrame) -> DataFrame:
    """Rebuild and verify each payload: pid, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature, n_chunks, n_borrowed. Only packs that borrow, and lent chunks, are shuffled."""

    def lend(batch: pa.RecordBatch) -> dict:
        unpack, digests, chunks = zstandard.ZstdDecompressor().decompress, [], []
        for recipe, own, lent, borrowed in zip(*(batch.column(c).to_pylist() for c in ("recipe", "own", "lent", "borrowed")), strict=True):
            without = set(borrowed)
            held = dict(zip((k for k in range(len(recipe) // 36) if k not in without), _split(recipe, unpack(own), without), strict=True))
            digests += [recipe[36 * k : 36 * k + 32] for k in lent]
            chunks += [zlib.compress(held[k], 6) for k in lent]
        return {"digest": digests, "chunk": chunks}

    lent = map_batches(packs.where(F.size("lent") > 0).select("recipe", "own", "lent", "borrowed"), lend, "digest binary, chunk binary")
    borrowing = packs.where(F.size("borrowed") > 0)
    wanted = borrowing.select("pid", "recipe", F.explode("borrowed").alias("place")).select("pid", "place", F.substring(F.col("recipe"), F.col("place") * 36 + 1, F.lit(32)).alias("digest"))
    fetched = wanted.join(lent, "digest").groupBy("pid").agg(F.collect_list(F.struct("place", "chunk")).alias("got"))
    columns = ["pid", "n_bytes", "recipe", "own", F.size("borrowed").alias("n_borrowed")]
    nothing = F.array().cast("array<struct<place:int,chunk:binary>>").alias("got")
    rows = packs.where(F.size("borrowed") == 0).select(*columns, nothing).unionByName(borrowing.select(*columns).join(fetched, "pid", "left").withColumn("got", F.coalesce("got", nothing)))

    def run(batch: pa.RecordBatch) -> dict:
        unpack = zstandard.ZstdDecompressor().decompress
        out: dict[str, list] = {c: [] for c in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_chunks")}
        for recipe, own, got in zip(*(batch.column(c).to_pylist() for c in ("recipe", "own", "got")), strict=True):
            payload = rebuild(recipe, unpack(own), {g["place"]: zlib.decompress(g["chunk"]) for g in got})
            medium = recipe + own
            n = len(recipe) // 36
            row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(medium), hashlib.sha256(medium).hexdigest(), feature(np.frombuffer(payload, np.uint8), n), n)
            for name, value in zip(out, row, strict=True):
                out[name].append(value)
        return out | {c: batch.column(c) for c in ("pid", "n_bytes", "n_borrowed")}

    return map_batches(rows, run, "pid binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks int, n_borrowed int")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every payload, read all of them back and return one row per row of ``df``."""
    index, packs = store(df, id_col, text_col)
    return index.df.join(read_back(packs.df), "pid").drop("pid")
