"""Byte-level BPE with the tiktoken library and a local rank file.

The pre-splitting pattern never lets a match run from a character that is not white space into white
space, so a text may be cut between a letter or digit and a following blank or line end: each part
gives the ids it gives within the whole. Long texts are encoded in such parts. A very long run of
white space, on which a backtracking pattern would fail, is one match (without its last character if
more text follows) and goes to the merges directly.

Defined results: a null or empty text has no ids; decoding joins the raw bytes of the ids, so it
gives back the text's UTF-8 exactly; a null id is carried through, repeated rows give repeated results, an empty
table gives no rows and other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import map_batches, texts

PART, LONG_RUN = 1 << 16, 4096
#: Texts that a task holds as Python values at once.
ROWS = 256
_SAFE = re.compile(r"[^\W_](?=[\x20\n])")
#: White space as the encoder's pattern has it.
_RUN = re.compile(rf"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def load_encoding(rank_file: str, pattern: str):
    """The encoder of a rank file; each worker process builds it once."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, part: int = PART) -> list[str]:
    """The text cut at safe places, about every ``part`` characters."""
    parts, start = [], 0
    while len(text) - start > part and (m := _SAFE.search(text, start + part - 1)):
        parts.append(text[start : m.end()])
        start = m.end()
    return [*parts, text[start:]]


def encode(encoding, text: str, part: int = PART) -> np.ndarray:
    """The ids of a text as unsigned 32-bit integers."""
    ids: list[int] = []
    start = 0
    for m in _RUN.finditer(text) if len(text) >= LONG_RUN else ():
        for piece in safe_parts(text[start : m.start()], part):
            ids += encoding.encode_ordinary(piece)
        start = m.end() if m.end() == len(text) else m.end() - 1
        ids += encoding._encode_single_piece(text[m.start() : start].encode())
    for piece in safe_parts(text[start:], part):
        ids += encoding.encode_ordinary(piece)
    return np.array(ids, dtype="<u4")


def decode(encoding, ids: np.ndarray) -> bytes:
    return encoding.decode_bytes(ids.tolist())


def tokenise(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids binary (little-endian unsigned 32-bit): the encoded corpus. No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        encoding = load_encoding(rank_file, pattern)
        return {"doc_id": batch.column("doc_id"), "ids": [encode(encoding, t).tobytes() for t in batch.column("text").to_pylist()]}

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, ids binary", ROWS)


def detokenise(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded binary from ``tokenise``'s rows. No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        encoding = load_encoding(rank_file, pattern)
        blobs = batch.column("ids").to_pylist()
        decoded = [decode(encoding, np.frombuffer(b, "<u4")) for b in blobs]
        return {"doc_id": batch.column("doc_id"), "n_tokens": [len(b) // 4 for b in blobs], "ids_sha256": [hashlib.sha256(b).hexdigest() for b in blobs], "decoded": decoded}

    return map_batches(df, run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary", ROWS)


def round_trip(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``detokenise`` of ``tokenise`` gives, by one pass with one encoder a task. No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        encoding = load_encoding(rank_file, pattern)
        ids = [encode(encoding, t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n_tokens": [len(x) for x in ids], "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids], "decoded": [decode(encoding, x) for x in ids]}

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary", ROWS)
