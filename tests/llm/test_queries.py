"""The registered queries on whole small tables, held against plain versions of what they must return."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from docloom.llm import bpe, ordermin, queries
from tests.llm.test_llm import plain_trigram
from tests.llm.test_pipeline import plain_classes

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    rows = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    return {r["doc_id"]: r["text"] or "" for r in rows}


def run(spark, name, sf=SF):
    df = queries.QUERIES[name](spark, sf)
    return {r.doc_id: r for r in df.collect()}, dict(df.dtypes)


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(spark, docs):
    got, types = run(spark, "op1_media_chunks")
    assert [types[c] for c in ("n_bytes", "payload_bytes", "tail_crc32", "media_bytes")] == ["bigint"] * 4
    media = {}
    for i, text in docs.items():
        raw = text.encode()
        data = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(data), sha(data), zlib.crc32(data[-16:]))
        assert media.setdefault(text, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)
    assert len(got) == len(docs)


def test_op3(spark, docs):
    got, _ = run(spark, "op3_byte_bpe")
    enc = bpe.load_encoding(public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN)
    for i, text in docs.items():
        ids = enc.encode_ordinary(text)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(text.encode()))
    assert len(got) == len(docs)


def test_op4(spark, docs):
    got, types = run(spark, "op4_order_minhash")
    assert types["n_chars"] == "bigint" and types["near_edited"] == types["near_next"] == "double"
    ids = sorted(docs, reverse=True)
    hexed = lambda x: x.astype(">u4").tobytes().hex()
    for k, i in enumerate(ids):
        text, after = docs[i], docs[ids[(k + 1) % len(ids)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, other, changed = (ordermin.fingerprint(t) for t in (text, after, edited))
        want = (len(text), sha(edited.encode()), hexed(own), hexed(changed), (own == changed).mean(), (own == other).mean())
        assert (got[i].n_chars, got[i].edited_sha256, got[i].fingerprint, got[i].edited_fingerprint, got[i].near_edited, got[i].near_next) == want
    assert len(got) == len(docs)


def test_op5(spark, docs):
    got, _ = run(spark, "op5_dart_minhash")
    ids = list(docs)
    assert {i: r.class_id for i, r in got.items()} == {i: ids[c] for i, c in zip(ids, plain_classes(list(docs.values())), strict=True)}


@pytest.mark.parametrize("name, label, modulus, held, limit, least", [("op6_toxicity", "toxic", 5, 0, 0.5, 0.95), ("op10_quality", "quality", 4, 2, 0.7, 0.9)])
def test_classifiers(spark, name, label, modulus, held, limit, least):
    got, types = run(spark, name, LARGER)
    assert (types["held_out"], types["score"], types["predicted"]) == ("boolean", "double", "int")
    marks = {r["doc_id"]: r[label] for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    right = []
    for i, r in got.items():
        assert r.held_out == (remainder(i, modulus) == held) and 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
        if r.held_out and marks.get(i) is not None:
            right.append((r.score >= 0.5) == marks[i])
    assert len(right) > 40 and np.mean(right) >= least and len(got) == pq.read_metadata(f"{LARGER}/documents.parquet").num_rows


def test_op7(spark, docs):
    got, types = run(spark, "op7_elias_fano_lm")
    assert [types[c] for c in ("n_tokens", "n_known", "train_tokens", "score")] == ["bigint"] * 3 + ["double"]
    split = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t)) if w] + [None] for i, t in docs.items()}
    counts = Counter(w for i, s in split.items() if remainder(i, 10) for w in s)
    total, base = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    ids = list(docs)
    assert ids == list(range(len(ids)))
    for i, (score, n) in enumerate(plain_trigram(list(docs.values()))):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i, 10) == 0, n, sum(counts[w] > 0 for w in split[i]), total)
        assert abs(r.base_score - sum(np.log10((counts[w] + 0.1) / base) for w in split[i])) < 1e-6 and abs(r.score - score) < 1e-3 * n


def test_op8(spark, docs):
    got, types = run(spark, "op8_pii")
    digits = lambda t: re.sub("[^0-9]", "", t)
    luhn = lambda d: sum(int(c) if k % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for k, c in enumerate(reversed(d))) % 10 == 0
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 16 <= len(digits(t)) <= 19 and luhn(digits(t))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 8 <= len(digits(t)) <= 15),
    )
    assert all(types[f"n_{k}"] == "bigint" for k, _, _ in kinds)
    for i, text in docs.items():
        spans = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text) if ok(m[0])] for k, p, ok in kinds]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(s) for s in spans]
        base = [x for s in spans for x in s]
        assert r.base_sha256 == sha(",".join(base).encode()) and set(base) <= set(r.spans.split(",") if r.spans else [])
    assert len(got) == len(docs)


def test_op9(spark, docs):
    got, _ = run(spark, "op9_suffix_dedup")
    raw = {i: t.encode() for i, t in docs.items()}
    seen = Counter(hash(b[p : p + 200]) for b in raw.values() for p in range(len(b) - 199))
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if seen[hash(b[p : p + 200])] > 1:
                gone[p : p + 200] = True
        spans = int(np.diff(np.r_[0, gone.astype(int), 0]).clip(0).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))
    assert len(got) == len(docs)
