import hashlib
from array import array
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers

import corpus_pipeline
from docloom.llm import bpe, dartminhash, media, mixing, ngram_lm, ordermin, pii, quality, queries, suffixdedup, toxicity
from docloom.session import table

SF = "/root/testdata/sf0.001"
ENCODER = (public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN)
#: Names that operators use inside, as further columns of the input.
CLASHING = "doc text2 node label key keys center cells n hi lo a b j word block part score predicted class_id mix_tokens mix_domain budget copies supply spans kept chunk chunks ids decoded sha at".split()


def plain_classes(texts):
    """The least index of each text's class, by comparing all pairs."""
    sets = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in ((t or "").lower().split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            small, large = sorted((sum(sets[a].values()), sum(sets[b].values())))
            if sets[a] == sets[b] or (small >= 0.8 * large and (both := sum((sets[a] & sets[b]).values())) >= 0.8 * (small + large - both)):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def test_pipeline_against_plain_version(spark, monkeypatch):
    docs = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    model = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    docs = [r for r in docs if model.score(r["text"] or "") < corpus_pipeline.TOXIC_LIMIT]
    docs = [r for i, (r, c) in enumerate(zip(docs, plain_classes([r["text"] for r in docs]), strict=True)) if c == i]
    for r in docs:
        r["text"] = pii.redact(r["text"] or "", pii.find_spans(r["text"] or ""))
    monkeypatch.setattr(queries, "MIX_FRACTION", corpus_pipeline.MIX_SHARE)
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(docs))
    copies = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, copies FROM ({queries._mixing_sql()})").fetchall()}
    enc, want = bpe.load_encoding(*ENCODER), []
    for r in docs:
        ids = enc.encode_ordinary(r["text"])
        digest = hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        want += [(r["doc_id"], len(ids), digest, hashlib.sha256(r["text"].encode()).hexdigest())] * copies.get(r["doc_id"], 0)
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got) == sorted(want) and len(got) > 50


@pytest.fixture(scope="module")
def odd_rows(spark):
    """Rows with nulls in every column, repeated rows and ids, and columns whose names clash."""
    texts = [None, "", "a b", "same words here to see twice", "same words here to see twice", "mail a@b.de now " * 40, "é漢字 " * 60]
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "s", None, *["x"] * len(CLASHING)) for i, t in enumerate(texts)]
    rows += [rows[4], (None, "no id", None, None, None, *[None] * len(CLASHING)), (None, None, None, None, None, *[None] * len(CLASHING))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING))


OPERATORS = {
    "media": media.round_trip,
    "bpe": lambda df: bpe.detokenise(bpe.tokenise(df, *ENCODER), *ENCODER),
    "ordermin": lambda df: ordermin.compare_with_next(df, ranges=2),
    "dart": dartminhash.classes,
    "toxicity": lambda df: toxicity.score(df, toxicity.ToxicityModel({"same": 1.0}, 0.0)),
    "lm": lambda df: ngram_lm.score(df, shortlist=20),
    "pii": lambda df: pii.span_digest(pii.detect(df)),
    "suffix": suffixdedup.dedup,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, odd_rows, name):
    out = OPERATORS[name](odd_rows)
    assert len(out.collect()) == odd_rows.count()
    empty = OPERATORS[name](odd_rows.limit(0))
    assert empty.columns == out.columns and empty.collect() == []


def test_quality_on_odd_rows(spark, odd_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    assert quality.score(odd_rows, quality.train(odd_rows, labels)).count() == odd_rows.count()
    assert quality.score(odd_rows.limit(0), quality.train(odd_rows.limit(0), labels.limit(0))).count() == 0


def test_mixing_on_odd_rows(spark, odd_rows):
    taken = mixing.repeat_rows(mixing.select(odd_rows, queries.mix_levels(), queries.MIX_WEIGHTS, (1, 1), 2))
    assert taken.columns == odd_rows.columns and taken.count() > 0


def test_stages_on_odd_rows_and_empty_tables(spark, odd_rows, tmp_path):
    odd_rows.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_rows, odd_rows.limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
            if name in ("personal_data", "encoding"):
                assert out.count() == docs.count()
            else:
                assert out.count() <= 2 * docs.count()
