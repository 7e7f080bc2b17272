"""The registered classifiers against plain versions: features, choice, fit and score by loops and dense matrices."""

import itertools
import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from docloom.llm import eliasfano, ngram_lm, quality, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def marks(label, modulus, held):
    """Labelled ids that train, in the order in which the sample takes them."""
    rows = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    return {r["doc_id"]: r[label] for r in rows if r[label] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % modulus != held}


def plain_features(text):
    words = set(toxicity._WORD.findall(text.lower()))
    return words | {"^" + w[:k] for w in words for k in range(3, 9) if len(w) > k}


def plain_toxicity(docs):
    """Scores of logistic regression by dense Adam over the features that pass the test; no text here names a group."""
    labels = {i: y for i, y in marks("toxic", 5, 0).items() if i in docs}
    held = {i: plain_features(docs[i]) for i in sorted(labels)}
    assert not any(toxicity.counterfactuals(toxicity.words_of(docs[i]), 2) for i in labels)
    pos, neg, chi = sum(labels.values()), len(labels) - sum(labels.values()), {}
    counts = {}
    for i, found in held.items():
        for f in found:
            counts.setdefault(f, [0, 0])[labels[i]] += 1
    for f, (n, p) in counts.items():
        there, n_all = n + p, float(pos + neg)
        under = there * (n_all - there) * float(pos) * float(neg)
        if there >= 3 and under:
            chi[f] = n_all * (p * (neg - n) - n * (pos - p)) ** 2 / under
    names = sorted((f for f in chi if chi[f] >= 12.0), key=lambda f: (-chi[f], f))[:4096]
    y = np.array([float(labels[i]) for i in held])
    x = np.array([[f in found for f in names] for found in held.values()], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    theta, m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    x1 = np.hstack([x, np.ones((len(y), 1))])
    for t in range(1, 401):
        g = x1.T @ (weight * (1 / (1 + np.exp(-(x1 @ theta))) - y))
        g[:-1] += 2e-5 * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {i: 1 / (1 + math.exp(-(theta[-1] + sum(w for f, w in zip(names, theta) if f in plain_features(text))))) for i, text in docs.items()}


def test_op6_equals_plain(spark, docs):
    got = {r.doc_id: r.score for r in queries.QUERIES["op6_toxicity"](spark, SF).collect()}
    want = plain_toxicity(docs)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-6


def plain_statistics(text):
    """The values of ``FEATURES`` by their names, each counted on its own."""
    raw = text.encode()
    if not raw:
        return [0.0] * len(quality.FEATURES)
    kinds = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "blank": b" \t", "line_end": b"\n\r", "sentence": b".,;:?-", "bracket": b"()[]{}\"'`", "symbol": b"!#$%&*+/<=>@\\^_|~", "beyond_ascii": bytes(range(128, 256))}
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n, k = max(1, len(words)), max(1, len(lines))
    lengths = [len(w) for w in words] or [0]
    mean = sum(lengths) / len(lengths)
    plain = [w for w in words if w.isalnum()]
    mixed = [w for w in words if not w.isalnum() and any(c.isalnum() for c in w)]
    bare = [w.rstrip(".,;:?") for w in mixed]
    shout = lambda w: w.isupper() and len(w) > 1
    value = {
        "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(len(words)), "word_length": mean, "word_spread": math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths)),
        "unique_words": len(set(words)) / n, "top_word": max((words.count(w) for w in set(words)), default=0) / n, "short_words": sum(x <= 3 for x in lengths) / n,
        "capital_words": sum(w[0].isupper() and not shout(w) for w in plain) / n, "upper_words": (sum(map(shout, plain)) + sum(map(shout, bare))) / n, "symbol_words": sum(not w.isalnum() for w in bare) / n,
        "lone_symbols": sum(not any(c.isalnum() for c in w) for w in words) / n, "log_lines": math.log1p(len(lines)), "line_length": len(text) / k, "repeated_lines": 1 - len(set(lines)) / k,
        "ended_lines": sum(x[-1] in ".!?:" for x in lines) / k, "top_symbol": max(raw.count(c) for c in kinds["symbol"]) / len(raw),
    } | {name: sum(raw.count(c) for c in chars) / len(raw) for name, chars in kinds.items()}
    packer = zlib.compressobj(1)
    value["compressed"] = (len(packer.compress(raw)) + len(packer.flush())) / len(raw)
    return [value[f] for f in quality.FEATURES]


def plain_trees(x, y, trees=80, depth=4, rate=0.15, bins=64):
    """Boosting by recursion over lists of rows: a tree is (feature, threshold, left, right) or a leaf's value."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    base = math.log((y.sum() + 0.5) / (len(y) + 1) / (1 - (y.sum() + 0.5) / (len(y) + 1)))
    score, out = np.full(len(y), base), []

    def grow(rows, level):
        if level == depth:
            return -rate * sum(g[rows].tolist()) / (sum(h[rows].tolist()) + 1)
        best = (1e-9, None, None)
        for j in range(x.shape[1]):
            # Sums over rows by bin, then over bins, in order: of equal gains the first one counts.
            by_bin = [[0.0, 0.0, 0] for _ in range(bins)]
            for r, k in zip(rows.tolist(), np.searchsorted(edges[j], x[rows, j], side="left").tolist()):
                by_bin[k] = [by_bin[k][0] + g[r], by_bin[k][1] + h[r], by_bin[k][2] + 1]
            upto = list(itertools.accumulate(by_bin, lambda a, b: [a[0] + b[0], a[1] + b[1], a[2] + b[2]]))
            gs, hs, n = upto[-1]
            for k, e in enumerate(edges[j]):
                gl, hl, nl = upto[k]
                if 4 <= nl <= n - 4:
                    gain = gl * gl / (hl + 1) + (gs - gl) * (gs - gl) / (hs - hl + 1) - gs * gs / (hs + 1)
                    if gain > best[0]:
                        best = (gain, j, e)
        if best[1] is None:
            return grow(rows, level + 1)
        left = x[rows, best[1]] <= best[2]
        return best[1], best[2], grow(rows[left], level + 1), grow(rows[~left], level + 1)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        out.append(grow(np.arange(len(y)), 0))
        score = score + [value(out[-1], r) for r in x]
    return lambda row: 1 / (1 + math.exp(-(base + sum(value(t, row) for t in out))))


def test_op10_equals_plain(spark, docs):
    labels = {i: y for i, y in sorted(marks("quality", 4, 2).items()) if i in docs}
    stats = {i: plain_statistics(t) for i, t in docs.items()}
    for i, t in docs.items():
        assert np.allclose(stats[i], quality.statistics(t), rtol=1e-9, atol=1e-12), i
    exact = {i: quality.statistics(t) for i, t in docs.items()}
    model = plain_trees(np.array([exact[i] for i in labels]), np.array([float(y) for y in labels.values()]))
    got = {r.doc_id: r.score for r in queries.QUERIES["op10_quality"](spark, SF).collect()}
    off = [abs(got[i] - model(exact[i])) for i in docs]
    # Splits whose gains are equal but for rounding may fall either way; they part no training rows and few others.
    assert got.keys() == docs.keys() and max(off) < 0.02 and np.mean(np.array(off) < 1e-6) > 0.9, sorted(off)[-5:]
    assert max(off[k] for k, i in enumerate(docs) if i in labels) < 1e-9


def test_messages_name_their_own_blocks():
    """What a shard of words sends on grows with tokens, not with blocks times shards."""
    rng, none = np.random.default_rng(2), np.zeros(0, np.uint64)
    vocabulary = ngram_lm.Vocabulary(4000, 500, 10, 0.5, none, none.astype(np.int64))
    names = rng.integers(ngram_lm.SPAN, 1 << 40, 500).astype(np.uint64)

    def named(blocks, others, tokens=4000):
        each, payloads = tokens // blocks, []
        for _ in range(blocks):
            w = np.sort(rng.choice(names, each))
            payloads.append(ngram_lm._pack(*ngram_lm._tokens(w, rng.choice(names, each), rng.choice(names, each)), np.zeros(each, np.uint16)))
        _, sent = ngram_lm.score_words(payloads, np.arange(blocks, dtype=np.int64) << 32, vocabulary, others, 1.0, 1.0)
        held = [ngram_lm._unpack(p) for _, p in sent]
        assert all(len(p[9]) == len(np.unique(p[8])) and len(p[8]) == len(p[6]) for p in held)
        return sum(len(p[9]) for p in held)

    assert named(200, 400) <= 4000 and named(50, 10) <= 500


def test_sorting_by_packed_codes():
    """Orders, distinct codes and numbers of names equal numpy's, for small codes, names of both kinds and none."""
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 3000):
        for top in (3, 1 << 20, 1 << 62):
            code = rng.integers(0, top, n)
            assert all(np.array_equal(a, b) for a, b in zip(np.unique(code, return_index=True, return_inverse=True), ngram_lm._unique(code)))
            assert np.array_equal(ngram_lm._order(code), np.argsort(code, kind="stable"))
        names = np.where(rng.random(n) < 0.7, rng.integers(0, ngram_lm.SPAN, n), rng.integers(ngram_lm.SPAN, 1 << 62, n)).astype(np.uint64)
        assert all(np.array_equal(a, b) for a, b in zip(np.unique(names, return_inverse=True), ngram_lm._number(names)))
        key, rows = rng.integers(0, 7, n).astype(np.uint64), np.flatnonzero(rng.random(n) < 0.8)
        made = list(ngram_lm._grouped(key, names, rows))
        assert [i for _, part in made for i in part] == list(rows[np.lexsort((names[rows], key[rows]))]) and [k for k, _ in made] == sorted(set(key[rows].tolist()))


def test_coded_sequences():
    """Access and search of coded sequences, dense, sparse, short and with repeats."""
    rng = np.random.default_rng(0)
    for n, top in ((0, 5), (1, 1), (1, 10**9), (1000, 1001), (5000, 10**7), (3000, 50), (20_000, 21_000), (20_000, 1 << 40)):
        values = np.sort(rng.integers(0, top, n))
        assert np.array_equal(eliasfano.EliasFano(values, top).access(np.arange(n)).astype(np.int64), values)
        values, asked = np.unique(values), rng.integers(0, top, 2000)
        found = eliasfano.EliasFano(values, top).find(asked.astype(np.uint64), np.zeros(2000, np.int64), np.full(2000, len(values)))
        assert np.array_equal(found, np.where(np.isin(asked, values), np.searchsorted(values, asked), -1))
