import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docloom.llm import bpe, dartminhash, eliasfano, media, mixing, ngram_lm, ordermin, pii, quality, suffixdedup, toxicity
from docloom.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, label string"


def frame(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, words=400):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) + ("" if k % words else ".") for k in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    base = prose(rng, 300)
    return [None, "", "one", "two words", base, base, base.replace("a", "b", 2), "é漢字 " * 90, prose(rng, 60_000), " " * 300, base[:700] + prose(rng, 80) + base[200:900]]


def test_pii_spans():
    text = "mail a.b@c.de ip 10.0.0.256 10.1.2.3 card 4111 1111 1111 1111 call +1 (555) 123-4567 iban GB82 WEST 1234 5698 7654 32"
    kinds = [s[0] for s in pii.find_spans(text)]
    assert kinds == ["email", "ip", "card", "phone", "iban"]
    assert "@" not in pii.redact(text, pii.find_spans(text))
    assert pii.find_spans("") == [] and pii.find_spans("@" * 50_000 + "1" * 50_000) == []


def test_bpe_parts_equal_whole():
    import public_tokenizers as P

    enc = bpe.load_encoding(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    rng = random.Random(1)
    text = "".join(rng.choice(["it's ", "Wörter\n", "  ", "\t", "12,3 ", "漢 ", "x" * 9]) for _ in range(4000)) + " " * 6000 + "end" + " " * 5000
    ids = bpe.encode(enc, text, 500)
    assert ids.tolist() == enc.encode_ordinary(text) and bpe.decode(enc, ids) == text.encode()
    assert len(bpe.encode(enc, "")) == 0


def test_media_round_trip(spark, odd):
    rows = {r.doc_id: r for r in media.round_trip(frame(spark, odd)).collect()}
    for i, t in enumerate(odd):
        raw = (t or "").encode()
        data = raw + b" " * (-len(raw) % 192 if raw else 192)
        assert (rows[i].n_bytes, rows[i].payload_sha256, rows[i].tail_crc32) == (len(raw), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]))
    assert rows[4].media_sha256 == rows[5].media_sha256 and sum(r.n_borrowed for r in rows.values()) > 0


def test_order_minhash(spark, odd):
    rows = {r.doc_id: r for r in ordermin.compare_with_next(frame(spark, odd), ranges=3).collect()}
    for i, t in enumerate(odd):
        want = ordermin.edited(t or "", odd[i - 1] or "")
        assert rows[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert rows[5].near_next == 1.0 and rows[4].fingerprint == rows[5].fingerprint and rows[6].near_next > 0.5


def test_dart_minhash_against_brute_force(spark, odd):
    rng = random.Random(9)
    seeds = [prose(rng, 120).split() for _ in range(6)]
    texts = list(odd)
    for _ in range(60):
        words = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice("pqrs")
        texts.append(" ".join(words))
    shingles = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in ((t or "").lower().split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both, union = sum((shingles[a] & shingles[b]).values()), sum((shingles[a] | shingles[b]).values())
            if shingles[a] == shingles[b] or both >= 0.8 * union:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in dartminhash.classes(frame(spark, texts), block=4).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_dart_minhash_links_all_texts_of_an_id(spark):
    rng = random.Random(12)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    # Id 7 has the texts of 3, of 5 and one of its own; rows without id have those of 8 and 9, which stay apart.
    rows = [(3, a), (7, a), (5, b), (7, b), (7, c), (8, d), (None, d), (9, e), (None, e)]
    got = dartminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id is not null").collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(3, 3), (5, 3), (7, 3), (8, 8), (9, 9)}


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 1 << 63, 400, np.uint64)
    a, b = rng.random(400) * 3, rng.random(400) * 3
    sig = dartminhash.signatures([ids, ids], 2000, [a, b])
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_elias_fano():
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 1 << 22, 5000, np.uint64))
    ef = eliasfano.EliasFano(values, 1 << 22)
    n = len(values)
    assert (ef.access(np.arange(n)) == values).all()
    keys = rng.integers(0, 1 << 22, 20000, np.uint64)
    got = ef.find(keys, np.zeros(20000, np.int64), np.full(20000, n))
    at = np.searchsorted(values, keys)
    want = np.where((at < n) & (values[np.minimum(at, n - 1)] == keys), at, -1)
    assert (got == want).all()


def test_language_model_base_and_shards(spark, odd):
    import math

    rng = random.Random(8)
    texts = [*odd, *(prose(rng, 50) for _ in range(40))]
    split = [[w for w in (t or "").encode().lower().split()] + [None] for t in texts]
    train = [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    counts = Counter(w for s, t in zip(split, train) if t for w in s)
    total, distinct = sum(counts.values()), len(counts)
    one = {r.doc_id: r for r in ngram_lm.score(frame(spark, texts), shortlist=50).collect()}
    many = {r.doc_id: r for r in ngram_lm.score(frame(spark, texts), shortlist=50, shard_tokens=10**9).collect()}
    for i, s in enumerate(split):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in s)
        assert abs(one[i].base_score - base) < 1e-6 and one[i].n_known == sum(counts[w] > 0 for w in s)
        assert one[i].train_tokens == total and abs(one[i].score - many[i].score) < 1e-6


def plain_trigram(texts):
    """Scores of the smoothed trigram over all words, without quantisation, and the number of tokens."""
    import math

    split = [["<s>", "<s>", *(t or "").encode().lower().split(), None] for t in texts]
    train = [s for i, s in enumerate(split) if zlib.crc32(str(i).encode()) % 10 != 0]
    one, two, three, after1, after2 = Counter(), Counter(), Counter(), Counter(), Counter()
    for s in train:
        for u, v, w in zip(s, s[1:], s[2:]):
            one[w] += 1
            two[v, w] += 1
            three[u, v, w] += 1
            after1[v] += 1
            after2[u, v] += 1
    total, n1, n2 = sum(one.values()), *(sum(c == k for w, c in one.items() if w is not None) for k in (1, 2))
    d = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    scores = []
    for s in split:
        score = 0.0
        for u, v, w in zip(s, s[1:], s[2:]):
            p = (one[w] - d if one[w] else d * len(one)) / total
            p = (two[v, w] + ngram_lm.PRIOR2 * p) / (after1[v] + ngram_lm.PRIOR2)
            score += math.log10((three[u, v, w] + ngram_lm.PRIOR3 * p) / (after2[u, v] + ngram_lm.PRIOR3))
        scores.append((score, len(s) - 2))
    return scores


def test_language_model_heavy_word_keeps_trigrams(spark):
    rng = random.Random(5)
    # "the" follows every other word, so its count is far above half a shard of 300 tokens.
    texts = [" ".join(f"the {rng.choice('abcdef')}" for _ in range(60)) for _ in range(40)] + ["the a the b", "", None, "the the the"]
    docs = ngram_lm.texts(frame(spark, texts)).withColumn("held_out", ngram_lm.id_remainder(ngram_lm.F.col("doc_id"), 10) == 0)
    hot = ngram_lm.hot_ngrams(docs, ngram_lm.learn_vocabulary(docs), 150, ngram_lm.PRIOR2, ngram_lm.PRIOR3)
    assert len(hot.pair) > 5 and len(hot.triple) > 0  # some pairs, and triples, are more than a shard holds
    few = {r.doc_id: r for r in ngram_lm.score(frame(spark, texts), shard_tokens=300).collect()}
    one = {r.doc_id: r for r in ngram_lm.score(frame(spark, texts), shard_tokens=10**9).collect()}
    for i, (score, n) in enumerate(plain_trigram(texts)):
        assert abs(few[i].score - one[i].score) < 1e-6 and abs(few[i].score - score) < 1e-3 * n, i


def test_language_model_shortlist_changes_no_score(spark, odd):
    rng = random.Random(9)
    # Pairs of words off a short list that occur again and again, after words on it and off it.
    names = [f"name{k} of{k} place{k}" for k in range(60)]
    texts = [*odd, *(" ".join(rng.choice([*names, "the", "and the"]) for _ in range(40)) for _ in range(60))]
    got = [{r.doc_id: r for r in ngram_lm.score(frame(spark, texts), shortlist=k, shard_tokens=m).collect()} for k, m in ((5, 3000), (5, 10**9), (65_533, 10**9))]
    for i, (score, n) in enumerate(plain_trigram(texts)):
        assert max(g[i].score for g in got) - min(g[i].score for g in got) < 1e-6 and abs(got[0][i].score - score) < 1e-3 * n, i


@pytest.mark.parametrize("hot", [suffixdedup.HOT, 6, 1])
def test_suffix_dedup_against_brute_force(spark, odd, hot):
    rng = random.Random(17)
    # One passage in many settings: its bucket is larger than a block and, but for the first case, than a hot one.
    passage = prose(rng, 40)
    settings = [prose(rng, 9)[: rng.randint(0, 60)] + passage[rng.randint(0, 9) :] + prose(rng, 30)[: rng.choice([0, 5, 140])] for _ in range(70)]
    texts = [*odd, "ab" * 400, "ab" * 150, *settings]
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + 200] for b in raw for p in range(len(b) - 199))
    rows = {r.doc_id: r for r in suffixdedup.dedup(frame(spark, texts), hot=hot, block=40).collect()}
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = True
        assert rows[i].kept == np.frombuffer(b, np.uint8)[~gone].tobytes(), i


def test_classifiers_learn_and_take_empty_tables(spark):
    rng = random.Random(6)
    texts = [prose(rng, 40) + (" vilewords" if i % 3 == 0 else "") + (" women" if i % 2 else "") for i in range(150)] + [None, ""]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(150)] + [(9, None, None)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in range(150)) and len(got) == 152
    none = toxicity.train(docs.limit(0), labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    assert quality.score(docs, quality.train(docs, labels)).count() == 152
    x = np.random.default_rng(0).random((500, 3))
    trees = quality.fit_trees(x, (x[:, 1] > 0.5).astype(float))
    assert ((trees.predict(x) > 0.5) == (x[:, 1] > 0.5)).mean() > 0.98


def test_quality_statistics_read_whole_texts():
    rng, at = random.Random(4), quality.FEATURES.index("compressed")
    start = "".join(rng.choice("abcdefgh ") for _ in range(70_000))
    for text in (start, start + "junk " * 60_000, "junk " * 60_000 + start, "short"):
        assert quality.statistics(text)[at] == len(zlib.compress(text.encode(), 1)) / len(text)


def test_mixing_keeps_budgets(spark):
    from pyspark.sql import functions as F

    rows = [(i, "a b c d", "en" if i % 4 else "de", "big" if i % 3 else "small", 7, "x", "y") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    taken = mixing.select(docs, levels, {"lang": {"de": 3}}, (1, 2), 2)
    by_leaf = taken.groupBy("mix_lang", "mix_source", "mix_budget").agg(F.sum(F.col("mix_tokens") * F.col("mix_copies")).alias("got")).collect()
    assert all(0 <= r.mix_budget - r.got < 4 for r in by_leaf) and abs(sum(r.mix_budget for r in by_leaf) - 800) <= 4
    assert mixing.repeat_rows(taken).columns == docs.columns
    assert mixing.select(docs.limit(0), levels, {}).count() == 0


def test_order_minhash_many_ranges_and_shared_ids(spark):
    rng = random.Random(2)
    texts = [None if rng.random() < 0.1 else prose(rng, rng.randint(0, 12)) for _ in range(400)]
    ids = [rng.choice([None, 7, 7, k * 1000 - 90_000]) for k in range(400)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(5)
    hashes = {r.t: r.h for r in docs.selectExpr("coalesce(text, '') as t", "xxhash64(coalesce(text, '')) as h").distinct().collect()}
    order = sorted(zip(ids, (t or "" for t in texts), strict=True), key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], r[1]))
    want = [(i, len(t), hashlib.sha256(ordermin.edited(t, order[(k + 1) % len(order)][1]).encode()).hexdigest()) for k, (i, t) in enumerate(order)]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for ranges in (1, 40, 2000):
        got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in ordermin.compare_with_next(docs, ranges=ranges).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_order_minhash_is_the_plain_rule():
    """Each value comes from the l least numbered k-mers in text order, and shares of equal values follow edits."""
    rng = random.Random(13)
    a = prose(rng, 300)
    x = ordermin.kmer_hashes(a)
    got = ordermin.fingerprint(a)
    for j in (0, 5, 63):
        scrambled = [((int(h) ^ int(ordermin._XOR[j])) * int(ordermin._ODD[j])) & 0xFFFFFFFF for h in x]
        least = sorted(sorted(range(len(x)), key=lambda i: (scrambled[i], i))[: ordermin.L])
        value = np.full(1, ordermin.L, np.uint64)
        for i in least:
            value = ordermin._mix(value * ordermin._MIX + np.uint64(x[i]) + np.uint64(1))
        assert got[j] == value[0] >> np.uint64(32)
    near = ordermin.likeness(got, ordermin.fingerprint(a.replace(a[100:110], "zz", 1)))
    words = a.split()
    rng.shuffle(words)
    assert near > 0.8 > 0.3 > ordermin.likeness(got, ordermin.fingerprint(" ".join(words)))


def test_toxicity_counterfactuals_clear_neutral_mentions(spark):
    """Mentions that go with toxic labels in training raise no score on neutral held-out mentions, and recall stays."""
    rng = random.Random(21)
    groups = ["women", "muslims", "immigrants", "gay"]

    def text(toxic, mention):
        words = [rng.choice("alpha beta gamma delta omega sigma kappa theta".split()) for _ in range(12)]
        if toxic and rng.random() < 0.85:
            words.append(rng.choice(["vilewords", "grossword"]))
        if mention:
            words.append(rng.choice(groups))
        rng.shuffle(words)
        return " ".join(words)

    labelled = []
    for _ in range(600):
        toxic = rng.random() < 0.5
        labelled.append((text(toxic, rng.random() < (0.9 if toxic else 0.05)), int(toxic)))
    neutral, vile = [text(False, True) for _ in range(200)], [text(True, rng.random() < 0.5) + " vilewords" for _ in range(200)]
    docs = frame(spark, [t for t, _ in labelled])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(labelled)], "doc_id long, toxic int")
    plain, fair = (toxicity.train(docs, labels, pair_weight=w) for w in (0.0, toxicity.PAIR_WEIGHT))
    false = lambda m: sum(m.score(t) >= 0.5 for t in neutral) / len(neutral)
    recall = lambda m: sum(m.score(t) >= 0.5 for t in vile) / len(vile)
    assert false(plain) > 0.5 and false(fair) < 0.05
    assert recall(fair) > 0.95
    assert max(abs(w) for f, w in fair.weights.items() if f in groups) < 0.5 < max(w for f, w in plain.weights.items() if f in groups)


@pytest.mark.parametrize("name, train, score", [("toxic", toxicity.train, toxicity.score), ("quality", quality.train, quality.score)])
def test_labels_beyond_two_values_and_shared_ids(spark, name, train, score):
    rng = random.Random(3)
    texts = [prose(rng, 30) + (" vilewords !!! ###" if i % 2 else "") for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, "another text")] * 50 + [(None, "vilewords")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, i % 2) for i in range(60)]
    odd_marks = marks + [(0, 7), (2, -1), (3, None), (None, 1), (5, 5), (999, 1)] + marks[:5]
    one, two = (train(docs, spark.createDataFrame(m, f"doc_id long, {name} int")) for m in (marks, odd_marks))
    assert [r.score for r in score(docs, one).orderBy("doc_id", "score").collect()] == [r.score for r in score(docs, two).orderBy("doc_id", "score").collect()]
    for only in (0, 1):
        model = train(docs, spark.createDataFrame([(i, only) for i in range(20)], f"doc_id long, {name} int"))
        assert all((r.score > 0.5) == bool(only) for r in score(docs, model).collect())


def test_dart_minhash_in_one_hot_bucket(spark):
    """Hundreds of texts of one template, some near and some far from its first text: classes as by all pairs."""
    rng = random.Random(31)
    base = prose(rng, 100).split()
    texts = []
    for k in range(260):
        words = list(base)
        for at in rng.sample(range(100), 3 if k % 3 else 6):
            words[at] = f"x{k // 2}y{at}"
        texts.append(" ".join(words))
    sets = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = sum((sets[a] & sets[b]).values())
            if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in dartminhash.classes(frame(spark, texts), block=16).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_keep_one_orders_shared_and_missing_ids(spark):
    rng = random.Random(14)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(1, a, "u"), (2, a + " more", "v"), (3, b, "w"), (3, c, "x"), (None, a, "y"), (None, d, "z"), (None, d, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string")
    got = {tuple(r) for r in dartminhash.keep_one(docs.repartition(3)).collect()}
    again = {tuple(r) for r in dartminhash.keep_one(docs.coalesce(1)).collect()}
    assert got == again and len(got) == 3 and (1, a, "u") in got and (None, d, "y") in got and sum(r[0] == 3 for r in got) == 1


def test_mixing_keeps_names_and_cuts_by_fine_ranges(spark):
    from pyspark.sql import functions as F

    rows = [(i, "a b c", "en", "s", "1", "2", "3") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_x string, own_mix_x string, own_own_mix_x string")
    levels = {"lang": F.col("lang")}
    taken = mixing.select(docs, levels, {}, (1, 2), 2)
    back = mixing.repeat_rows(taken)
    assert len(set(taken.columns)) == len(taken.columns) and back.columns == docs.columns
    assert {tuple(r)[4:] for r in back.collect()} == {("1", "2", "3")} and back.count() == 25
    sizes = docs.select("doc_id", F.lit(3).cast("long").alias("n_tokens"), "lang")
    keys = [mixing.plan(sizes, ["lang"], {}, (1, 2), 2, 17, ranges=r).first().last_key for r in (1, 7, 4096)]
    assert len(set(keys)) == 1
