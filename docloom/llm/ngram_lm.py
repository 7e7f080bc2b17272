"""Language-model scoring with Elias-Fano n-gram tries, built and queried shard by shard.

The model is a trigram over all words and the end of a text. Unigrams are discounted (absolute discounting,
what is discounted goes to the unknown word). Trigrams and bigrams are smoothed towards the next lower order
with a Dirichlet prior, so probabilities over all known words and the unknown one sum to 1 up to quantisation.

Words of every document are counted in Spark; the counts of the most frequent ones (``SHORTLIST``) are
broadcast, which makes their names short and their unigrams known everywhere, and changes no score. Each token
goes, packed with the others of its batch, to a shard that holds every occurrence of its word pair: that of the
word before it, or, if the token's own word is off the shortlist, that of its own word, which counts it exactly.
If both words are off the shortlist, the shard of its own word sends it on, with its count, to that of the word
before it. A shard numbers the words it has seen, builds its trie in a memory map and looks up its tokens.
Shards grow in number with the corpus, not in size; a context with more tokens than a shard should hold is
split by successor. Pairs of such words that are themselves more than a shard should hold (``HotNgrams``, at most two for
each shard) are counted beforehand, which lets their tokens be split by the word before the pair. Triples that are still
too many are counted with them and scored where they stand, as their scores are then known.

The total of a trigram's context (u, v) is the count of the bigram u v, so it lies with that bigram as its
back-off, and the token that ends the bigram adds it to the score on behalf of the token after it. So a
split context needs nothing from its other parts. Words off the shortlist are too rare for a group of their own to grow
beyond a 65,533rd of all tokens.

Defined results: a null or empty text is its end alone; with nothing to learn from every token is unknown,
with probability 1. Very long texts and repeated rows are scored whole; a null id is carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.llm.common import id_remainder, map_batches, record_batch, texts
from docloom.llm.eliasfano import Level
from docloom.session import Staged

SHORTLIST = 65_533
END, BOS, RARE, SPAN = 65_533, 65_534, 65_535, 65_536
SHARD_TOKENS, BATCH_DOCS, BATCH_BYTES = 800_000, 16_000, 5_000_000
PRIOR2, PRIOR3 = 20.0, 6.0
_GOLD, _M1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        # Names of 62 bits above the shortlist's ids.
        value = self[word] = (xxhash.xxh3_64_intdigest(word) >> 2) + SPAN
        return value


_words = _WordHashes()


def _hashes(text: str) -> np.ndarray:
    """Hashed words: A-Z lowered, split at blanks and control white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    return (x ^ (x >> np.uint64(32))) * _GOLD >> np.uint64(24)


@dataclass
class Vocabulary:
    """Totals of the training tokens and the shortlist; ``hashes`` ascend, ``ids`` and ``counts`` go with them."""

    total: int
    distinct: int
    texts: int
    discount: float
    hashes: np.ndarray
    counts: np.ndarray

    @property
    def by_id(self) -> np.ndarray:
        """Training counts of shortlist words, end and begin by id."""
        out = np.zeros(SPAN, np.int64)
        out[: len(self.counts)] = self.counts
        out[END] = out[BOS] = self.texts
        return out

    @property
    def base_norm(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)

    def log_unigram(self, counts: np.ndarray) -> np.ndarray:
        """Log10 probability of words with these training counts; a count of 0 is the unknown word."""
        total = max(1, self.total)
        unknown = self.discount * self.distinct / total if self.total else 1.0
        return np.log10(np.where(counts > 0, (counts - self.discount) / total, unknown))


def learn_vocabulary(docs: DataFrame, shortlist: int = SHORTLIST) -> Vocabulary:
    """Count the words of rows whose ``held_out`` is false."""

    def count(batch: pa.RecordBatch) -> dict:
        found = [_hashes(t) for t in batch.column("text").to_pylist()]
        words, n = np.unique(np.concatenate(found), return_counts=True)
        return {"word": words.astype(np.int64), "n": n}

    training = docs.where(~F.col("held_out"))
    counts = Staged(map_batches(training, count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    sums = counts.df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    rows = training.count()
    top = counts.df.orderBy(F.desc("n"), "word").limit(shortlist).toPandas().sort_values("word")
    counts.drop()
    discount = min(0.9, max(0.1, sums.n1 / (sums.n1 + 2 * sums.n2))) if sums.n1 else 0.5
    return Vocabulary(sums.total + rows, sums.distinct + bool(rows), rows, discount, top.word.to_numpy(np.uint64), top.n.to_numpy(np.int64))


def _quantised(x: np.ndarray) -> np.ndarray:
    """Log10 probabilities as a level of a trie holds them."""
    return np.clip(np.rint(-x * Level.STEP), 0, 65535) / -Level.STEP


@dataclass
class HotNgrams:
    """Pairs (``pair``: v and w in 16 bits each, ascending) with their training counts and the parts they are split into, and
    triples (u, v and w) with the whole score of one token."""

    pair: np.ndarray
    count: np.ndarray
    parts: np.ndarray
    triple: np.ndarray
    score: np.ndarray

    def find(self, codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each of ``of`` is in ``codes``, and where."""
        if not len(codes):
            return np.zeros(len(of), bool), np.zeros(len(of), np.int64)
        at = np.minimum(np.searchsorted(codes, of), len(codes) - 1)
        return codes[at] == of, at


def hot_ngrams(docs: DataFrame, vocabulary: Vocabulary, limit: float, prior2: float, prior3: float) -> HotNgrams:
    """Pairs and triples with more than ``limit`` training tokens. All their words have more, too, so only runs of such
    words are counted; none exist in a small corpus, and nothing is read then."""
    by_id = vocabulary.by_id
    heavy = np.flatnonzero(by_id > limit)
    none = np.zeros(0, np.uint64)
    if not len(heavy):
        return HotNgrams(none, none.astype(np.int64), none.astype(np.int64), none, none.astype(float))
    hashes, listed = vocabulary.hashes, by_id > limit

    def count(batch: pa.RecordBatch) -> dict:
        u, v, w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for text in batch.column("text").to_pylist():
            raw = _hashes(text)
            place = np.minimum(np.searchsorted(hashes, raw), max(0, len(hashes) - 1))
            ids = np.where(hashes[place] == raw, place, RARE) if len(hashes) else np.full(len(raw), RARE)
            ids = np.concatenate([[BOS, BOS], ids, [END]])
            own = np.flatnonzero(listed[np.minimum(ids[1:-1], SPAN - 1)] & listed[np.minimum(ids[2:], SPAN - 1)] & (ids[1:-1] != RARE) & (ids[2:] != RARE))
            u.append(ids[own]), v.append(ids[own + 1]), w.append(ids[own + 2])
        a, b, c = (np.concatenate(x).astype(np.uint64) for x in (u, v, w))
        pairs, n2 = np.unique(b << np.uint64(16) | c, return_counts=True)
        full = (a != RARE) & listed[np.minimum(a.astype(np.int64), SPAN - 1)]
        triples, n3 = np.unique((a << np.uint64(32) | b << np.uint64(16) | c)[full], return_counts=True)
        return {"size": [2] * len(pairs) + [3] * len(triples), "code": np.concatenate([pairs, triples]).astype(np.int64), "n": np.concatenate([n2, n3])}

    counted = map_batches(docs.where(~F.col("held_out")), count, "size int, code long, n long", 2000).groupBy("size", "code").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") > limit).orderBy("size", "code").collect()
    pick = lambda size: (np.array([r.code for r in rows if r.size == size], np.uint64), np.array([r.n for r in rows if r.size == size], np.int64))
    (pair, n2), (triple, n3) = pick(2), pick(3)
    # The score of a triple's token, step by step as a shard's tries give it.
    v, w = (triple >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int64), (triple & np.uint64(0xFFFF)).astype(np.int64)
    bigram = n2[np.searchsorted(pair, triple & np.uint64(0xFFFFFFFF))] if len(triple) else n3
    low = _quantised(np.log10((bigram + prior2 * 10 ** vocabulary.log_unigram(by_id[w])) / (by_id[v] + prior2)))
    scale = np.log10((by_id[v] + prior3) / prior3)
    score = _quantised(np.log10(n3 / prior3 + 10**low) - scale) + np.where(v == BOS, 0.0, scale)
    score += np.where(w == END, 0.0, _quantised(np.log10(prior3 / (bigram + prior3))))
    return HotNgrams(pair, n2, np.ceil(n2 / limit).astype(np.int64), triple, score)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int32)
    return zstandard.compress(head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 1)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    head = np.frombuffer(raw, np.int32, 1 + 2 * n)[1:].reshape(n, 2)
    out, at = [], 4 + 8 * n
    for kind, length in head.tolist():
        dtype = np.dtype(chr(kind))
        out.append(np.frombuffer(raw, dtype, length, at))
        at += length * dtype.itemsize
    return out


def _columns(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Short names with ``RARE`` for all others, and those others."""
    short = names < SPAN
    return np.where(short, names, RARE).astype(np.uint16), names[~short]


def _tokens(key: np.ndarray, *then: np.ndarray) -> list[np.ndarray]:
    """Columns of tokens sorted by ``key``: its runs, then the names of each other column."""
    found, counts = np.unique(key, return_counts=True)
    return [found, counts.astype(np.uint32), *(x for names in then for x in _columns(names))]


def _names(parts: list[list[np.ndarray]], at: int) -> np.ndarray:
    """The names of the column whose short names are at ``at``."""
    small = np.concatenate([p[at] for p in parts])
    out = small.astype(np.uint64)
    out[small == RARE] = np.concatenate([p[at + 1] for p in parts])
    return out


def _route(docs: DataFrame, vocabulary: Vocabulary, hot: HotNgrams, shards: int, others: int, heavy: dict[int, int]) -> DataFrame:
    """(block, shard, payload): tokens of a batch by the shard that counts their word pair, and what the batch
    knows of its documents (negative numbers). Shards are numbered by kind: first those of contexts on the
    shortlist, from ``shards`` on those of words off it, ``others`` later those of contexts off it."""
    schema = "block long, shard long, payload binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    by_id, norm = vocabulary.by_id, vocabulary.base_norm
    log_base = np.log10((by_id + 0.1) / norm)
    hashes, n_short = vocabulary.hashes, len(vocabulary.hashes)
    splits = np.ones(SPAN, np.int64)
    for word, parts in heavy.items():
        splits[word] = parts

    def one(batch: pa.RecordBatch, block: int) -> Iterator[tuple[int, bytes]]:
        docs_of = [_hashes(t) for t in batch.column("text").to_pylist()]
        lengths = np.array([len(x) for x in docs_of])
        raw = np.concatenate(docs_of) if docs_of else np.zeros(0, np.uint64)
        place = np.searchsorted(hashes, raw)
        known = hashes[np.minimum(place, n_short - 1)] == raw if n_short else np.zeros(len(raw), bool)
        ends = np.cumsum(lengths)
        # One end token after each text.
        word = np.insert(np.where(known, place.astype(np.uint64), raw), ends, END)
        listed = word < SPAN
        ids = np.where(listed, word, RARE).astype(np.int64)
        doc = np.repeat(np.arange(len(lengths)), lengths + 1)
        first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        before, before2 = np.roll(word, 1), np.roll(word, 2)
        before[first], before2[first] = BOS, BOS
        second = first[lengths > 0] + 1
        before2[second] = BOS
        train = ~np.asarray(batch.column("held_out").to_pylist(), bool)
        mark = (doc | np.where(train[doc], 0x8000, 0)).astype(np.uint16)
        base = np.where(listed, log_base[ids], 0.0)
        per_doc = lambda w: np.bincount(doc, weights=w, minlength=len(lengths))
        ok = listed & (by_id[ids] > 0)
        held = np.array([-1 if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
        null = np.array([x is None for x in batch.column("doc_id").to_pylist()], np.uint8)
        short = before < SPAN
        done, known_score = np.zeros(len(word), bool), np.zeros(len(lengths))
        if len(hot.pair):
            code = before << np.uint64(16) | word
            split, at = hot.find(hot.pair, np.where(short & listed, code, np.uint64(1 << 40)))
            done, which = hot.find(hot.triple, np.where(split & (before2 < SPAN), before2 << np.uint64(32) | code, np.uint64(1 << 56)))
            known_score = per_doc(np.where(done, hot.score[which], 0.0)) if len(hot.triple) else known_score
        yield -1 - block, _pack(held, null, (~train).astype(np.uint8), lengths + 1, per_doc(ok).astype(np.int64), per_doc(base), known_score)
        del base, ok
        parts = np.where(short, splits[np.where(short, before, 0).astype(np.int64)], 1)
        shard = _spread(before) + np.where(parts > 1, _spread(word + np.uint64(7)) % parts.astype(np.uint64), 0).astype(np.uint64)
        if len(hot.pair):
            shard = shard + np.where(split, _spread(before2 + np.uint64(13)) % hot.parts[at].astype(np.uint64), 0).astype(np.uint64)
        shard = shard % np.uint64(shards)
        shard = np.where(short, shard, _spread(before) % np.uint64(others) + np.uint64(shards + others))
        for number, rows in _grouped(shard, before, np.flatnonzero(listed & ~done)):
            yield number, _pack(*_tokens(before[rows], before2[rows], word[rows]), mark[rows])
        for number, rows in _grouped(_spread(word) % np.uint64(others), word, np.flatnonzero(~listed)):
            yield shards + number, _pack(*_tokens(word[rows], before2[rows], before[rows]), mark[rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, stop in _batches(batch.column("text")):
                made = list(one(batch.slice(start, stop - start), block))
                yield record_batch({"block": [block] * len(made), "shard": [n for n, _ in made], "payload": [p for _, p in made]}, arrow)
                block += 1
        pa.default_memory_pool().release_unused()  # the worker process lives on beside later stages

    return docs.mapInArrow(run, schema)


def _batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``BATCH_DOCS`` texts and, unless it is one text, ``BATCH_BYTES`` bytes."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and (size + n > BATCH_BYTES or i - start >= BATCH_DOCS):
            yield start, i
            start, size = i, 0
        size += n
    yield start, len(texts)


def _order(code: np.ndarray) -> np.ndarray:
    """Where codes stand when sorted; equal ones keep their order. Small codes are sorted as values, their places in the low bits."""
    n = len(code)
    bits = max(1, n - 1).bit_length()
    if not n or int(code.max()).bit_length() + bits > 63:
        return np.argsort(code, kind="stable")
    packed = code.astype(np.uint64) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


def _unique(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes in order, where each is first, and the number of each code among them."""
    order = _order(code)
    ranked = code[order]
    new = np.ones(len(code), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    inverse = np.empty(len(code), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[new], order[new], inverse


def _number(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names in order and the number of each name among them: short ones by a table, others by sorting."""
    short = names < SPAN
    there = np.zeros(SPAN, bool)
    small = names[short].astype(np.int64)
    there[small] = True
    inverse = np.empty(len(names), np.int64)
    inverse[short] = (np.cumsum(there) - 1)[small]
    long, inverse_long = np.unique(names[~short], return_inverse=True)
    inverse[~short] = int(there.sum()) + inverse_long
    return np.concatenate([np.flatnonzero(there).astype(np.uint64), long.astype(np.uint64)]), inverse


def _grouped(key: np.ndarray, then: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Those of ``rows`` that have each key, in the order of ``then``."""
    if not len(rows):
        return
    found, number = _number(then[rows])
    order = rows[_order(key[rows].astype(np.uint64) * np.uint64(len(found)) + number.astype(np.uint64))]
    found, starts = np.unique(key[order], return_index=True)
    for number, start, end in zip(found.tolist(), starts, [*starts[1:], len(order)], strict=True):
        yield number, order[start:end]


def _sums(block: np.ndarray, doc: np.ndarray, n_blocks: int, **values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Packed sums per document of each block."""
    key, _, inverse = _unique(block.astype(np.int64) * 32768 + doc)
    sums = [np.bincount(inverse, weights=v, minlength=len(key)) for v in values.values()]
    cuts = np.searchsorted(key, np.arange(n_blocks + 1) * 32768)
    for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if i < j:
            yield b, _pack((key[i:j] & 32767).astype(np.uint16), *(s[i:j] for s in sums))


def _score_tokens(v: np.ndarray, u: np.ndarray, w: np.ndarray, train: np.ndarray, total: np.ndarray | None, low1: np.ndarray, prior2: float, prior3: float, hot: HotNgrams | None = None) -> np.ndarray:
    """Build the trie of a shard from its training tokens w after u, v and look up all its tokens: the log10
    probability, but for the back-off of (u, v), and that of (v, w) for the token after. ``total`` is the
    training count of each token's v; None where the shard holds all that follows v. ``hot`` has the counts of pairs that
    the shard holds only a part of."""
    (contexts, cv), (words, cw), (_, cu) = (_number(x.astype(np.uint64)) for x in (v, w, u))
    span = len(words)
    totals = np.bincount(cv[train], minlength=len(contexts)).astype(float)
    if total is not None:
        totals[cv] = total
    # Bigrams, each with the back-off of the trigram context that it is.
    key, at, inverse = _unique(cv * span + cw)
    count = np.bincount(inverse[train], minlength=len(key))
    if hot is not None and len(hot.pair):
        split, where = hot.find(hot.pair, np.where((v[at] < SPAN) & (w[at] < SPAN), v[at].astype(np.uint64) << np.uint64(16) | w[at].astype(np.uint64), np.uint64(1 << 40)))
        count = np.where(split, hot.count[where], count)
    c, s, low, seen = key // span, key % span, low1[at], count > 0
    log_p = np.log10((count[seen] + prior2 * 10 ** low[seen]) / (totals[c[seen]] + prior2))
    trie = Level(c[seen], s[seen], log_p, np.log10(prior2 / (totals + prior2)), span, np.log10(prior3 / (count[seen] + prior3)))
    found, value, backoff, after = trie.search_with_weight(c, s)
    low2 = np.where(found, value, backoff + low)[inverse]
    out = np.where(w == END, 0.0, after[inverse])
    # Trigrams, relative to the total of v; where the text begins, (u, v) is one context and has that total.
    scale = np.log10((totals + prior3) / prior3)
    out[v == BOS] -= scale[cv[v == BOS]]
    pairs, _, cp = _unique(cu * len(contexts) + cv)
    key, at, inverse = _unique(cp * span + cw)
    count = np.bincount(inverse[train], minlength=len(key))
    c, s, low, seen = key // span, key % span, low2[at], count > 0
    over = scale[pairs % len(contexts)][c]
    trie = Level(c[seen], s[seen], np.log10(count[seen] / prior3 + 10 ** low[seen]) - over[seen], np.zeros(len(pairs)), span)
    found, value, _ = trie.search(c, s)
    return out + np.where(found, value + over, low)[inverse]


def score_listed(payloads: list[bytes], vocabulary: Vocabulary, hot: HotNgrams, prior2: float, prior3: float) -> Iterator[tuple[int, bytes]]:
    """Tokens of the shortlist after words of the shortlist: sums of log10 probabilities by document."""
    parts = [_unpack(p) for p in payloads]
    v = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    u, w, mark = _names(parts, 2), _names(parts, 4), np.concatenate([p[6] for p in parts]).astype(np.int64)
    block = np.repeat(np.arange(len(parts)), [len(p[6]) for p in parts])
    by_id = vocabulary.by_id
    logp = _score_tokens(v, u, w, mark >= 0x8000, by_id[v.astype(np.int64)], vocabulary.log_unigram(by_id[w.astype(np.int64)]), prior2, prior3, hot)
    return _sums(block, mark & 0x7FFF, len(parts), score=logp)


def score_words(payloads: list[bytes], blocks: np.ndarray, vocabulary: Vocabulary, others: int, prior2: float, prior3: float) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]]:
    """Count the words of a shard exactly: what they add to the score, the base and the known tokens, and, by
    shard of the word before, the tokens whose context is off the shortlist too, with their counts."""
    parts = [_unpack(p) for p in payloads]
    w = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    u, v, mark = _names(parts, 2), _names(parts, 4), np.concatenate([p[6] for p in parts]).astype(np.int64)
    block = np.repeat(np.arange(len(parts)), [len(p[6]) for p in parts])
    train = mark >= 0x8000
    _, inverse = np.unique(w, return_inverse=True)
    count = np.bincount(inverse[train], minlength=inverse.max() + 1)[inverse]
    logp, here = np.zeros(len(w)), np.flatnonzero(v < SPAN)
    if len(here):
        total = vocabulary.by_id[v[here].astype(np.int64)]
        logp[here] = _score_tokens(v[here], u[here], w[here], train[here], total, vocabulary.log_unigram(count[here]), prior2, prior3)
    sent = []
    for number, rows in _grouped(_spread(v) % np.uint64(others), v, np.flatnonzero(v >= SPAN)):
        own, at = np.unique(block[rows], return_inverse=True)  # a message names its own blocks only
        packed = _pack(*_tokens(v[rows], u[rows], w[rows]), mark[rows].astype(np.uint16), count[rows].astype(np.uint32), at.astype(np.uint32), blocks[own])
        sent.append((number, packed))
    return list(_sums(block, mark & 0x7FFF, len(parts), score=logp, base=np.log10((count + 0.1) / vocabulary.base_norm), known=(count > 0).astype(float))), sent


def score_contexts(payloads: list[bytes], blocks: list[int], vocabulary: Vocabulary, prior2: float, prior3: float) -> Iterator[tuple[int, bytes]]:
    """Tokens after words off the shortlist: (block, sums of log10 probabilities by document)."""
    parts = [_unpack(p) for p in payloads]
    v = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    u, w, mark = _names(parts, 2), _names(parts, 4), np.concatenate([p[6] for p in parts]).astype(np.int64)
    # Tokens straight from a batch are of its block and their words are on the shortlist.
    by_id = vocabulary.by_id
    own = lambda p: by_id[p[4].astype(np.int64)]
    count = np.concatenate([p[7].astype(np.int64) if len(p) > 7 else own(p) for p in parts])
    block = np.concatenate([p[9][p[8]] if len(p) > 7 else np.full(len(p[6]), b) for p, b in zip(parts, blocks, strict=True)])
    found, block = np.unique(block, return_inverse=True)
    logp = _score_tokens(v, u, w, mark >= 0x8000, None, vocabulary.log_unigram(count), prior2, prior3)
    return ((int(found[b]), payload) for b, payload in _sums(block, mark & 0x7FFF, len(found), score=logp))


def score(df: DataFrame, folds: int = 10, held_out: int = 0, shard_tokens: int = SHARD_TOKENS, prior2: float = PRIOR2, prior3: float = PRIOR3, id_col: str = "doc_id", text_col: str = "text", shortlist: int = SHORTLIST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``df``."""
    docs = texts(df, id_col, text_col).withColumn("held_out", id_remainder(F.col("doc_id"), folds) == held_out)
    vocabulary = learn_vocabulary(docs, shortlist)
    expected = max(1, vocabulary.total) * folds / (folds - 1)
    shards = math.ceil(expected / shard_tokens)
    limit = shard_tokens / 2
    heavy = {int(i): math.ceil(c / limit) for i, c in enumerate(vocabulary.by_id.tolist()) if c > limit}
    hot = hot_ngrams(docs, vocabulary, limit, prior2, prior3)
    known = df.sparkSession.sparkContext.broadcast(vocabulary)  # at most the shortlist
    others = shards // 4 + 1
    routed = _route(docs, vocabulary, hot, shards, others, heavy)
    schema = "block long, shard long, kind string, payload binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    made = lambda rows: pa.table({f.name: pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)}, schema=arrow)

    def work(table: pa.Table) -> pa.Table:
        number, blocks, payloads = table.column("shard")[0].as_py(), table.column("block").to_pylist(), table.column("payload").to_pylist()
        if number < 0:
            return made([(b, number, "about", p) for b, p in zip(blocks, payloads, strict=True)])
        if number < shards:
            return made([(blocks[b], number, "tokens", p) for b, p in score_listed(payloads, known.value, hot, prior2, prior3)])
        if number >= shards + others:
            return made([(b, number, "pass", p) for b, p in zip(blocks, payloads, strict=True)])
        sums, sent = score_words(payloads, np.array(blocks, np.int64), known.value, others, prior2, prior3)
        return made([(blocks[b], number, "class", p) for b, p in sums] + [(-1, shards + others + n, "pass", p) for n, p in sent])

    def finish(table: pa.Table) -> pa.Table:
        number, blocks, payloads = table.column("shard")[0].as_py(), table.column("block").to_pylist(), table.column("payload").to_pylist()
        return made([(b, number, "tokens", p) for b, p in score_contexts(payloads, blocks, known.value, prior2, prior3)])

    first = Staged(routed.groupBy("shard").applyInArrow(work, schema), "lm-first").df
    scored = first.where("kind <> 'pass'").unionByName(first.where("kind = 'pass'").groupBy("shard").applyInArrow(finish, schema)).drop("shard")
    final = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    arrow_final = to_arrow_schema(StructType.fromDDL(final))

    def gather(table: pa.Table) -> pa.Table:
        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        ids, null, held, n, n_known, base, total = _unpack(payloads[kinds.index("about")])
        n_known, base, total = n_known.copy(), base.copy(), total.copy()
        for kind, payload in zip(kinds, payloads, strict=True):
            if kind != "about":
                doc, *sums = _unpack(payload)
                total[doc] += sums[0]
                if kind == "class":
                    base[doc] += sums[1]
                    n_known[doc] += sums[2].astype(np.int64)
        columns = (pa.array(ids, mask=null.astype(bool)), held.astype(bool), n, n_known, np.full(len(ids), known.value.total), base, total)
        return pa.table([pa.array(c).cast(f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, arrow_final, strict=True)], schema=arrow_final)

    return scored.groupBy("block").applyInArrow(gather, final)


