"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Statistics are computed where the documents are. The trees are fitted on a bounded sample of labelled
rows (``SAMPLE_ROWS``, chosen by hash of the id), of which only the statistics travel. Fitted trees are
perfect binary trees flattened into arrays (feature, threshold, leaf), so scoring a batch is one
vectorised walk per tree level.

Defined results: null and empty texts have all-zero statistics and still get a score; rows whose id is null are
scored and do not train; labels other than 0 and 1, and labels whose row is missing, do not train; with no usable label
the score is 0.5, with labels of one kind only it is near that kind. Of rows that share an id the one with the least
text trains. Long texts are read whole. Repeated rows get equal scores; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import id_remainder, map_batches, texts

SAMPLE_ROWS = 20_000

_CLASS = np.zeros(256, np.int8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 sentence mark, 7 bracket or quote, 8 symbol, 9 beyond ASCII
for chars, kind in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t", 4), (b"\n\r", 5), (b".,;:?-", 6), (b"()[]{}\"'`", 7), (b"!#$%&*+/<=>@\\^_|~", 8), (range(128, 256), 9)):
    _CLASS[list(chars)] = kind

FEATURES = (
    "log_bytes", "lower", "upper", "digit", "blank", "line_end", "sentence", "bracket", "symbol", "beyond_ascii", "log_words", "word_length", "word_spread", "unique_words",
    "top_word", "short_words", "capital_words", "upper_words", "symbol_words", "lone_symbols", "log_lines", "line_length", "repeated_lines", "ended_lines", "compressed", "top_symbol",
)


def _compressed(raw: bytes, step: int = 65536) -> int:
    """The compressed size of all of ``raw``, fed in slices and not kept."""
    packer, whole = zlib.compressobj(1), memoryview(raw)
    size = sum(len(packer.compress(whole[i : i + step])) for i in range(0, len(raw), step))
    return size + len(packer.flush())


def statistics(text: str) -> list[float]:
    """The values of ``FEATURES`` for one text; shares are of bytes, words or lines."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS, weights=by_byte, minlength=10)[1:] / len(raw)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n, counts = max(1, len(words)), Counter(words)
    lengths = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    symbol_bytes = by_byte[_CLASS == 8]
    # Shares over distinct words, weighted by count, look at each distinct word once.
    capital = upper = marked = lone = 0
    for w, c in counts.items():
        if w.isalnum():
            if w.isupper() and len(w) > 1:
                upper += c
            elif w[0].isupper():
                capital += c
        elif not any(map(str.isalnum, w)):
            lone += c
        else:
            bare = w.rstrip(".,;:?")
            if not bare.isalnum():
                marked += c
            if bare.isupper() and len(bare) > 1:
                upper += c
    return [
        math.log1p(len(raw)), *shares.tolist(), math.log1p(len(words)), float(lengths.mean()), float(lengths.std()), len(counts) / n,
        max(counts.values(), default=0) / n, float((lengths <= 3).sum()) / n, capital / n, upper / n, marked / n, lone / n,
        math.log1p(len(lines)), len(text) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), sum(x[-1] in ".!?:" for x in lines) / max(1, len(lines)),
        _compressed(raw) / len(raw), float(symbol_bytes.max()) / len(raw),
    ]


@dataclass
class BoostedTrees:
    """Perfect binary trees in arrays: node i has children 2i+1 and 2i+2; the last level holds the leaves."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a value above it goes right
    leaf: np.ndarray  # trees x leaves
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, rows, depth = np.full(len(x), self.base), np.arange(len(x)), int(math.log2(self.leaf.shape[1]))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (leaf.size - 1)]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, min_rows: int = 4) -> BoostedTrees:
    """Boost logistic loss: each level of a tree is one histogram of gradients per feature over (node, bin)."""
    n, inner, leaves = len(y), 2**depth - 1, 2**depth
    share = (y.sum() + 0.5) / (n + 1) if n else 0.5
    base = math.log(share / (1 - share))
    if n == 0 or y.min() == y.max():
        return BoostedTrees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    features, thresholds, leaf_values = [], [], []
    score = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node, feature, threshold = np.zeros(n, np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best_gain, best_j, best_bin = np.full(width, 1e-9), np.zeros(width, np.int64), np.full(width, bins)
            for j in range(x.shape[1]):
                if not len(edges[j]):
                    continue
                key = (node - first) * bins + binned[:, j]
                gl, hl, nl = (np.bincount(key, weights=w, minlength=width * bins).reshape(width, bins).cumsum(1) for w in (g, h, None))
                gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(nl < min_rows) | (nt - nl < min_rows)] = -1
                b = gain.argmax(1)
                better = gain[np.arange(width), b] > best_gain
                best_gain = np.where(better, gain[np.arange(width), b], best_gain)
                best_j, best_bin = np.where(better, j, best_j), np.where(better, b, best_bin)
            for k in range(width):
                if best_bin[k] < len(edges[best_j[k]]):
                    feature[first + k], threshold[first + k] = best_j[k], edges[best_j[k]][best_bin[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, weights=g, minlength=leaves) / (np.bincount(at, weights=h, minlength=leaves) + l2)
        score = score + leaf[at]
        features.append(feature), thresholds.append(threshold), leaf_values.append(leaf)
    return BoostedTrees(np.array(features), np.array(thresholds), np.array(leaf_values), base)


def _featured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "x": [statistics(t) for t in batch.column("text").to_pylist()]}

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, x array<double>")


def train(df: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 4, held_out: int = 2, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> BoostedTrees:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold, chosen by hash of the id."""
    picked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).where("label in (0, 1) and doc_id is not null").distinct()
    picked = picked.where(id_remainder(F.col("doc_id"), folds) != held_out).orderBy(F.md5(F.col("doc_id").cast("string")), "label").limit(sample_rows)
    ids = picked.select("doc_id").distinct()  # at most sample_rows ids
    # As many rows stay, however often an id occurs.
    chosen = texts(df, id_col, text_col).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = _featured(chosen, "doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "x", "label").orderBy("doc_id", "label").collect()
    x = np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([r.label for r in rows]))


def score(df: DataFrame, model: BoostedTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) for every row of ``df``; the model is a few kB whatever the corpus. No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        x = np.array([statistics(t) for t in batch.column("text").to_pylist()], float)
        return {"doc_id": batch.column("doc_id"), "score": model.predict(x)}

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, score double")
