"""Toxicity classifier, regularised by counterfactuals.

A logistic model over words and word beginnings that occur in a document. Which of these are features is
decided by a chi-squared test over a bounded sample of labelled rows (``SAMPLE_ROWS``, by hash of the id),
counted in Spark. In training, every labelled document that names a group also yields counterfactuals: the same
text with the identity terms swapped for others of the same kind, and the text without them, as if it
named nobody. The loss adds ``PAIR_WEIGHT`` times the mean squared change of the logit over these pairs. Swaps
alone would only make the terms of a kind weigh the same; the neutral side draws that common weight to zero, so
that a mention by itself does not raise a score. Labelled texts that name no group have no counterfactual;
where none names one, the model is plain logistic regression.

Defined results: null and empty texts score by the bias alone; rows whose id is null are scored and do not train;
labels other than 0 and 1 do not train; with no usable label all scores are 0.5, with labels of one kind near that
kind. Of rows that share an id the one with the least text trains. Long texts are read whole. Repeated rows get
equal scores; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import id_remainder, map_batches, texts
from docloom.session import Staged

SAMPLE_ROWS, MAX_FEATURES, MIN_DOCS, MIN_CHI2, PAIR_WEIGHT = 12_000, 4096, 3, 12.0, 2.0
PREFIXES = range(3, 9)
#: Texts that a task holds as Python strings at once.
ROWS = 256

# Identity terms, one group of interchangeable terms a line.
IDENTITY_TERMS = (
    "women men girls boys females males",
    "woman man girl boy female male",
    "muslim christian jewish hindu buddhist atheist",
    "muslims christians jews hindus buddhists atheists",
    "black white asian latino african european",
    "gay straight lesbian bisexual transgender heterosexual",
    "immigrant refugee foreigner migrant",
    "immigrants refugees foreigners migrants",
    "disabled blind deaf elderly young",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs athées",
    "immigrés réfugiés étrangers migrants",
    "frauen männer mädchen jungen",
    "muslime christen juden atheisten",
    "einwanderer flüchtlinge ausländer migranten",
    "mujeres hombres chicas chicos",
    "musulmanes cristianos judíos ateos",
    "inmigrantes refugiados extranjeros migrantes",
)
_GROUP_OF = {w: line.split() for line in reversed(IDENTITY_TERMS) for w in line.split()}
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """Whole words as they are, beginnings with a leading ^."""
    found = set(words)
    for w in words:
        found.update("^" + w[:k] for k in PREFIXES if len(w) > k)
    return found


def counterfactuals(words: set[str], swaps: int) -> list[set[str]]:
    """The words without their identity terms, and ``swaps`` times with each swapped for another of its group;
    nothing where no term occurs."""
    named = words & _GROUP_OF.keys()
    if not named:
        return []
    made = [words - named]
    for turn in range(swaps):
        others = ([x for x in _GROUP_OF[w] if x != w] for w in named)
        made.append((words - named) | {o[(zlib.crc32(o[0].encode()) + turn) % len(o)] for o in others})
    return made


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    _seen: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def _known(self, word: str) -> tuple[str, ...]:
        """The features that a word carries; remembered, for at most 50,000 words a process."""
        got = self._seen.get(word)
        if got is None:
            got = tuple(f for f in features_of({word}) if f in self.weights)
            if len(self._seen) > 50_000:
                self._seen.clear()
            self._seen[word] = got
        return got

    def logit(self, words: set[str]) -> float:
        found: set[str] = set()
        for w in words:
            found.update(self._known(w))
        return self.bias + sum(sorted(self.weights[f] for f in found))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(words_of(text)), -40, 40))))

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias, "_seen": {}}


def _fit(rows: list[tuple[np.ndarray, list[np.ndarray], float]], n_features: int, pair_weight: float, l2: float = 2e-5, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Adam on class-balanced logistic loss plus the squared logit change of each counterfactual pair."""
    y = np.array([r[2] for r in rows])
    w, b = np.zeros(n_features), 0.0
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return w, float(np.log(share / (1 - share)))
    sides = [(r[0], k) for k, r in enumerate(rows)]
    col, row = np.concatenate([s[0] for s in sides]), np.repeat([k for _, k in sides], [len(s[0]) for s in sides])
    pairs = [(r[0], c) for r in rows for c in r[1]]
    p_col = np.concatenate([x for a, c in pairs for x in (a, c)]) if pairs else np.zeros(0, int)
    p_row = np.repeat(np.arange(len(pairs)), [len(a) + len(c) for a, c in pairs])
    p_sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(c))] for a, c in pairs]) if pairs else np.zeros(0)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for t in range(1, steps + 1):
        s = b + np.bincount(row, weights=w[col], minlength=len(y))
        g = weight * (1 / (1 + np.exp(-np.clip(s, -40, 40))) - y)
        gw, gb = np.bincount(col, weights=g[row], minlength=n_features) + l2 * w, g.sum()
        if len(pairs):
            change = np.bincount(p_row, weights=p_sign * w[p_col], minlength=len(pairs))
            gw += np.bincount(p_col, weights=p_sign * (2 * pair_weight / len(pairs)) * change[p_row], minlength=n_features)
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b = b - rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, float(b)


def train(
    df: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES,
    pair_weight: float = PAIR_WEIGHT, swaps: int = 2, id_col: str = "doc_id", text_col: str = "text",
) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold and at most ``max_features`` features."""
    picked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null").distinct()
    picked = picked.where(id_remainder(F.col("doc_id"), folds) != held_out).orderBy(F.md5(F.col("doc_id").cast("string")), "label").limit(sample_rows)
    # At most sample_rows ids are broadcast, and as many rows stay, however often an id occurs.
    drawn = texts(df, id_col, text_col).join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    held = Staged(drawn, "toxic-sample")  # the corpus is read once; what follows looks at the sample
    sample = held.df

    def count(batch: pa.RecordBatch) -> dict:
        seen: dict[str, list[int]] = {}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            for f in features_of(words_of(text)):
                seen.setdefault(f, [0, 0])[label] += 1
        return {"feature": list(seen), "neg": [c[0] for c in seen.values()], "pos": [c[1] for c in seen.values()]}

    totals = sample.agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).first()
    pos, neg = totals.pos or 0, totals.neg or 0
    counted = map_batches(sample, count, "feature string, neg long, pos long", ROWS).groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    n, present = float(pos + neg), F.col("pos") + F.col("neg")
    cross = F.col("pos") * (neg - F.col("neg")) - F.col("neg") * (pos - F.col("pos"))
    chi2 = F.try_divide(F.lit(n) * cross * cross, present * (F.lit(n) - present) * float(pos) * float(neg))
    chosen = counted.where(present >= MIN_DOCS).withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "feature").limit(max_features)
    names = [r.feature for r in chosen.select("feature").collect()]
    index = {f: k for k, f in enumerate(names)}

    def design(batch: pa.RecordBatch) -> dict:
        own: list[list[int]] = []
        other: list[list[list[int]]] = []
        to_ids = lambda words: sorted(index[f] for f in features_of(words) if f in index)
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            own.append(to_ids(words))
            other.append([to_ids(c) for c in counterfactuals(words, swaps)])
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "own": own, "other": other}

    rows = map_batches(sample, design, "doc_id long, label int, own array<int>, other array<array<int>>", ROWS).orderBy("doc_id", "label").collect()
    held.drop()
    as_ids = lambda x: np.array(x, np.int64)
    w, b = _fit([(as_ids(r.own), [as_ids(c) for c in r.other], float(r.label)) for r in rows], len(names), pair_weight)
    return ToxicityModel({f: float(w[k]) for f, k in index.items()}, b)


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) for every row; the model has at most ``max_features`` weights. No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": [model.score(t) for t in batch.column("text").to_pylist()]}

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, score double", ROWS)


def keep_clean(df: DataFrame, model: ToxicityModel, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that score below ``limit``; null texts count as empty. No shuffle."""

    @F.arrow_udf("double")
    def rate(column: pa.Array) -> pa.Array:
        slices = (column.slice(start, ROWS).to_pylist() for start in range(0, len(column), ROWS))
        return pa.array([model.score(t or "") for part in slices for t in part], pa.float64())

    return df.where(rate(F.col(text_col)) < limit)
