"""Extractive summaries: the sentences that the other sentences of a text have most in common with.

Sentences that share words stand in a graph; a sentence is weighty if weighty ones share its words. Power iteration finds the weights. The graph
is never written out: a step goes from sentences to their words and back, so it is linear in the text, however many sentences share
a word. Texts are taken one at a time in Arrow batches.

Defined results: a null or blank text has no points; of equal weights the first sentence wins; a text with few sentences gives them all; points come in the
order of the text; repeated sentences are one.
"""

from __future__ import annotations

import math
import re

import numpy as np

LEAST, MOST, EACH = 3, 5, 10
DAMPING, STEPS = 0.85, 30
_END = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\w{4,}")


def split(text: str) -> list[str]:
    """The sentences of a text, stripped; each once."""
    return list(dict.fromkeys(s for s in (part.strip() for part in _END.split(text)) if s))


def weights(sentences: list[str]) -> np.ndarray:
    """The weight of each sentence. A step shares a sentence's weight equally among its words, and a word's among the sentences that have it."""
    words: dict[str, int] = {}
    held = [sorted({words.setdefault(w, len(words)) for w in _WORD.findall(s.lower())}) for s in sentences]
    of = np.repeat(np.arange(len(held)), [len(h) for h in held])
    word = np.array([w for h in held for w in h], np.int64)
    each, among = np.array([max(1, len(h)) for h in held], float), np.maximum(1, np.bincount(word, minlength=len(words)))
    x = np.full(len(held), 1 / max(1, len(held)))
    for _ in range(STEPS):
        there = np.bincount(word, (x / each)[of], len(words)) / among
        x = (1 - DAMPING) / len(held) + DAMPING * np.bincount(of, there[word], len(held))
    return x


def wanted(n: int) -> int:
    """How many points ``n`` sentences make."""
    return min(n, max(LEAST, min(MOST, math.ceil(n / EACH))))


def ranked(text: str) -> list[str]:
    """The points of a text; use it where a plan asks for ``summary``."""
    sentences = split(text or "")
    if not sentences:
        return []
    order = np.lexsort((np.arange(len(sentences)), -np.round(weights(sentences), 12)))
    return [sentences[k] for k in sorted(order[: wanted(len(sentences))].tolist())]
